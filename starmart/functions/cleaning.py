"""Text and code clean-up used by the staging functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.fixed_values import KNOWN_CURRENCIES


def clean_text(column: str) -> Column:
    return F.trim(F.col(column))


def clean_email(column: str) -> Column:
    return F.lower(F.trim(F.col(column)))


def clean_currency(column: str) -> Column:
    return F.upper(F.trim(F.col(column)))


def is_known_currency(currency: Column) -> Column:
    """NULL in, NULL out: a missing code is neither valid nor invalid."""
    return currency.isin(*KNOWN_CURRENCIES)
