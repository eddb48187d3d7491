"""Exact money arithmetic (decimal throughout)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.schemas import AMOUNT, AMOUNT_USD, RATE


def line_amount(quantity: Column, unit_price: Column) -> Column:
    # int * decimal(10,2) is decimal(21,2); narrowing it here keeps the later
    # product with the rate below 38 digits, so no fractional digit is lost
    return (quantity.cast("int") * unit_price).cast(AMOUNT)


def amount_usd(amount: Column, rate: Column) -> Column:
    return (rate.cast(RATE) * amount.cast(AMOUNT)).cast(AMOUNT_USD)


def convertible_usd(flag: str = "is_fx_convertible", amount: str = "line_amount_usd") -> Column:
    """The USD amount of a convertible line, otherwise NULL."""
    return F.when(F.col(flag), F.col(amount))
