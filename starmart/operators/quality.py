"""Data tests, the exception filter, the rate monitor and the reconciliation."""

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.fixed_values import (
    REASON_INVALID_CURRENCY,
    REASON_SEPARATOR,
    REASON_UNKNOWN_PRODUCT,
    UNKNOWN_PRODUCT_ID,
)


@dataclass(frozen=True)
class DataTest:
    model: str
    column: str  # unique: one column, or several of which some may be NULL ("a, b")
    kind: str  # not_null | unique | always_true | relationship
    severity: str = "error"  # error stops a build, warn only reports
    parent: str | None = None  # relationship: the model that must hold the value
    where: str | None = None  # unique: the boolean column that marks the rows in question

    @property
    def key(self) -> list[str]:
        return self.column.split(", ")

    @property
    def label(self) -> str:
        return f"{self.column} where {self.where}" if self.where else self.column


def _tests(kind: str, *columns: str, **options) -> list[DataTest]:
    return [DataTest(*name.split("."), kind, **options) for name in columns]


# The tests that come with the models.
MODEL_TESTS = (
    *_tests(
        "not_null",
        "stg_customers.customer_id",
        "stg_customers.email",
        "stg_orders.order_id",
        "stg_orders.customer_id",
        "stg_orders.is_valid_currency",
        "stg_order_items.order_item_id",
        "stg_order_items.order_id",
        "stg_order_items.product_id",
        "stg_products.product_id",
        "stg_fx_rates.currency",
        "stg_fx_rates.rate_to_usd",
        "dim_customers.customer_id",
        "dim_products.product_id",
        "dim_date.date_day",
        "dim_time_of_day.hour_of_day",
        "fact_order_items.order_item_id",
        "fact_order_items.order_id",
        "fact_order_items.customer_id",
        "fact_order_items.product_id",
    ),
    *_tests(
        "unique",
        "stg_customers.customer_id",
        "stg_orders.order_id",
        "stg_order_items.order_item_id",
        "stg_products.product_id",
        "dim_customers.customer_id",
        "dim_date.date_day",
        "dim_time_of_day.hour_of_day",
        "fact_order_items.order_item_id",
    ),
    *_tests("unique", "dim_products.product_id, valid_from"),
    *_tests("unique", "dim_products.product_id", where="is_current"),
    *_tests(
        "always_true",
        "stg_orders.is_valid_currency",
        "stg_order_items.is_valid_currency",
        "fact_order_items.is_fx_convertible",
        severity="warn",
    ),
    *_tests("relationship", "fact_order_items.customer_id", parent="dim_customers"),
    *_tests("relationship", "fact_order_items.product_id", parent="dim_products"),
)


def run_tests(
    tables: dict[str, DataFrame],
    tests: Iterable[DataTest] = MODEL_TESTS,
    touched: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per test with its number of failing rows (keys, for ``unique``).

    All row-wise tests of a model share one pass. ``unique`` and ``relationship`` count
    per value before anything is compared, so a frequent value is one row by then.

    ``touched`` names the rows of a model that a load has written since the model was last
    tested. Only these rows are tested, and their keys are looked for among all others: what
    passed before and was not written cannot fail now, as long as parents lose no key.
    """
    tests, touched = list(tests), touched or {}
    rows = tables | touched
    results = [
        _row_tests(model, df, [t for t in tests if t.model == model])
        for model, df in rows.items()
    ]
    results += [
        _unique_test(tables[t.model], t, touched.get(t.model)) for t in tests if t.kind == "unique"
    ]
    results += [
        _relationship_test(rows[t.model], tables[t.parent], t)
        for t in tests
        if t.kind == "relationship"
    ]
    found = reduce(DataFrame.unionByName, [r for r in results if r is not None])
    bad = F.col("failures") > 0
    status = F.when(bad & (F.col("severity") == "error"), "fail").when(bad, "warn").otherwise("pass")
    return found.withColumn("status", status)


def raise_on_failure(results: DataFrame) -> None:
    """Severity gate: stop when an error-level test failed. One row per test at most."""
    failed = results.filter(F.col("status") == "fail").collect()
    if failed:
        raise ValueError(
            "; ".join(f"{r.model}.{r.column_name} {r.test}: {r.failures}" for r in failed)
        )


def _labels(test: DataTest) -> list[Column]:
    return [
        F.lit(test.model).alias("model"),
        F.lit(test.label).alias("column_name"),
        F.lit(test.kind).alias("test"),
        F.lit(test.severity).alias("severity"),
    ]


def _row_tests(model: str, df: DataFrame, tests: list[DataTest]) -> DataFrame | None:
    failing = {
        "not_null": lambda c: F.col(c).isNull(),
        "always_true": lambda c: ~F.col(c),
    }
    row_wise = [t for t in tests if t.kind in failing]
    if not row_wise:
        return None
    counts = df.agg(
        F.array(
            *[
                F.struct(*_labels(t), F.count_if(failing[t.kind](t.column)).alias("failures"))
                for t in row_wise
            ]
        ).alias("counts")
    )
    return counts.select(F.inline("counts"))


def _unique_test(df: DataFrame, test: DataTest, touched: DataFrame | None = None) -> DataFrame:
    def keys(rows: DataFrame) -> DataFrame:
        rows = rows.filter(test.where) if test.where else rows
        return rows.filter(F.col(test.column).isNotNull()) if len(test.key) == 1 else rows

    rows = keys(df)
    if touched is not None and len(test.key) == 1:
        mine = keys(touched).select(test.column).distinct()
        span = mine.agg(F.min(test.column), F.max(test.column)).first()
        # the range of the keys reaches the scan; growing ids skip all older row groups
        in_range = F.col(test.column).between(F.lit(span[0]), F.lit(span[1]))
        rows = rows.filter(in_range).select(test.column).join(mine, test.column, "left_semi")
    repeated = rows.groupBy(*test.key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(*_labels(test), "failures")


def _relationship_test(df: DataFrame, parent: DataFrame, test: DataTest) -> DataFrame:
    per_value = (
        df.filter(F.col(test.column).isNotNull())
        .groupBy(test.column)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    orphans = per_value.join(parent.select(test.column), test.column, "left_anti")
    total = F.coalesce(F.sum("rows"), F.lit(0)).alias("failures")
    return orphans.agg(total).select(*_labels(test), "failures")


def is_exception() -> Column:
    """A fact row that cannot be fully trusted. A NULL validity flag does not hide a row:
    its line is not convertible either."""
    return (
        ~F.col("is_valid_currency") | F.col("is_unknown_product") | ~F.col("is_fx_convertible")
    )


def exceptions(fact: DataFrame) -> DataFrame:
    """Every exception with its flags; one line may have several reasons."""
    invalid, unknown = ~F.col("is_valid_currency"), F.col("is_unknown_product")
    reasons = F.concat_ws(
        REASON_SEPARATOR,
        F.when(invalid, REASON_INVALID_CURRENCY),
        F.when(unknown, REASON_UNKNOWN_PRODUCT),
    )
    return fact.filter(is_exception()).select(
        "order_item_id",
        "order_id",
        "order_date",
        "product_id",
        "currency",
        "line_amount_native",
        invalid.alias("flag_invalid_currency_code"),
        unknown.alias("flag_product_id_not_in_catalogue"),
        (~F.col("is_fx_convertible")).alias("flag_fx_conversion_failed"),
        reasons.alias("exception_reasons"),
    )


def exception_rate_by_day(
    fact: DataFrame, history_rows: int = 28, max_rate: float = 0.5, deviations: float = 3.0
) -> DataFrame:
    """Daily exception rate against a fixed limit and against its own recent history, the
    last ``history_rows`` days that have lines.

    The window runs over one row per day, which the calendar bounds.
    """
    daily = fact.groupBy("order_date_day").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(is_exception()).alias("exceptions")
    )
    rate = F.col("exceptions") / F.col("lines")
    earlier = W.orderBy("order_date_day").rowsBetween(-history_rows, -1)
    usual, spread = F.avg("exception_rate").over(earlier), F.stddev("exception_rate").over(earlier)
    return daily.withColumn("exception_rate", rate).select(
        "order_date_day",
        "lines",
        "exceptions",
        "exception_rate",
        usual.alias("usual_rate"),
        spread.alias("usual_deviation"),
        (F.col("exception_rate") > max_rate).alias("is_over_limit"),
        F.coalesce(
            F.abs(F.col("exception_rate") - usual) > deviations * spread, F.lit(False)
        ).alias("is_unusual"),
    )


def reconcile(fact: DataFrame, reported: DataFrame) -> DataFrame:
    """Reported products plus the placeholder must add up to the whole fact."""
    placeholder = F.col("product_id") == UNKNOWN_PRODUCT_ID
    usd = F.when(F.col("is_fx_convertible"), F.col("line_amount_usd"))
    zero = F.lit(0)
    whole = fact.agg(
        F.coalesce(F.sum("quantity"), zero).alias("fact_units"),
        F.coalesce(F.sum(F.when(placeholder, F.col("quantity"))), zero).alias("unknown_units"),
        F.coalesce(F.sum(usd), zero).alias("fact_revenue_usd"),
        F.coalesce(F.sum(F.when(placeholder, usd)), zero).alias("unknown_revenue_usd"),
    )
    parts = reported.agg(
        F.coalesce(F.sum("units_sold"), zero).alias("reported_units"),
        F.coalesce(F.sum("revenue_usd"), zero).alias("reported_revenue_usd"),
    )
    # one row each, laid over each other
    both = whole.unionByName(parts, allowMissingColumns=True)
    totals = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return totals.withColumn(
        "is_reconciled",
        (F.col("fact_units") == F.col("reported_units") + F.col("unknown_units"))
        & (
            F.col("fact_revenue_usd")
            == F.col("reported_revenue_usd") + F.col("unknown_revenue_usd")
        ),
    )
