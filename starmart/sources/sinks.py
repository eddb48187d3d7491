"""Report files."""

from pyspark.sql import Column, DataFrame


def write_report_csv(
    report: DataFrame, path: str, columns: list[str], order_by: list[Column], one_file: bool = False
) -> None:
    """Write a sorted CSV with header from the executors.

    The sort is by range, so part files follow each other in order. ``one_file`` is for
    reports of fixed size (24 hours, one KPI row) only.
    """
    out = report.select(*columns)
    if one_file:
        out = out.coalesce(1).sortWithinPartitions(*order_by) if order_by else out.coalesce(1)
    elif order_by:
        out = out.orderBy(*order_by)
    out.write.mode("overwrite").option("header", True).csv(path)
