"""Type-2 history kept as a log: each run adds what it opened and what it closed.

A run writes two folders, the versions it opened and the ends of the versions it closed, and
publishes both at once. So a night writes as much as has changed, however long the history and
however large the catalogue. Versions that are open are those opened and not closed.

Repeating a run compares with the runs before it only, and replaces its own two folders.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import published
from starmart.functions.calendar import local_time
from starmart.operators.scd2 import CHECKED_COLUMNS, compared

OPENED, CLOSED = "opened", "closed"


class History:
    """The log below ``path``, with the columns of an extract."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        columns: T.StructType,
        key: str = "product_id",
        checked: tuple[str, ...] = CHECKED_COLUMNS,
    ):
        self.spark, self.path, self.key, self.checked = spark, path, key, checked
        time = T.TimestampNTZType()
        self.opened = T.StructType([*columns.fields, T.StructField("valid_from", time)])
        self.closed = T.StructType([columns[key], T.StructField("valid_from", time), T.StructField("valid_to", time)])

    def add(self, extract: DataFrame, run_at: datetime) -> published.Manifest:
        """Log the differences between the versions open before ``run_at`` and the extract.

        A changed row closes its open version and opens a new one; a new key opens its first; a
        key missing from the extract stays open.
        """
        run = _run(run_at)
        before = published.manifest(self.spark, self.path)
        old = self._open_versions(_until(before, run - 1))
        change = compared(old, extract.select(*self.opened.names[:-1]), self.key, self.checked)
        load = published.new_load()
        folder = published.load_path(self.path, load)
        opened = change.filter("opens").select("new.*", local_time(run_at).alias("valid_from"))
        opened.write.parquet(f"{folder}/{OPENED}={run}")
        closed = change.filter("closes").select(f"old.{self.key}", "old.valid_from", local_time(run_at).alias("valid_to"))
        closed.write.parquet(f"{folder}/{CLOSED}={run}")
        return published.publish(self.spark, self.path, before, {f"{OPENED}={run}", f"{CLOSED}={run}"}, load)

    def versions(self, run_at: datetime | None = None) -> DataFrame:
        """All versions with ``valid_from`` and ``valid_to``, as they were after a run."""
        now = published.manifest(self.spark, self.path)
        opened, closed = self._logs(now if run_at is None else _until(now, _run(run_at)))
        return opened.join(closed, [self.key, "valid_from"], "left").select(*self.opened.names, "valid_to")

    def merge_runs(self, run_at: datetime) -> published.Manifest:
        """Put the logs of all runs up to one into that one's folders: fewer, larger files.

        Afterwards an earlier run can no longer be repeated or looked back to.
        """
        run, now = _run(run_at), published.manifest(self.spark, self.path)
        until, load = _until(now, run), published.new_load()
        folder = published.load_path(self.path, load)
        for name, log in zip((OPENED, CLOSED), self._logs(until)):
            log.write.parquet(f"{folder}/{name}={run}")
        return published.publish(self.spark, self.path, now, set(until.folders), load)

    def _logs(self, at: published.Manifest) -> tuple[DataFrame, DataFrame]:
        """(opened, closed), each key and start at most once."""
        return tuple(
            published.read(self.spark, self.path, schema, at.only([n for n in at.folders if n.startswith(f"{name}=")]))
            for name, schema in ((OPENED, self.opened), (CLOSED, self.closed))
        )

    def _open_versions(self, at: published.Manifest) -> DataFrame:
        opened, closed = self._logs(at)
        return opened.join(closed, [self.key, "valid_from"], "left_anti")


def _run(run_at: datetime) -> int:
    return int(f"{run_at:%Y%m%d%H%M%S}")


def _until(at: published.Manifest, run: int) -> published.Manifest:
    return at.only([n for n in at.folders if int(n.partition("=")[2]) <= run])
