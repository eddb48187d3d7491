"""Tables published by version: a reader sees the table before a load or after it, never between.

Files are never changed. A load writes the new content of the partitions it touches below
``data/load=<name>`` and then publishes a manifest, a small file that names the folder of every
partition; partitions that a load leaves alone keep their folder. A manifest is written under
another name and becomes the next version by one rename, so it is there whole or not at all.
Readers resolve the highest version. What no kept version names is removed by ``vacuum``.

There must be one writer at a time; a second one that publishes the same version is refused. A
manifest has one entry per partition, and partitions are calendar periods or runs.
"""

import json
from dataclasses import dataclass, field, replace
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmart.storage import delete, file_system, path_exists

MANIFESTS, DATA, LOAD = "_manifests", "data", "load"


@dataclass(frozen=True)
class Manifest:
    """Version, folders, ``{"order_date_day=2024-01-01": "load=..."}``, and what the writer noted."""

    version: int
    folders: dict[str, str]
    notes: dict[str, str] = field(default_factory=dict)

    def only(self, names) -> "Manifest":
        return replace(self, folders={n: f for n, f in self.folders.items() if n in names})


EMPTY = Manifest(0, {})


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    files, folder = file_system(spark, f"{path}/{MANIFESTS}")
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The newest version, or the given one; an empty manifest if nothing is published."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return EMPTY
        version = known[-1]
    files, place = file_system(spark, f"{path}/{MANIFESTS}/{version:012d}.json")
    stream = files.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(version, **json.loads(text))


def read(spark: SparkSession, path: str, schema: T.StructType, at: Manifest | None = None) -> DataFrame:
    """The published rows of one version, with the given columns; the newest if none is named.

    The partition column is read from the folders' names, so filters on it prune files. The
    version is resolved here: the frame keeps reading it whatever is published later.
    """
    at = manifest(spark, path) if at is None else at
    if not at.folders:
        return spark.createDataFrame([], schema)
    base = f"{path}/{DATA}"
    places = [f"{base}/{load}/{name}" for name, load in sorted(at.folders.items())]
    return spark.read.schema(schema).option("basePath", base).parquet(*places).select(*schema.names)


def partition_name(spark: SparkSession, column: str, value: str | None) -> str:
    """The folder that the file writer gives a value, which is passed as text."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(column, value)


def new_load() -> str:
    return f"{LOAD}=at-{uuid4().hex}"


def load_path(path: str, load: str) -> str:
    return f"{path}/{DATA}/{load}"


def written_partitions(spark: SparkSession, path: str, load: str) -> list[str]:
    """Names of the partition folders that a load has written."""
    files, folder = file_system(spark, load_path(path, load))
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    return [n for n in names if "=" in n]


def publish(
    spark: SparkSession,
    path: str,
    before: Manifest,
    touched: set[str],
    load: str,
    notes: dict[str, str] | None = None,
) -> Manifest:
    """Make the next version: partitions in ``touched`` are those of the load, or gone.

    ``notes`` are published with it, so they always belong to these rows.
    """
    folders = {n: f for n, f in before.folders.items() if n not in touched}
    folders |= {n: load for n in written_partitions(spark, path, load)}
    after = Manifest(before.version + 1, folders, before.notes | (notes or {}))
    files, folder = file_system(spark, f"{path}/{MANIFESTS}")
    files.mkdirs(folder)
    temporary = write_text(spark, f"{path}/{MANIFESTS}/_{uuid4().hex}", json.dumps({"folders": folders, "notes": after.notes}, indent=0))
    switch(spark, temporary, f"{path}/{MANIFESTS}/{after.version:012d}.json")
    return after


def replace_all(df: DataFrame, path: str) -> Manifest:
    """Publish a small table that has no partitions, in place of what it was."""
    spark, load = df.sparkSession, new_load()
    df.write.parquet(f"{load_path(path, load)}/all=0")
    return publish(spark, path, manifest(spark, path), {"all=0"}, load)


def write_text(spark: SparkSession, path: str, text: str) -> str:
    files, place = file_system(spark, path)
    out = files.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return path


def switch(spark: SparkSession, temporary: str, final: str) -> None:
    """The one step that readers notice."""
    files, place = file_system(spark, final)
    if files.exists(place) or not files.rename(file_system(spark, temporary)[1], place):
        raise RuntimeError(f"another writer has published {final}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove old manifests, and loads that no kept version names.

    Not during a load: its files are not named yet. ``keep`` versions stay for readers that
    resolved them earlier.
    """
    known = versions(spark, path)
    kept = known[-keep:]
    named = {load for v in kept for load in manifest(spark, path, v).folders.values()}
    for version in known[:-keep]:
        delete(spark, f"{path}/{MANIFESTS}/{version:012d}.json")
    if not path_exists(spark, f"{path}/{DATA}"):
        return
    files, folder = file_system(spark, f"{path}/{DATA}")
    for status in files.listStatus(folder):
        if status.getPath().getName() not in named:
            delete(spark, f"{path}/{DATA}/{status.getPath().getName()}")
