"""Written tables: the shared work folder and the layout of the marts.

Intermediate results that several jobs read are written as parquet below the folder
named by ``spark.checkpoint.dir``. A written table cuts the lineage, survives the loss
of any executor, and gives Catalyst a measured size.
"""

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_TASK = 2_000_000
ROWS_PER_FILE = 10_000_000
COMPRESSION = "zstd"

# Bloom filters of a lookup column, chosen per row group between 4 KB and 16 MB
_LOOKUP_MAX_BYTES = 16 * 1024 * 1024
_LOOKUP_CANDIDATES = 13
_LOOKUP_FALSE_SHARE = 0.0001


def work_dir(spark: SparkSession) -> str:
    """The shared folder. Only a local session may leave it unset; it then works beside its
    warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid4().hex}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the work folder and return the written table.

    The table stays, because the caller's result still reads it; the shared folder's
    retention removes it.
    """
    return _write_and_read(df, new_path(df.sparkSession, name))


@contextmanager
def landed(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A written table for the length of one job."""
    path = new_path(df.sparkSession, name)
    try:
        yield _write_and_read(df, path)
    finally:
        delete(df.sparkSession, path)


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_clustered(
    df: DataFrame,
    path: str,
    partition_by: str,
    cluster_by: tuple[str, ...],
    spread_by: str,
    mode: str = "errorifexists",
    size: tuple[int, int] | None = None,
    lookup_by: str | None = None,
) -> None:
    """Write a table as one directory per ``partition_by`` value, clustered inside.

    The shuffle is by range over partition, cluster columns and the unique ``spread_by``,
    so a day that holds a third of all rows becomes many tasks and files, and every file
    covers a narrow product range that row-group statistics can skip. The number of
    tasks follows from the number of rows, so a small delta does not make small files
    and a large backfill does not make large tasks. ``size`` gives rows and directories, if
    the caller knows about how many; otherwise both are counted. ``lookup_by`` names a column
    of unordered values that gets Bloom filters, so a search for few of them skips row groups.
    """
    if size is None:
        counted = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(partition_by).alias("dirs"))
        size = tuple(counted.first())
    tasks = tasks_of(df.sparkSession, *size)
    order = [partition_by, *cluster_by, spread_by]
    _write_sorted(df.repartitionByRange(tasks, *order), path, order, mode, lookup_by)


def tasks_of(spark: SparkSession, rows: int, dirs: int) -> int:
    """How many tasks write so many rows into so many directories."""
    return max(-(-rows // ROWS_PER_TASK), min(spark.sparkContext.defaultParallelism, dirs), 1)


def write_as_cut(
    df: DataFrame, path: str, partition_by: str, cluster_by: tuple[str, ...], spread_by: str, lookup_by: str | None = None
) -> None:
    """Add rows that are read from such a table, or cut by ranges, without a shuffle: each task writes
    the rows of its files, whose narrow ranges stay, and small files of one partition come together."""
    _write_sorted(df, path, [partition_by, *cluster_by, spread_by], "append", lookup_by)


def _write_sorted(df: DataFrame, path: str, order: list[str], mode: str, lookup_by: str | None) -> None:
    (
        df.sortWithinPartitions(*order)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .options(**(_lookup_options(lookup_by) if lookup_by else {}))
        .partitionBy(order[0])
        .parquet(path)
    )


def _lookup_options(column: str) -> dict[str, str]:
    """One wrong answer in ten thousand, so a thousand keys still skip nine row groups in ten."""
    prefix = "parquet.bloom.filter"
    return {
        f"{prefix}.enabled#{column}": "true",
        f"{prefix}.adaptive.enabled": "true",
        f"{prefix}.candidates.number#{column}": str(_LOOKUP_CANDIDATES),
        f"{prefix}.fpp#{column}": str(_LOOKUP_FALSE_SHARE),
        f"{prefix}.max.bytes": str(_LOOKUP_MAX_BYTES),
    }


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a name."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = file_system(spark, path)
    return files.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    files, hadoop_path = file_system(spark, path)
    files.delete(hadoop_path, True)
