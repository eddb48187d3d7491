"""Helpers shared by the operators of this subpackage."""

import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.storage import land

__all__ = ["ROW_ID", "file_uri", "identified", "is_held_out", "land", "partitions", "read", "ship", "text_or_empty"]

ROW_ID = "__row_id"

_FILE, _PLACE = "__file", "__place"
_PLACE_BITS = 40  # a row's place in its file; the rest numbers 8 million files
_FILES_BYTES, _FILE_OVERHEAD = 128 * 1024 * 1024, 40


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` does, once per application."""
    _shipped(spark.sparkContext.applicationId, spark.sparkContext)


@cache
def _shipped(application: str, context) -> None:
    package = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"  # the driver's; Spark serves it
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def identified(docs: DataFrame) -> DataFrame:
    """The table with a number for each row that is the same in every scan.

    For a plain scan of Parquet files it is the file's place among their names and the row's
    place in the file, so it depends neither on how a scan is cut into tasks nor on the cores of
    the moment, and no row is written. Rows of anything else, or of more files than a broadcast
    may hold, are numbered as they are written, once. A column of this name is replaced.
    """
    named = docs.select(*[c for c in docs.columns if c != ROW_ID])
    if _is_scan(docs):
        place = docs.metadataColumn("_metadata")
        placed = docs.select(*named.columns, place["file_path"].alias(_FILE), place["row_index"].alias(_PLACE))
        files = placed.select(_FILE).distinct().withColumn("number", F.row_number().over(W.orderBy(_FILE)))
        files = land(files, "files")  # one row per file
        size = files.agg(F.sum(F.length(_FILE) + _FILE_OVERHEAD)).first()[0] or 0
        if size <= _FILES_BYTES:
            number = F.shiftleft(F.col("number").cast("long"), _PLACE_BITS).bitwiseOR(F.col(_PLACE))
            return placed.join(F.broadcast(files), _FILE).select(*named.columns, number.alias(ROW_ID))
    return land(named.withColumn(ROW_ID, F.monotonically_increasing_id()), "numbered")


def _is_scan(docs: DataFrame) -> bool:
    """Whether every row comes from one row of Parquet files."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation" and not plan.nodeName().startswith("Relation"):
        return False
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return False
    return True


def is_held_out(modulus: int, id_column: str = "doc_id", remainder: int = 2) -> Column:
    """Whether the document's crc32 leaves the remainder; a null id is never held out."""
    rest = F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus
    return F.coalesce(rest == remainder, F.lit(False))


def file_uri(folder: str) -> str:
    """file:/a, as Hadoop writes it, with the authority that pyarrow wants."""
    return f"file://{folder.removeprefix('file:')}" if folder.startswith("file:/") and not folder.startswith("file://") else folder


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
