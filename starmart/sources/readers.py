"""Typed readers for raw extracts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import FX_RESPONSES, RAW_TABLES
from starmart.storage import land

_REJECTED = "_rejected"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with declared types; a row that does not parse fails the job."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType, rejects: str) -> DataFrame:
    """Rows that parse; the others go to the table ``rejects`` with their file and their line.

    The file is parsed once and written, with all its columns, so what counts as malformed does
    not depend on the columns that a reader asks for. A rerun replaces the rejects.
    """
    kept = T.StructType([*schema.fields, T.StructField(_REJECTED, T.StringType())])
    parsed = land(
        spark.read.schema(kept)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _REJECTED)
        .option("enforceSchema", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
        .withColumn("file", F.col("_metadata.file_path")),
        "parsed",
    )
    bad = parsed.filter(F.col(_REJECTED).isNotNull())
    bad.select("file", F.col(_REJECTED).alias("line")).write.mode("overwrite").parquet(rejects)
    return parsed.filter(F.col(_REJECTED).isNull()).select(*schema.names)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_raw(
    spark: SparkSession, root: str, table: str, extract: str | None = None, rejects: str | None = None
) -> DataFrame:
    """Read one raw table; ``extract`` names another extract with the same contract,
    for instance the first batch instead of the full one. With ``rejects``, rows that do not
    parse are written to ``rejects/<extract>`` instead of ending the job."""
    path = f"{root}/{extract or table}.csv"
    if rejects:
        return read_csv_with_rejects(spark, path, RAW_TABLES[table], f"{rejects}/{extract or table}")
    return read_csv(spark, path, RAW_TABLES[table])


def read_fx_responses(spark: SparkSession, path: str) -> DataFrame:
    """Rate API answers: one document per file, ``responses`` is a list."""
    return spark.read.schema(FX_RESPONSES).option("multiLine", True).json(path)


def flatten_fx_responses(documents: DataFrame) -> DataFrame:
    """One row per (base, quote, date) from nested API answers."""
    return (
        documents.select(F.explode("responses").alias("answer"))
        .select("answer.base", "answer.date", F.explode("answer.rates").alias("quote", "rate"))
        .select(
            F.col("base").alias("base_currency"),
            F.col("quote").alias("quote_currency"),
            F.col("date").alias("rate_date"),
            F.col("rate"),
        )
    )


def contract_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """NULLs per NOT NULL column, all columns in one pass over the table."""
    required = [field.name for field in schema.fields if not field.nullable]
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required])
    return counts.unpivot([], required, "column_name", "null_rows")
