"""From raw documents to packed training sequences, in stages that are each written.

Defined results
    null text               fails the quality rules
    very long text          judged, hashed and cut whole; packed in several pieces
    ties, repeated rows     one row of equal texts stays: the largest id, then the last by file and place
    empty table             empty result
    clashing extra columns  kept as they are up to packing; a column ``__row_id`` may not be named so
    no ``n_chars``          nothing to bring up to date
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import exact_dedup, packing, quality_rules, simhash, suffix_dedup
from starmart.llm.common import land, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs, exact_dedup.new_index(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose their repeated passages; ``n_chars``, if there, follows the text."""
    cut = suffix_dedup.cut_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences with their tokens: ``ids`` are little-endian unsigned 32-bit integers."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("suffix-array dedup", repeats),
    ("best-fit packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = read(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
