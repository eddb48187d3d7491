import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.operators.ordering import assign_sequential_id, global_rank, rank_all


def values(spark):
    # a third of the rows share one value, some have none
    return spark.range(5000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 500)
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.xxhash64("id") % 1000)
        .cast("decimal(18,2)")
        .alias("v"),
    )


def window_rank(df):
    return df.withColumn("r", F.rank().over(W.orderBy(F.col("v").desc_nulls_last())))


def test_rank_equals_window_rank(spark):
    df = values(spark)
    ours = global_rank(df, "v", "r", ["id"])
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, window_rank(df).collect()))


def test_rank_equals_window_rank_without_broadcast(spark, force_shuffle):
    df = values(spark)
    ours = global_rank(df, "v", "r", ["id"])
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, window_rank(df).collect()))


@pytest.mark.parametrize("columns", [["v", "w"], ["w", "v", "f"]])
def test_several_ranks_equal_windows(spark, columns, force_shuffle):
    df = values(spark).withColumns({"w": F.col("id") % 17, "f": (F.col("id") % 7).cast("double")})
    names = dict(zip("abc", columns))
    have = rank_all(df, names, ["id"])
    over = {n: F.rank().over(W.orderBy(F.col(c).desc_nulls_last())) for n, c in names.items()}
    assert sorted(map(tuple, have.collect())) == sorted(map(tuple, df.withColumns(over).collect()))


def test_sequential_ids_follow_the_order(spark):
    df = spark.range(0, 5000, 1, 7).select(F.xxhash64("id").alias("k"), "id")
    rows = assign_sequential_id(df, "n", ["k"]).orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 5001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)
