import pytest
from pyspark.sql import functions as F

from starmart.operators import skew
from starmart.operators.skew import HotKeys, find_hot_keys, is_small, join_spread


@pytest.fixture
def lines(spark):
    # key 7 owns a third of the rows, another third has no key at all
    return spark.range(9000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id"))
        .alias("key"),
    )


@pytest.fixture
def names(spark):
    return spark.range(0, 9000, 2).select(
        F.col("id").alias("key"), (F.col("id") * 10).alias("v")
    ).union(spark.createDataFrame([(7, 70)], "key long, v long"))


def test_finds_the_hot_keys(spark, lines):
    hashes = {r[0] for r in spark.sql("select xxhash64(7L) union select xxhash64(null)").collect()}
    # a third of the rows are 2.7 halves of each of four partitions
    assert find_hot_keys(lines, ["key"]) == dict.fromkeys(hashes, 3)
    assert find_hot_keys(spark.range(9000), ["id"]) == {}


def test_one_pass_finds_the_hot_keys_of_all_joins(spark, lines, names, force_shuffle, monkeypatch):
    df = lines.withColumn("other", F.when(F.col("id") < 6000, 2).otherwise(F.col("id")))
    both = HotKeys(df, ["key"], ["other"])
    assert [both.of(k) for k in (["key"], ["other"])] == [find_hot_keys(df, k) for k in (["key"], ["other"])]
    assert both.of(["other"]) and both.of(["key"]) != both.of(["other"])

    sketched = []
    found = skew.HotKeys._found.func
    counted = skew.cached_property(lambda self: sketched.append(self.keys) or found(self))
    counted.__set_name__(skew.HotKeys, "_found")
    monkeypatch.setattr(skew.HotKeys, "_found", counted)
    shared, again = HotKeys(df, ["key"], ["other"]), names.select(F.col("key").alias("other"), F.col("v").alias("w"))
    first = join_spread(df, names, ["key"], "left", ["id"], hot_in=shared)
    second = join_spread(first, again, ["other"], "left", ["id"], hot_in=shared)
    plain = df.join(names, "key", "left").join(again, "other", "left").select(second.columns)
    assert sorted(map(tuple, second.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert sketched == [(["key"], ["other"])]


def test_parts_follow_the_shares(spark):
    """Many hot keys do not multiply: all parts together are at most four per partition."""
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        many = spark.range(64_000).select((F.col("id") % 100).alias("key"))
        parts = find_hot_keys(many, ["key"])
        assert len(parts) == 100 and set(parts.values()) == {2}
        one = spark.range(64_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("key"))
        assert list(find_hot_keys(one, ["key"]).values()) == [64]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(lines, names, how, force_shuffle):
    plain = lines.join(names, "key", how)
    spread = join_spread(lines, names, ["key"], how, ["id"])
    assert spread.columns == plain.columns
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(
        map(tuple, plain.collect()), key=str
    )


def test_hot_rows_are_spread(spark, lines, names, force_shuffle):
    # adaptive execution would merge partitions as small as these
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 32)
    try:
        spread = join_spread(lines, names, ["key"], "inner", ["id"]).filter("key = 7")
        sizes = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sum(r["count"] for r in sizes) == 3000
    # parts are hashed to partitions, so some get several; none gets a large share
    assert max(r["count"] for r in sizes) <= 3000 // 4


def test_residual_condition(lines, names, force_shuffle):
    spread = join_spread(
        lines, names, ["key"], "left", ["id"], residual=F.col("id") < F.col("v")
    )
    matched = {r.id for r in spread.filter("v is not null").collect()}
    assert spread.count() == 9000
    expected = {i for i in range(0, 70, 3)} | {i for i in range(2, 9000, 3) if i % 2 == 0}
    assert matched == expected


def test_full_join_is_refused(lines, names):
    with pytest.raises(ValueError):
        join_spread(lines, names, ["key"], "full_outer", ["id"])


def test_size_is_proven_by_rows_and_fixed_widths(spark, monkeypatch):
    table = spark.range(1000)
    assert is_small(table)
    assert not is_small(table.select(F.col("id").cast("string")))
    monkeypatch.setattr("starmart.operators.skew.BROADCAST_BYTES", 1000)
    assert not is_small(table)


def test_a_side_that_an_explode_made_large_is_not_broadcast(spark, tmp_path, monkeypatch):
    """The optimizer's statistics are those of the file below the explode."""
    spark.range(50).select(F.col("id").alias("key")).write.parquet(f"{tmp_path}/small")
    small = spark.read.parquet(f"{tmp_path}/small")
    right = small.select("key", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("from"))
    left = spark.range(1000).select("id", (F.col("id") % 60).alias("key"))
    monkeypatch.setattr("starmart.operators.skew.BROADCAST_BYTES", 1000)
    for joined in (
        join_spread(left, right, ["key"], "left", ["id"]),
        join_spread(left, right, ["key"], "left", ["id"], residual=F.col("id") >= F.col("from")),
        left.join(skew.broadcast_if_small(right), "key", "left"),
    ):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
