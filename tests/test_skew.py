import random

import pytest
from pyspark.sql import functions as F

from orebed.operators.skew import _broadcast_limit, heavy_keys, lead_by_key, skew_join
from orebed.session import fit_shuffle, plan_bytes
from tests.conftest import rows


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    left = [(rng.choice(["hot"] * 40 + [None] * 20 + [f"k{i}" for i in range(60)]), i) for i in range(3000)]
    right = [("hot", 1), *[(f"k{i}", i) for i in range(0, 60, 2)], (None, 5), (None, 6)]
    return spark.createDataFrame(left, "k string, n int"), spark.createDataFrame(right, "k string, v int")


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
# Partitions of a few KB count as skewed.
SMALL_SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture
def as_if_large(spark):
    for name, value in {**NO_BROADCAST, **SMALL_SKEW}.items():
        spark.conf.set(name, value)
    yield
    for name in {**NO_BROADCAST, **SMALL_SKEW}:
        spark.conf.unset(name)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_heavy_keys(spark, sides):
    found = heavy_keys(sides[0], ["k"], 200)
    hashes = [row[0] for row in spark.createDataFrame([("hot",), (None,)], "k string").select(F.xxhash64("k")).collect()]
    assert list(found) == hashes and found[hashes[0]] > found[hashes[1]] > 200
    assert heavy_keys(sides[0].limit(0), ["k"], 0) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_equals_plain_join(sides, as_if_large, how):
    left, right = sides
    expected = left.join(right.filter("k is not null"), ["k"], how)
    joined = skew_join(left, right, ["k"], how)
    assert joined.columns == expected.columns
    assert rows(joined) == rows(expected)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_hot_key_is_split_beside_an_aggregate(spark, as_if_large, how):
    """The left side is read once, and its hot rows meet the right one in several tasks."""
    left = spark.range(0, 40_000, numPartitions=16).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    counted = spark.range(0, 60_000, 2).select((F.col("id") % 30_000).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    joined = skew_join(left, counted, ["k"], how)
    plan = final_plan(joined).split("Initial Plan")[0]
    assert "skew=true" in plan and plan.count("Range (0, 40000") == 1
    expected = left.join(counted, "k", how)
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    # Without the exchange of its own it is not split.
    assert "skew=true" not in final_plan(left.join(counted, "k", how)).split("Initial Plan")[0]


def test_two_key_columns(spark, as_if_large):
    left = spark.createDataFrame([("a", 1, i) for i in range(50)] + [("a", 2, 1), ("b", None, 2)], "a string, b int, n int")
    right = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "a string, b int, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(skew_join(left, right, ["a", "b"], how)) == rows(left.join(right, ["a", "b"], how))


@pytest.mark.parametrize("hot_rows", [10_000, 300, 60])
def test_lead_by_key(spark, hot_rows):
    rng = random.Random(2)
    data = [(rng.choice(["hot"] * 8 + ["warm"] * 3 + [None] * 2 + list("abcdef")), rng.randrange(500), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, seq int, id int").repartition(5)
    following = {}
    by_key = {}
    for key, seq, number in sorted(data, key=lambda row: (str(row[0]), row[1], row[2])):
        by_key.setdefault(key, []).append((seq, number))
    for key, items in by_key.items():
        for here, there in zip(items, [*items[1:], (None, None)]):
            following[here[1]] = there[0]
    out = lead_by_key(df, ["k"], ["seq", "id"], "nxt", hot_rows=hot_rows)
    assert {row["id"]: row["nxt"] for row in out.collect()} == following
    assert out.columns == ["k", "seq", "id", "nxt"]


def test_slices_bound_the_window(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), (F.col("id") % 97).alias("seq"), "id")
    out = lead_by_key(df, ["k"], ["seq", "id"], "nxt", hot_rows=500)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_slice" in plan


def test_one_heavy_key_among_many(spark):
    """Nearly unique keys beside one key with a third of all rows."""
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    found = heavy_keys(df, ["k"], 20_000)
    assert len(found) == 1 and 90_000 < sum(found.values()) < 110_000
    out = lead_by_key(df, ["k"], ["id"], "nxt", hot_rows=20_000)
    assert out.filter("nxt = id + 3 AND k = -1").count() == 99_999
    assert out.filter("nxt IS NULL").count() == 200_001


def test_fit_shuffle_only_raises(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    df = spark.range(100_000)
    try:
        assert fit_shuffle(df) is df and spark.conf.get(name, None) is None
        fit_shuffle(df, 8_000)
        assert spark.conf.get(name) == "100"
        fit_shuffle(df, 80_000)
        assert spark.conf.get(name) == "100"
        fit_shuffle(df, 1)
        assert spark.conf.get(name) == "50000"
    finally:
        spark.conf.unset(name)


def test_star_join_with_two_hot_dimensions(spark):
    from orebed.operators.joins import star_join

    fact = spark.createDataFrame([("hot", i % 3, i) for i in range(90)] + [(f"c{i}", 7 + i, i) for i in range(9)], "a string, b int, n int")
    first = spark.createDataFrame([("hot", 1), *[(f"c{i}", i) for i in range(9)]], "a string, x int")
    second = spark.range(20).selectExpr("cast(id as int) as b", "id * 2 as y")
    expected = rows(fact.join(first, "a").join(second, "b").select("a", "b", "n", "x", "y"))
    settings = {**NO_BROADCAST, **SMALL_SKEW}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert rows(star_join(fact, [(first, ["a"]), (second, ["b"])]).select("a", "b", "n", "x", "y")) == expected
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_size_helpers(spark):
    assert plan_bytes(spark.range(1000)) == 8000
    for text, number in [("10MB", 10 << 20), ("10485760b", 10485760), ("-1", -1), ("2g", 2 << 30), ("512", 512)]:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert _broadcast_limit(spark.range(1)) == number
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
