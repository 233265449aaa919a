import random
import re

import pytest
from pyspark.sql import functions as F

from orebed.llm.queries import REGISTRY
from orebed.llm.sketch import compare_with_edit, containment, likeness, merged, sketch


def words(count, seed):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(count))


def test_estimates(spark):
    long = words(20_000, 1)
    part = " ".join(long.split()[5_000:6_000])
    mixed = " ".join(long.split()[:500]) + " " + words(500, 2)
    rows = [("part", part, long), ("half", mixed, long), ("none", words(1_000, 3), long)]
    df = spark.createDataFrame(rows, "k string, a string, b string").select("k", sketch(F.col("a")).alias("a"), sketch(F.col("b")).alias("b"))
    found = {r.k: (r.c, r.j) for r in df.select("k", containment(F.col("a"), F.col("b")).alias("c"), likeness(F.col("a"), F.col("b")).alias("j")).collect()}
    assert found["part"][0] == 1 and found["none"] == (0, 0)
    assert abs(found["half"][0] - 0.5) < 0.1
    assert abs(found["part"][1] - 0.05) < 0.01


def test_sketches_merge(spark):
    texts = [words(300, seed) for seed in range(3)]
    parts = spark.createDataFrame([(1, t) for t in texts], "k int, t string").select("k", sketch(F.col("t")).alias("s"))
    together = merged(parts, ["k"], "s").first().s
    assert together == sorted(set().union(*(r.s for r in parts.collect())))


def rows():
    result = [(i, words(i * 7 % 90, i)) for i in range(60)]
    result += [(100, ""), (101, None), (102, "one two"), (103, "ab"), (104, "é𝒳ñ" * 40), (105, " \n\t x\x0by "), (106, words(4_000, 9))]
    result += [(107, words(50, 5)), (108, words(50, 5)), (109, "a b c d e"), (110, "a b c d")]
    return result


@pytest.mark.parametrize("some", [slice(None), slice(3, 4), slice(0, 0), slice(60, 63)])
def test_against_sql(spark, tmp_path, matches_sql, some):
    docs = spark.createDataFrame(rows()[some], "doc_id bigint, text string").withColumn("row", F.lit(1)).withColumn("place", F.lit("x"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    matches_sql(REGISTRY["op2_scaled_sketch"](spark, str(tmp_path)), "op2_scaled_sketch", documents=docs)


def test_repeated_rows_and_null_ids(spark, tmp_path, matches_sql):
    repeated = [(7, words(40, 1))] * 3 + [(None, words(30, 2))] * 2 + [(9, words(20, 3))]
    docs = spark.createDataFrame(repeated, "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    matches_sql(REGISTRY["op2_scaled_sketch"](spark, str(tmp_path)), "op2_scaled_sketch", documents=docs)
    assert compare_with_edit(docs).count() == 6


def test_query(spark, sf_dir, matches_sql):
    matches_sql(REGISTRY["op2_scaled_sketch"](spark, sf_dir), "op2_scaled_sketch")


def test_no_python_in_the_plan(spark, sf_dir):
    plan = REGISTRY["op2_scaled_sketch"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
