import random
import re

import pytest
from pyspark.sql import functions as F

from orebed.llm.mixing import mix, mixed_documents
from orebed.llm.queries import REGISTRY


def frame(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        source = rng.choice(["a", "big", "big", "big", "é", "", None, "zz"])
        rows.append((i, rng.choice([" ", "\n\t"]).join("w" for _ in range(rng.randrange(60))), source, 7))
    rows += [(1000, None, "empty", 0), (1001, "", "empty", 0), (None, "no id here", "a", 0), (None, "no id here", "a", 0)]
    rows += [(3, "same id", "a", 0), (2007, "one " * 3000, "long", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")


def water_fill(sizes, weights, share, cap):
    """Clamp and reshare until none is above."""
    goal = share * sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free = {}, set(order)
    while free:
        level = (goal - sum(target.values())) / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] >= cap * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in free}
        target |= {s: cap * sizes[s] for s in above}
        free -= above
    return target


@pytest.mark.parametrize("share, cap", [(1.5, 2.0), (0.4, 1.0), (2.0, 2.0), (2.5, 3.0), (0.0, 2.0)])
def test_targets_and_totals(spark, share, cap):
    docs = frame(spark)
    rows = mix(docs, share=share, cap=cap).collect()
    sources = {r.doc_id: r.source for r in docs.filter("doc_id is not null and doc_id <> 3").collect()}
    sizes, taken, targets = {}, {}, {}
    for row in docs.collect():
        sizes[row.source] = sizes.get(row.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", row.text or ""))
    assert len(rows) == docs.count()
    for row in rows:
        assert 0 <= row.taken <= cap * row.size
        if row.doc_id in sources:
            source = sources[row.doc_id]
            assert row.source_size == sizes[source]
            targets[source] = row.target
    expected = water_fill(sizes, (5, 2, 1), share, cap)
    assert targets == pytest.approx({s: t for s, t in expected.items()})
    by_source = mix(docs, share=share, cap=cap).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    for row in by_source:
        assert abs(row.t - row.target) <= 0.51
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mix(docs, share=share, cap=cap).collect()), key=repr)


def test_documents_follow_the_counts(spark):
    docs = frame(spark).withColumn("_size", F.lit("x")).withColumn("place", F.lit(1))
    mixed = mixed_documents(docs)
    assert mixed.schema.names == docs.schema.names
    count = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    got, ids = {}, {}
    for row in mixed.collect():
        got[row.doc_id] = got.get(row.doc_id, 0) + count(row.text)
    for row in mix(docs).collect():
        ids[row.doc_id] = ids.get(row.doc_id, 0) + row.taken
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in ids.items() if v}
    assert mixed.filter("doc_id = 1000").count() == mixed.filter("doc_id = 1001").count() == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mix(docs).count() == mixed_documents(docs).count() == 0


def test_query(spark, sf_dir, matches_sql):
    matches_sql(REGISTRY["op9_mixing"](spark, sf_dir), "op9_mixing")


def test_query_on_odd_rows(spark, tmp_path, matches_sql):
    docs = frame(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    matches_sql(REGISTRY["op9_mixing"](spark, str(tmp_path)), "op9_mixing", documents=docs)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = REGISTRY["op9_mixing"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
