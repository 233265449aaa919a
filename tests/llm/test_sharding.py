import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from orebed.llm import sharding
from orebed.llm.queries import REGISTRY
from orebed.llm.sharding import shard_list, with_shard, write_shards

SCHEMA = "doc_id bigint, text string, shard int, size string"


def frame(spark, many=600):
    rng = random.Random(3)
    rows = [(i, rng.choice(["", "a", "é word", "long " * rng.randrange(400)]), 9, "x") for i in range(many)]
    rows += [(i % 7, f"text {i}", 9, "x") for i in range(40)]  # ids that several texts share
    rows += [(None, None, 9, "x")] * 5 + [(None, "a", 9, "x")] * 3 + [(5000, None, 9, "x"), (5000, None, 9, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def test_against_sql(spark, sf_dir, tmp_path, matches_sql):
    matches_sql(REGISTRY["op11_rendezvous"](spark, sf_dir), "op11_rendezvous")
    docs = frame(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    matches_sql(REGISTRY["op11_rendezvous"](spark, str(tmp_path)), "op11_rendezvous", documents=docs)


def test_law_and_slots(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 2)  # equal rows in several runs
    docs = frame(spark)
    rows = shard_list(docs, [1.0] * 6, [1.0] * 7).collect()
    assert len(rows) == docs.count()
    slots, homes = {}, {}
    for row in rows:
        assert row.grown_shard in (row.shard, 6)
        assert 0 <= row.shard < 6
        slots.setdefault(row.shard, []).append(row.slot)
        homes.setdefault(row.doc_id, set()).add((row.shard, row.grown_shard))
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert all(len(found) == 1 for found in homes.values())
    assert any(row.grown_shard == 6 for row in rows)
    facts = sorted((repr(r.doc_id), r.size, r.text_crc32) for r in rows)
    raw = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    assert facts == sorted((repr(i), len(t) + 16, zlib.crc32(t)) for i, t in raw)


def test_weights_decide_the_share(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"))
    counts = dict(with_shard(docs, [1.0, 3.0, 0.5, 3.5]).groupBy("shard").count().collect())
    for shard, share in enumerate([1 / 8, 3 / 8, 0.5 / 8, 3.5 / 8]):
        assert counts[shard] == pytest.approx(40_000 * share, rel=0.06)


def test_only_the_changed_shard_moves_records(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"))

    def shards(weights):
        return dict(with_shard(docs, weights).select("doc_id", "shard").collect())

    before, heavier = shards([1.0, 1.0, 1.0]), shards([1.0, 2.0, 1.0])
    moved = {key for key in before if before[key] != heavier[key]}
    assert moved and all(heavier[key] == 1 for key in moved)
    fewer = shards([1.0, 1.0])
    assert all(fewer[key] == before[key] for key in before if before[key] < 2)


def test_files_by_shard(spark, folder):
    docs = frame(spark).drop("shard").withColumn("extra", F.create_map(F.lit("k"), F.lit(1)))
    write_shards(docs, f"{folder}/out", [1.0] * 5)
    back = spark.read.parquet(f"{folder}/out")
    assert back.count() == docs.count()
    assert set(back.columns) == {*docs.columns, "shard"}
    expected = with_shard(docs, [1.0] * 5).groupBy("doc_id", "shard").count()
    assert back.groupBy("doc_id", "shard").count().exceptAll(expected).isEmpty()
    with pytest.raises(ValueError):
        write_shards(frame(spark), f"{folder}/again", [1.0])


def test_bad_weights_and_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert shard_list(docs, [1.0], [1.0, 1.0]).count() == 0
    for weights, grown in (([], [1.0]), ([0.0], [0.0]), ([1.0], [2.0, 1.0])):
        with pytest.raises(ValueError):
            shard_list(docs, weights, grown).collect()
            with_shard(docs, weights)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = REGISTRY["op11_rendezvous"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert "Exchange" not in with_shard(docs, [1.0] * 9)._jdf.queryExecution().executedPlan().toString()
