from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from orebed.llm import quality
from orebed.llm.decontaminate import find_leaks
from orebed.llm.mixing import mix
from tests.llm.test_near_dup import brute_classes, brute_print
from tests.llm.test_tokens import expected


@pytest.fixture(autouse=True)
def small_steps(monkeypatch):
    monkeypatch.setattr(quality.train, "__defaults__", (7, 120))


def tables(spark, sf_dir, folder, **changed):
    for name in ("documents", "labels", "benchmark"):
        frame = changed.get(name, spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        frame.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    names = [name for name in entry.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("labels", "benchmark"))
    extra = docs.limit(3).withColumn("doc_id", F.lit(None).cast("bigint")).unionByName(docs.limit(1))
    extra = extra.unionByName(docs.limit(2).withColumn("doc_id", F.col("doc_id") + 10**6).withColumn("text", F.lit(None).cast("string")))
    docs = docs.unionByName(extra).withColumn("fp", F.lit("x")).withColumn("Row_Key", F.lit(1.5))
    kept = []
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        path = f"{tmp_path}/{place}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs)
        if place < 4:
            assert docs.columns == kept[0].columns
    good, distinct, clean, mixed, tokens = kept
    texts = distinct.select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in good.select("text").collect()]
    assert len(texts) == len(set(brute_classes(prints, 4)))
    leaky = {r.doc_id for r in find_leaks(distinct, benchmark).collect()}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r.doc_id) for r in texts if r.doc_id not in leaky)
    count = lambda text: len((text or "").encode().split())
    got = Counter()
    for row in mixed.collect():
        got[row.doc_id] += count(row.text)
    assert {k: v for k, v in got.items() if v} == {r.doc_id: r.taken for r in mix(clean).collect() if r.taken}
    rows = sorted((tuple(r) for r in tokens.collect()), key=lambda r: r[1])
    ids = [r[0] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))
    plain = expected([(r.doc_id, r.text) for r in mixed.select("doc_id", "text").collect()])
    assert Counter((r[0], r[2], r[3]) for r in rows) == Counter((r[0], r[2], r[3]) for r in plain)
    assert labels.count()


def test_run_gives_the_last_stage(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    total = rows.agg(F.sum("n_tokens"), F.max(F.col("start") + F.col("n_tokens"))).first()
    assert total[0] == total[1]


def test_empty_tables(spark, sf_dir, tmp_path):
    none = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0) for name in ("documents", "labels", "benchmark")}
    assert corpus_pipeline.run(spark, tables(spark, sf_dir, str(tmp_path), **none)).count() == 0
