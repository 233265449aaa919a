import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebed.llm import substring
from orebed.llm.queries import REGISTRY
from orebed.llm.substring import remove_repeats


def brute(rows, length):
    """(doc_id, n_words, n_removed, kept_sha256) by looking every window up."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    place = [(1, 0) if doc_id is None else (0, doc_id) for doc_id, _ in rows]
    first = {}
    for at, own in zip(place, words):
        for i in range(len(own) - length + 1):
            window = tuple(own[i : i + length])
            first[window] = min(first.get(window, at), at)
    result = []
    for (doc_id, _), at, own in zip(rows, place, words):
        gone = set()
        for i in range(len(own) - length + 1):
            if first[tuple(own[i : i + length])] < at:
                gone.update(range(i, i + length))
        kept = [word for i, word in enumerate(own) if i not in gone]
        result.append((doc_id, len(own), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(result, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


@pytest.mark.parametrize("length", [5, 6, 13, 20])
def test_against_brute_force(spark, length):
    rng = random.Random(length)
    words = [f"w{i}" for i in range(12)]
    passages = [" ".join(rng.choice(words) for _ in range(n)) for n in (4, 5, 12, 13, 14, 25, 60)]
    rows = []
    for i in range(60):
        parts = [rng.choice([rng.choice(passages), " ".join(rng.choice(words) for _ in range(rng.randrange(30)))]) for _ in range(4)]
        rows.append((rng.randrange(50), rng.choice([" ", "\n", " \t"]).join(parts)))
    rows += [rows[0], rows[0], (3, None), (None, rows[5][1]), (None, passages[-1]), (None, passages[-1]), (-7, passages[-1])]
    rows += [(900, ""), (901, " \n\t"), (902, "w1 " * 400), (903, "w1 " * 50), (904, "é ñ  x " * 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("anchor", F.lit(1)).withColumn("none", F.lit("x"))
    assert found(remove_repeats(docs, length)) == brute(rows, length)


def test_spans_are_maximal(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, f"a b c {passage} d"), (2, f"x {passage} y z {passage}"), (3, "nothing shared here")]
    spans = {r.doc_id: [tuple(s) for s in r.repeats] for r in remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert spans == {1: [], 2: [(1, 30), (33, 30)], 3: []}


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute(rows, 13)
    assert sum(r[2] for r in expected) > 0
    assert found(REGISTRY["op10_substring_dedup"](spark, sf_dir)) == expected


def test_windows_of_one_hash_remove_only_equal_words(spark, monkeypatch):
    """With one hash for all windows, words that differ from the earlier document's stay."""
    monkeypatch.setattr(substring, "run_hashes", lambda words, length: np.full(max(len(words) - length + 1, 0), 7, np.uint64))
    shared = [f"s{i}" for i in range(20)]
    rows = [(1, " ".join(shared)), (2, " ".join(shared))]
    rows += [(10 + i, " ".join([f"t{i}"] * 12 + shared[i : i + 9] + [f"u{i}"] * 12)) for i in range(11)]
    result = remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    removed = {r.doc_id: r.n_removed for r in result}
    # Of document 2 what the one hash happens to point at is confirmed, of the others nothing.
    assert 13 <= removed.pop(2) <= 20
    assert set(removed.values()) == {0}


def test_files_between_stages_go_when_read(spark, monkeypatch, tmp_path):
    """Only what the result reads is left: the words to compare with, by document."""
    monkeypatch.setattr("orebed.llm.common.fresh_dir", lambda spark, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(substring, "fresh_dir", lambda spark, label: f"{tmp_path}/{label}", raising=False)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, f"a {passage}"), (2, f"b {passage} c"), (None, passage)]
    result = remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [path.name for path in tmp_path.iterdir()] == ["repeats"]
    assert found(result) == brute(rows, 13)


def test_texts_sharing_an_id_are_told_apart(spark):
    passage = " ".join(f"p{i}" for i in range(400))
    other = " ".join(f"q{i}" for i in range(400))
    rows = [(1, passage), (1, other), (1, passage), (2, f"a {other} b {passage}"), (None, passage), (None, f"{passage} z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(remove_repeats(docs)) == brute(rows, 13)
