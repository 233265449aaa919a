import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orebed.llm.queries import REGISTRY
from orebed.llm.variants import group_variants, near_pairs, roots, signed

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(docs, every, length, count):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= count}
    form, near_count = {}, {}
    for w, n in words.items():
        near = [v for v in words if one_apart(w, v)]
        near_count[w] = len(near)
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, near_count[w], words[form[w]] if form[w] else None))
    return sorted(out)


def misspelt(rng, word):
    i, letter = rng.randrange(len(word)), rng.choice("aeéÿ×z")
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + letter + word[i + 1 :], word[:i] + letter + word[i:]])


def frame(spark):
    rng = random.Random(8)
    base = ["harbour", "Éclairage", "mountain", "aaaaaaa", "letters", "ELEVENTH", "señorita", "settler"]
    pool = []
    for word in base:
        pool += [word] * 40
        for _ in range(6):
            near = misspelt(rng, word)
            pool += [near] * rng.choice([1, 6, 7])
            pool += [misspelt(rng, near)] * rng.choice([1, 2])
    rows = [(i, rng.choice([" ", ", ", "1", "Ā"]).join(rng.choices(pool, k=rng.randrange(40))), 1, 2) for i in range(120)]
    rows += [(None, "harbour harbour short"), (None, None), (3, ""), (3, "harbours " * 2000), (4, "Harbour-ELEVENTH")]
    rows += [(5, "mountain")] * 12
    return spark.createDataFrame([(*r, 1, 2)[:4] for r in rows], "doc_id bigint, text string, n int, word int")


@pytest.mark.parametrize("every, length, count", [(199, 6, 5), (3, 5, 2)])
def test_against_brute_force(spark, every, length, count):
    docs = frame(spark)
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], every, length, count)
    assert len(expected) > 20 and any(row[1] for row in expected)
    found = sorted(tuple(row) for row in group_variants(docs, every, length, count).collect())
    assert found == expected


def test_against_sql(spark, sf_dir, tmp_path, matches_sql):
    matches_sql(REGISTRY["op12_spelling_variants"](spark, sf_dir), "op12_spelling_variants")
    docs = frame(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    matches_sql(REGISTRY["op12_spelling_variants"](spark, str(tmp_path)), "op12_spelling_variants", documents=docs)


def test_all_near_words_share_a_signature(spark):
    rng = random.Random(1)
    words = {"".join(rng.choices("abé", k=rng.randrange(3, 8))) for _ in range(160)} | {"aaaaaa", "aaaaaaa", "aabaaa"}
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    found = {(r.word, r.near) for r in near_pairs(table).collect()}
    assert found == {(a, b) for a in words for b in words if one_apart(a, b)}
    per_word = {r["count"] for r in signed(table).groupBy("word").count().collect()}
    assert per_word == {28}


def test_chains_end_at_the_root(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(21)] + [("x", "w20")]
    found = dict(roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert set(found.values()) == {"w21"} and len(found) == 22


def test_empty_table_and_texts_without_words(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert group_variants(docs).count() == 0
    assert group_variants(spark.createDataFrame([(1, "1 2 3 !?"), (2, "tiny")], docs.schema)).count() == 0
    lone = docs.sparkSession.createDataFrame([(1, "letters " * 5)], docs.schema).withColumn("_sig", F.lit(1))
    assert [tuple(r) for r in group_variants(lone, every=10**9).collect()] == [("letters", None, "letters", 5, 0, None)]
