import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from orebed.llm import search as module
from orebed.llm.queries import REGISTRY
from orebed.llm.search import Best, search, terms

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k):
    counts = [(doc_id, Counter(split(text))) for doc_id, text in docs]
    total_docs = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, count in counts:
            score = 0
            for term in split(text):
                if tf := count.get(term):
                    w = math.floor(1000 * math.log((2 * total_docs + 2) / (2 * df[term] + 1)))
                    m = 25 + 75 * sum(count.values()) * total_docs // total
                    score += w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return sorted(out, key=repr)


def frames(spark):
    rng = random.Random(6)
    words = ["the", "The", "of", "élan", "ÉLAN", "x1", "中文", "night", "a_b", "it's"] + [f"w{i}" for i in range(80)]

    def text(most):
        return rng.choice([" ", "-", "\x00", ". "]).join(rng.choices(words, k=rng.randrange(most)))

    docs = [(i, text(60), 7, 1) for i in range(150)]
    docs += [(None, docs[3][1], 7, 1)] * 2 + [(3, docs[3][1], 7, 1)] * 3 + [(900, None, 7, 1), (901, "", 7, 1), (902, " -- ", 7, 1)]
    docs += [(903, "night " * 5000, 7, 1)]
    items = [(i, text(20), "z") for i in range(40)]
    items += [(4, text(12), "z"), (50, None, "z"), (51, "", "z"), (52, "nowhere", "z"), (None, "night of the", "z")]
    items += [(60, docs[3][1], "z"), (61, "w1 w2 " * 400, "z")]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, rank int, item int"),
        spark.createDataFrame(items, "item_id bigint, text string, doc_id string"),
    )


def plain(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("k", [1, 10])
def test_against_brute_force(spark, k):
    docs, items = frames(spark)
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], k)
    found = search(docs.repartition(5), items, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert plain(found) == expected


def test_several_passes_and_small_blocks_change_nothing(spark, monkeypatch):
    docs, items = frames(spark)
    whole = plain(search(docs, items))
    for name, value in (("PASS_BYTES", 500), ("ITEMS_AT_A_TIME", 4), ("CELLS", 30), ("MERGE_GROUPS", 2)):
        monkeypatch.setattr(module, name, value)
    assert plain(search(docs, items)) == whole


def test_against_sql(spark, sf_dir, tmp_path, matches_sql):
    matches_sql(REGISTRY["op13_reversed_search"](spark, sf_dir), "op13_reversed_search")
    docs, items = frames(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = REGISTRY["op13_reversed_search"](spark, str(tmp_path))
    matches_sql(found, "op13_reversed_search", documents=docs, benchmark=items)


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert search(docs.limit(0), items).count() == 0
    assert search(docs, items.limit(0)).count() == 0
    assert search(docs, items.filter("item_id = 51")).count() == 0


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, range(0x250))) + " Straße  中文\U0001f600x A-b"
    assert [t.decode() for t in terms(text.encode())] == split(text)


def test_heaps_keep_the_best_whatever_the_order():
    rng = random.Random(2)
    rows = [(rng.randrange(4), rng.randrange(50), rng.random() < 0.1, rng.randrange(1, 9)) for _ in range(400)]
    best = Best(4, 5)
    for first in range(0, 400, 37):
        item, doc, null, score = map(np.array, zip(*rows[first : first + 37]))
        keep = score >= best.least[item]
        best.add(item[keep], doc[keep], null[keep], score[keep])
    for item in range(4):
        want = sorted((-s, n, d) for i, d, n, s in rows if i == item)[:5]
        mine = best.item == item
        assert sorted(zip(-best.score[mine], best.null[mine], best.id[mine])) == want
