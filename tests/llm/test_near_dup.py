import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orebed.llm import near_dup
from orebed.llm.bitslice import large_components, near_queries, planes_of, lanes_of, small_components
from orebed.llm.components import components
from orebed.llm.queries import REGISTRY


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def brute_classes(prints, radius):
    """Smallest index reachable over links, by comparing all pairs."""
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, one in enumerate(prints):
            for j, two in enumerate(prints):
                if bin(one ^ two).count("1") <= radius and root[j] > root[i]:
                    root[j] = root[i]
                    changed = True
    return root


def clustered(count, seed, flips=3):
    rng = random.Random(seed)
    values = set()
    while len(values) < count:
        value = rng.getrandbits(64) if not values or rng.random() < 0.3 else rng.choice(sorted(values))
        for _ in range(rng.randrange(flips + 1)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    return np.array(sorted(values, key=lambda v: hash((v, seed))), np.uint64)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_distances_match_counting(radius):
    values = clustered(200, radius)
    hits = near_queries(values[:70], planes_of(values), radius)
    for row, query in zip(hits, values[:70]):
        near = [i for i, value in enumerate(values) if bin(int(query ^ value)).count("1") <= radius]
        assert lanes_of(row, len(values)).tolist() == near


@pytest.mark.parametrize("count", [2, 63, 64, 65, 300])
def test_components_of_a_segment(count):
    values = clustered(count, count)
    expected = brute_classes([int(v) for v in values], 4)
    assert large_components(values, 4).tolist() == expected
    if count <= 64:
        assert small_components(values, np.full(count, count), 4).tolist() == expected


def test_components_of_many_small_segments():
    sizes = [64, 40, 40, 7, 3, 2, 2]
    parts = [clustered(size, 100 + place) for place, size in enumerate(sizes)]
    ends = np.cumsum(sizes)
    roots = small_components(np.concatenate(parts), np.repeat(ends, sizes), 4)
    expected = []
    for part, end, size in zip(parts, ends, sizes):
        expected += [int(root) + end - size for root in brute_classes([int(v) for v in part], 4)]
    assert roots.tolist() == expected


def test_connected_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    links += [(500, x) for x in range(-30, 0)] + [(7, 7)]
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {x: r for x, r in root.items() if any(x in pair and pair[0] != pair[1] for pair in links)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(50)]
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(12)]
    rows = []
    for text in base:
        rows.append(text)
        for _ in range(4):
            parts = text.split()
            parts[rng.randrange(len(parts))] = rng.choice(words)
            rows.append((" \n" if rng.random() < 0.5 else " ").join(parts).title())
    return rows + ["", " \t\n", None, "one", "one two three", "ONE two\x0bthree", "a b c d", "é É ñ", base[0], base[0]]


@pytest.mark.parametrize("chunk", [4096, 5])
def test_against_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(near_dup, "CHUNK", chunk)
    rows = [(100 - i, text) for i, text in enumerate(texts())]
    rows += [(None, rows[3][1]), (None, "only here"), rows[7], (rows[7][0], "another text under the same id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    prints = [brute_print(text) for _, text in rows]
    roots = brute_classes(prints, 4)
    lowest = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            lowest[root] = min(doc_id, lowest.get(root, doc_id))
    expected = [(d, f"{p:016x}", lowest.get(root)) for (d, _), p, root in zip(rows, prints, roots)]
    found = [tuple(r) for r in near_dup.near_duplicates(docs).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    kept = near_dup.distinct_documents(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert len(kept) == len(set(roots))
    assert sorted(repr(r.doc_id) for r in kept) == sorted(repr(lowest.get(root)) for root in set(roots))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_dup.near_duplicates(docs).count() == 0
    assert near_dup.distinct_documents(docs).count() == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in docs]
    roots = brute_classes(prints, 4)
    lowest = {}
    for row, root in zip(docs, roots):
        lowest[root] = min(row.doc_id, lowest.get(root, row.doc_id))
    expected = sorted((r.doc_id, f"{p:016x}", lowest[root]) for r, p, root in zip(docs, prints, roots))
    assert sorted(tuple(r) for r in REGISTRY["op7_simhash_near_dup"](spark, sf_dir).collect()) == expected
