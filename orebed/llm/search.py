"""Ranked lexical search the other way round: documents stream past an index of the items.

The items' terms make an inverted index that every task gets. One pass over
the documents counts the terms that items hold and writes them; the corpus
counts come from these rows. Then each document's counts run through the index,
and each task keeps the best documents of each item; Spark merges what the
tasks kept.

Defined results: a null or empty text has no terms and ranks nowhere; each row of
the items is an item of its own, also one that repeats an id; repeated documents
rank each for itself; equal scores go by ascending id, null last; an empty table on
either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.llm.common import by_batch, ranked, stored

# Items travel with the tasks in passes of so many bytes of text, a few of them at a time; more take more passes.
PASS_BYTES = 8 << 20
ITEMS_AT_A_TIME = 64
# Scores of so many pairs of document and item are held at once.
CELLS = 1 << 19
# Rows that different tasks kept for an item are cut down in so many groups first.
MERGE_GROUPS = 64
# Fixed values of the score.
UNIT, SATURATION, SPREAD = 1_000_000_000, 8, 75

NULL_LAST = np.iinfo(np.int64).max


def _fold(byte: int) -> int:
    """Digits, letters (A to Z lower-cased) and all beyond ASCII stay; the rest parts terms."""
    char = chr(byte)
    if byte >= 0x80 or char.isdigit():
        return byte
    return ord(char.lower()) if char.isalpha() else 0x20


FOLDS = bytes(_fold(byte) for byte in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLDS).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, times) of (item, text)."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = [
            (item, term, times)
            for item, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist())
            for term, times in Counter(terms(text or b"")).items()
        ]
        if not rows:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.int64(), pa.binary(), pa.int64()))],
            ["item", "term", "times"],
        )

    narrow = items.select("item", F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(by_batch(count), "item bigint, term binary, times bigint")


def term_counts(docs: DataFrame, known, text: str = "text") -> DataFrame:
    """(doc_id, n, places, times) of whole texts: n counts all terms, the lists those in ``known``.

    ``known`` is a broadcast dictionary from term to place.
    """

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        numbers, totals, places, times, ends = known.value, [], [], [], [0]
        for value in batch["text"]:
            found = terms(value.as_buffer().to_pybytes()) if value.is_valid else []
            totals.append(len(found))
            for term, often in Counter(found).items():
                if (place := numbers.get(term)) is not None:
                    places.append(place)
                    times.append(often)
            ends.append(len(places))
        ends = pa.array(ends, pa.int32())
        columns = [
            batch["doc_id"],
            pa.array(totals, pa.int64()),
            pa.ListArray.from_arrays(ends, pa.array(places, pa.int32())),
            pa.ListArray.from_arrays(ends, pa.array(times, pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "places", "times"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return narrow.mapInArrow(by_batch(count), "doc_id bigint, n bigint, places array<int>, times array<bigint>")


class Best:
    """The best ``k`` documents of each item so far, ties by ascending id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item = self.id = self.score = np.empty(0, np.int64)
        self.null = np.empty(0, bool)
        # What a document must reach: the k-th best score, or 1 while there are fewer.
        self.least = np.ones(items, np.int64)

    def add(self, item: np.ndarray, doc: np.ndarray, null: np.ndarray, score: np.ndarray) -> None:
        if not len(item):
            return
        item, doc = np.concatenate([self.item, item]), np.concatenate([self.id, doc])
        null, score = np.concatenate([self.null, null]), np.concatenate([self.score, score])
        order = np.lexsort((doc, null, -score, item))
        first = np.flatnonzero(np.r_[True, np.diff(item[order]) != 0])
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
        order = order[place < self.k]
        self.item, self.id, self.null, self.score = item[order], doc[order], null[order], score[order]
        last = place[place < self.k] == self.k - 1
        self.least[self.item[last]] = self.score[last]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``lengths`` of them, one run behind the other."""
    return np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


def best_documents(counts: DataFrame, index, items: int, k: int) -> DataFrame:
    """(item, doc_id, score): what each task keeps of the rows of :func:`term_counts`.

    ``index`` is broadcast: the items of each term, how often they hold it, where
    each term's begin, the terms' weights, N and L.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, often, starts, weights, all_docs, all_terms = index.value
        best, step = Best(items, k), max(1, CELLS // items)
        for batch in batches:
            ids = batch["doc_id"]
            null = np.asarray(ids.is_null())
            ids = ids.fill_null(NULL_LAST).to_numpy(zero_copy_only=False)
            # Whole numbers of any size: the product may be beyond 64 bits.
            length = [100 - SPREAD + SPREAD * n * all_docs // all_terms for n in batch["n"].to_pylist()]
            length = np.array(length, np.int64)
            ends = batch["places"].offsets.to_numpy()
            places = batch["places"].values.to_numpy(zero_copy_only=False)
            times = batch["times"].values.to_numpy(zero_copy_only=False)
            for first in range(0, len(ids), step):
                last = min(first + step, len(ids))
                sizes = np.diff(ends[first : last + 1])
                doc = np.repeat(np.arange(last - first), sizes)
                term = places[ends[first] : ends[last]]
                tf = times[ends[first] : ends[last]]
                part = weights[term] * ((UNIT * tf) // (1000 * tf + SATURATION * length[first:last][doc]))
                lengths = starts[term + 1] - starts[term]
                at = _spread(starts[term], lengths)
                scores = np.zeros((last - first) * items, np.int64)
                np.add.at(scores, np.repeat(doc * items, lengths) + held[at], np.repeat(part, lengths) * often[at])
                scores = scores.reshape(last - first, items)
                row, item = np.nonzero(scores >= best.least)
                best.add(item, ids[first:last][row], null[first:last][row], scores[row, item])
        if len(best.item):
            columns = [pa.array(best.item), pa.array(best.id, mask=best.null), pa.array(best.score)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return counts.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _weight(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


def _passes(items: DataFrame) -> list[tuple[int, int]]:
    """Runs of item numbers whose texts together stay within the bytes of a pass."""
    group = F.expr(f"item div {ITEMS_AT_A_TIME}")
    sizes = items.groupBy(group.alias("g")).agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("b"))
    runs, filled = [], 0
    for row in sizes.orderBy("g").collect():  # a row for every ITEMS_AT_A_TIME items
        if not runs or filled + row["b"] > PASS_BYTES:
            runs.append([row["g"] * ITEMS_AT_A_TIME, 0])
            filled = 0
        filled += row["b"]
        runs[-1][1] = (row["g"] + 1) * ITEMS_AT_A_TIME
    return [(first, last) for first, last in runs]


def _search_pass(docs: DataFrame, items: DataFrame, first: int, k: int, text: str) -> DataFrame | None:
    """The best documents of one pass's items, whose numbers begin with ``first``."""
    context = docs.sparkSession.sparkContext
    # Bounded by the bytes of a pass.
    postings = item_terms(items).orderBy("term", "item").collect()
    if not postings:
        return None
    known: dict[bytes, int] = {}
    place = np.array([known.setdefault(bytes(row["term"]), len(known)) for row in postings], np.int64)
    held = np.array([row["item"] - first for row in postings], np.int64)
    often = np.array([row["times"] for row in postings], np.int64)
    starts = np.searchsorted(place, np.arange(len(known) + 1))

    counts = stored(term_counts(docs, context.broadcast(known), text), "term-counts")
    all_docs, all_terms = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = counts.select(F.explode("places").alias("place")).groupBy("place").count().collect()  # a row per known term
    weights = np.zeros(len(known), np.int64)
    for row in holding:
        weights[row["place"]] = _weight(all_docs, row["count"])
    index = context.broadcast((held, often, starts, weights, all_docs, all_terms))
    kept = best_documents(counts, index, int(held.max()) + 1, k)
    return kept.withColumn("item", F.col("item") + first)


def search(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, score above 0.

    ``docs`` has (doc_id, text), ``items`` (item_id, text). A task holds ``k`` rows per
    item of a pass, whatever it reads.
    """
    narrow = items.select("item_id", F.col("text").cast("string").alias("text"))
    order = [F.col("item_id").asc_nulls_last(), F.col("text")]
    numbered = stored(ranked(narrow, order, "item", "items"), "numbered-items")
    schema = T.StructType([T.StructField(name, T.LongType()) for name in ("item", "doc_id", "score")])
    kept = docs.sparkSession.createDataFrame([], schema)
    for first, last in _passes(numbered):
        chosen = numbered.filter((F.col("item") >= first) & (F.col("item") < last))
        found = _search_pass(docs, chosen, first, k, text)
        if found is not None:
            kept = kept.unionByName(found)
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    group = F.spark_partition_id() % MERGE_GROUPS
    some = kept.withColumn("_group", group)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "_group").orderBy(*best)))
    some = some.filter(F.col("rank") <= k)
    whole = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best)))
    whole = whole.filter(F.col("rank") <= k)
    return whole.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
