"""Near-duplicate documents by SimHash fingerprints compared in bit-sliced blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.bitslice import SMALL, large_components, small_components
from orebed.llm.common import by_batch, free_name, stored, text_bytes
from orebed.llm.components import components

# A seed for the shingle hash.
SEED = 42
# More than this many fingerprints that agree on a block key are dealt to several tasks.
CHUNK = 4096
# Rows compared at once; a segment is never cut.
BATCH_ROWS = 1 << 16


def simhash(text: bytes, shingle: int, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a text: the majority of its shingle hashes, bit by bit."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    parts = map(b" ".join, zip(*(words[place:] for place in range(shingle))))
    count = len(words) - shingle + 1
    hashes = np.fromiter((digest(part, seed) for part in parts), dtype=">u8", count=count)
    votes = np.zeros(64, np.int64)
    for start in range(0, count, 1 << 18):
        piece = hashes[start : start + (1 << 18)]
        votes += np.unpackbits(piece.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > count).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, row_key, fp) of every document; fp is the fingerprint as a signed number.

    ``row_key`` is a hash of id and text, equal only for repeated rows.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.fromiter((simhash(t, shingle) for t in batch.column(2).to_pylist()), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], names=["doc_id", "row_key", "fp"]
        )

    rows = docs.select("doc_id", _row_key(docs).alias("row_key"), text_bytes(docs).alias("text"))
    return rows.mapInArrow(by_batch(work), "doc_id bigint, row_key bigint, fp bigint")


def _row_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"])


def _block_keys(fp: Column, radius: int) -> list[Column]:
    """Keys of which two fingerprints within the radius share at least one.

    The 64 bits fall into ``radius + 2`` blocks. ``radius`` differences leave
    two blocks untouched at least, so each pair of blocks makes a key.
    """
    count = radius + 2
    edges = [64 * place // count for place in range(count + 1)]
    blocks = []
    for low, high in zip(edges, edges[1:]):
        blocks.append((F.shiftrightunsigned(fp, low).bitwiseAND((1 << (high - low)) - 1), high - low))
    keys = []
    for number, ((one, _), (two, bits)) in enumerate(combinations(blocks, 2)):
        keys.append(F.shiftleft(F.lit(number).cast("bigint"), 54) + F.shiftleft(one, bits) + two)
    return keys


def _links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect all fingerprints within the radius of each other."""
    keyed = distinct.select("fp", F.explode(F.array(*_block_keys(F.col("fp"), radius))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").withColumnRenamed("key", "_key")
    shared = keyed.join(sizes, F.col("key") == F.col("_key")).select("key", "fp", "n")
    # A long segment is cut into chunks by hash, and each two chunks meet once.
    chunks = F.ceil(F.col("n") / CHUNK).cast("bigint")
    own = F.pmod(F.xxhash64("fp"), chunks)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)).alias("other")
    meeting = shared.select("key", "fp", own.alias("own"), other).select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp"
    )
    dealt = meeting.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((4, 0), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([column.to_numpy() for column in batch.columns])], axis=1)
            if held.shape[1] < BATCH_ROWS:
                continue
            last = np.flatnonzero((held[:3] != held[:3, -1:]).any(axis=0))
            whole = last[-1] + 1 if len(last) else 0  # the last segment may go on
            if whole:
                yield _compared(held[:, :whole], radius)
                held = held[:, whole:]
        if held.shape[1]:
            yield _compared(held, radius)

    return dealt.mapInArrow(compare, "a bigint, b bigint")


def _compared(rows: np.ndarray, radius: int) -> pa.RecordBatch:
    """Star links within each segment of rows (key, low, high, fp)."""
    values = rows[3].view(np.uint64)
    starts = np.flatnonzero(np.r_[True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)])
    sizes = np.diff(np.r_[starts, len(values)])
    roots = np.arange(len(values))
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 1]
    for segment in order[sizes[order] > SMALL]:
        part = slice(starts[segment], starts[segment] + sizes[segment])
        roots[part] = large_components(values[part], radius) + starts[segment]
    small = order[sizes[order] <= SMALL]
    if len(small):
        lengths = sizes[small]
        ends = np.cumsum(lengths)
        places = np.repeat(starts[small] - (ends - lengths), lengths) + np.arange(ends[-1])
        roots[places] = places[small_components(values[places], np.repeat(ends, lengths), radius)]
    linked = np.flatnonzero(roots != np.arange(len(values)))
    return pa.RecordBatch.from_arrays([pa.array(rows[3][linked]), pa.array(rows[3][roots[linked]])], names=["a", "b"])


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id, keep_id, keep_key) of every fingerprint.

    ``keep_id`` and ``keep_key`` name the document that stands for the class:
    the smallest id, null ids last.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")
    groups = stored(prints.groupBy("fp").agg(first), "simhash-groups")
    roots = components(_links(groups.select("fp"), radius)).withColumnRenamed("node", "_fp")
    rooted = groups.join(roots, F.col("fp") == F.col("_fp"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    best = rooted.groupBy("root").agg(F.min("first").alias("best")).withColumnRenamed("root", "_root")
    classes = rooted.join(best, F.col("root") == F.col("_root")).select(
        "fp", F.col("best.doc_id").alias("component_id"), F.col("best.doc_id").alias("keep_id"), F.col("best.row_key").alias("keep_key")
    )
    return stored(classes, "simhash-classes")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    Fingerprints are taken over shingles of ``shingle`` lower-cased words, in
    full; texts without words (null ones too) have fingerprint zero. Two
    fingerprints link at ``radius`` or fewer differing bits, exactly: candidates
    come from block keys that such a pair is bound to share. ``component_id``
    is the smallest id among the documents reachable over links, the document
    itself included; null only if none of them has an id. Repeated rows give
    repeated rows. Other columns are ignored. An empty table gives no rows.

    Equal fingerprints are compared once, whatever their number. Segments of
    more than 4,096 fingerprints are dealt to several tasks, and each segment
    gives links that join it up, not all its pairs.
    """
    prints = stored(fingerprints(docs, shingle), "simhash")
    classes = _classes(prints, radius).withColumnRenamed("fp", "_fp")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(classes, F.col("fp") == F.col("_fp")).select("doc_id", hexed, "component_id")


def distinct_documents(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The documents with one of each class of near duplicates: the one with the smallest id.

    All columns stay. Rows without id stay only where their whole class has none;
    of fully repeated rows one stays.
    """
    prints = stored(fingerprints(docs, shingle), "simhash")
    kept = _classes(prints, radius).select("keep_id", "keep_key").distinct()
    same = docs["doc_id"].eqNullSafe(kept["keep_id"]) & (_row_key(docs) == kept["keep_key"])
    name = free_name(docs, "_copy")
    copies = Window.partitionBy("doc_id", F.xxhash64("doc_id", "text")).orderBy(F.xxhash64(*docs.columns))
    left = docs.join(kept, same, "left_semi").withColumn(name, F.row_number().over(copies))
    return left.filter(F.col(name) == 1).select(*docs.columns)
