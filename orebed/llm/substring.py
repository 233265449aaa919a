"""Removal of word passages that repeat across documents, by seed and extension."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed import paths
from orebed.llm.common import by_batch, mix, run_hashes, stored, text_bytes, word_hashes
from orebed.operators.skew import skew_join
from orebed.session import fresh_dir

# Words in a seed. A repeat of ``length`` words then holds ``length - SEED + 1``
# seeds, the smallest of which is its anchor.
SEED = 5
# Anchors only pick candidates, so 48 bits of their hash will do.
ANCHOR_BITS = np.uint64(16)
# Windows that start in one block of a document are compared together.
BLOCK = 256

KEY = "none boolean, doc bigint, key bigint"
SPANS = "array<struct<start bigint, length bigint>>"


def _window_anchors(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """For each window of ``length`` words the smallest seed hash in it (winnowing)."""
    seeds = run_hashes(hashes, seed) >> ANCHOR_BITS
    span = length - seed + 1
    have, low = 1, seeds
    while have < span:
        step = min(have, span - have)
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        have += step
    return low.view(np.int64)


def _lists(column: pa.Array) -> list[np.ndarray | None]:
    """A list column as one array per row, null rows as None."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.array([0 if n is None else n for n in column.value_lengths().to_pylist()])
    ends = np.cumsum(lengths)
    return [values[end - n : end] if n else None for n, end in zip(lengths.tolist(), ends.tolist())]


def _keys(batch: pa.RecordBatch, rows: np.ndarray) -> list[pa.Array]:
    """The document's key for each of the picked rows."""
    picks = pa.array(rows)
    return [batch.column(name).take(picks) for name in ("none", "doc", "key")]


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    """(none, doc, key, doc_id, text): documents are ordered by (none, doc), so all without id
    rank alike and last; with the hash of the text that tells apart texts that share an id."""
    none = docs["doc_id"].isNull()
    doc = F.coalesce(docs["doc_id"], F.lit(0).cast("bigint"))
    return docs.select(none.alias("none"), doc.alias("doc"), F.xxhash64("text").alias("key"), docs["doc_id"], text_bytes(docs).alias("text"))


def _with(docs: DataFrame, found: DataFrame, *columns: str) -> DataFrame:
    """The documents with what was found for them."""
    names = ["none", "doc", "key"]
    found = found.select(*[F.col(name).alias(f"_{name}") for name in names], *columns)
    same = [F.col(name) == F.col(f"_{name}") for name in names]
    return docs.join(found, same[0] & same[1] & same[2], "left").select(*names, "doc_id", "text", *columns)


def _stretches(near: np.ndarray, anchors: np.ndarray, most: int) -> np.ndarray:
    """Where stretches begin among windows that start at ``near``: windows in a row with one anchor, in one block, ``most`` at most."""
    if not len(near):
        return near
    new = np.r_[True, (np.diff(near) > 1) | (np.diff(anchors) != 0) | (np.diff(near // BLOCK) != 0)]
    begin = np.flatnonzero(new)
    since = np.arange(len(near)) - np.repeat(begin, np.diff(np.append(begin, len(near))))
    return np.flatnonzero(since % most == 0)


def _held(rows: DataFrame) -> DataFrame:
    """Rows (seed, at, none, doc, key, ...) with the earliest document (first, of_key) that has the
    seed, its place there (of_at), and whether that document comes before the row's own. A seed of one row has none."""
    place = F.when(~F.col("none"), F.struct("doc", "key", "at"))
    first = rows.groupBy("seed").agg(F.min(place).alias("_from"), F.count("*").alias("_n")).filter("_n > 1 and _from is not null")
    first = first.select("seed", F.col("_from.doc").alias("first"), F.col("_from.key").alias("of_key"), F.col("_from.at").alias("of_at"))
    later = F.coalesce(F.col("none") | (F.col("doc") > F.col("first")), F.lit(False))
    return skew_join(rows, first, ["seed"], "left").withColumn("later", later & F.col("first").isNotNull())


def _agreeing(own: list[bytes], other: list[bytes], length: int) -> Iterator[tuple[int, int]]:
    """Maximal runs (start, end) of at least ``length`` places where both have the same word."""
    if own == other:
        if len(own) >= length:
            yield 0, len(own)
        return
    start = 0
    for place in range(min(len(own), len(other)) + 1):
        if place == min(len(own), len(other)) or own[place] != other[place]:
            if place - start >= length:
                yield start, place
            start = place + 1


def remove_repeats(docs: DataFrame, length: int = 13, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, repeats) of every document.

    A word goes if a window of ``length`` words that covers it also starts in a
    document with a smaller id. Words are runs without ASCII white space, taken
    unchanged from the whole text; windows are judged on the input. ``repeats``
    lists the maximal repeats removed as (start, length) in words, and
    ``kept_sha256`` is the hash of the kept words joined by one space. A null
    text has no words. Documents without id rank last and alike, so nothing
    goes on account of them. Rows that share an id do not count against each
    other. Other columns are ignored.

    Seeds are runs of five words. The smallest seed hash of each window is its
    anchor, so equal windows have equal anchors, and only about one seed in five
    is an anchor. Documents are joined on anchors that occur more than once. The
    consecutive windows of one such anchor are a stretch, which joins a document with
    the earliest one that has the same stretch. Windows of a stretch without an earlier holder
    are joined one by one; those of other stretches are left to their earliest holder, which has them too.
    Places at one distance from each other lie on one
    alignment of the two documents. Along it both texts are compared word by word
    and the match extended both ways from its seeds as far as words are equal, within blocks of 256
    words that overlap by a window. Runs of equal words of the whole length or more go; those that
    overlap or touch make a maximal repeat. Only words that were compared are
    removed, so two windows with one hash remove nothing; they could at most hide a repeat.
    A passage in very many documents costs one row per document and stretch: it is matched with its
    earliest holder, not with each other.
    """
    if length < seed:
        raise ValueError("a repeat cannot be shorter than its seed")
    keyed = _keyed(docs)

    def anchors(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(_window_anchors(word_hashes(text.split()), length, seed)) for text in batch.column("text").to_pylist()]
        rows = np.repeat(np.arange(len(found)), [len(part) for part in found])
        return pa.RecordBatch.from_arrays([pa.array(_joined(found)), *_keys(batch, rows)], names=["anchor", "none", "doc", "key"])

    placed = keyed.select("none", "doc", "key", "text").mapInArrow(by_batch(anchors), f"anchor bigint, {KEY}")
    seen = placed.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    again = seen.select(F.col("anchor").alias("_anchor"))
    shared = placed.join(again, F.col("anchor") == F.col("_anchor"), "left_semi")
    sets = shared.groupBy("none", "doc", "key").agg(F.collect_set("anchor").alias("anchors"))

    def stretches_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Stretches with the hashes of their windows, and the words of the blocks they start in."""
        rows, values, places, texts, parts, sizes = [], [], [], [], [], []
        for row, (text, known) in enumerate(zip(batch.column("text").to_pylist(), _lists(batch.column("anchors")))):
            if known is None:
                continue
            words = text.split()
            hashes = word_hashes(words)
            seeds = _window_anchors(hashes, length, seed)
            near = np.flatnonzero(np.isin(seeds, known))
            windows = run_hashes(hashes, length)[near]
            starts = _stretches(near, seeds[near], length)
            counts = np.diff(np.append(starts, len(near)))
            # The first and the last window hold all words between them, as a stretch has no more starts than a window words.
            ends = windows[starts + counts - 1]
            with np.errstate(over="ignore"):
                whole = mix(windows[starts] * np.uint64(0x9E3779B97F4A7C15) + ends + counts.astype(np.uint64))
            blocks, first = np.unique(near // BLOCK, return_index=True)
            lows, highs = near[first], near[np.append(first[1:], len(near)) - 1] + length
            rows.append(np.full(len(starts) + len(blocks), row))
            values += [whole.view(np.int64), blocks]
            places += [near[starts], lows]
            texts += [None] * len(starts)
            texts += [b" ".join(words[low:high]) for low, high in zip(lows.tolist(), highs.tolist())]
            parts.append(windows.view(np.int64))
            sizes += [counts, np.zeros(len(blocks), np.int64)]
        texts = pa.array(texts, pa.binary())
        offsets = np.append(0, np.cumsum(_joined(sizes))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(_joined(parts)))
        arrays = [pa.array(_joined(values)), pa.array(_joined(places)), lists, texts.is_valid(), texts, *_keys(batch, _joined(rows))]
        return pa.RecordBatch.from_arrays(arrays, names=["seed", "at", "windows", "block", "words", "none", "doc", "key"])

    # Written once: the stretches are read for their earliest document, and again to be matched with it.
    schema = f"seed bigint, at bigint, windows array<bigint>, block boolean, words binary, {KEY}"
    spark = docs.sparkSession
    pieces_path, held_path, later_path = [fresh_dir(spark, label) for label in ("stretches", "held", "later")]
    pieces = _with(keyed, sets, "anchors").mapInArrow(by_batch(stretches_of), schema)
    pieces = stored(pieces, "stretches", pieces_path, ["block"], compression="zstd")
    stretches = pieces.filter("not block").select("seed", "at", "windows", "none", "doc", "key")
    matched = ["none", "doc", "key", "first", "of_key", "of_at", "at"]
    # The windows of a stretch are needed again only where it has no earlier holder.
    windows = F.when(~F.col("later"), F.col("windows")).alias("windows")
    held = _held(stretches).select(*matched, "later", (F.size("windows") - 1).alias("more"), windows)
    held = stored(held, "held", held_path, ["later"], compression="zstd")
    paths.remove(spark, f"{pieces_path}/block=false")  # read for the last time
    alone = held.filter("not later").select(F.posexplode("windows").alias("_place", "seed"), "at", "none", "doc", "key")
    alone = alone.select("seed", (F.col("at") + F.col("_place")).alias("at"), "none", "doc", "key")
    later = held.filter("later").select(*matched, "more")
    later = later.unionByName(_held(alone).filter("later").select(*matched, F.lit(0).alias("more")))
    later = stored(later, "later", later_path, compression="zstd")
    paths.remove(spark, held_path)
    # One row per alignment of a document with a block of an earlier one.
    aligned = ["none", "doc", "key", "first", "of_key", F.floor(F.col("of_at") / BLOCK).alias("of_block"), (F.col("at") - F.col("of_at")).alias("shift")]
    matches = later.groupBy(*aligned).agg(F.min("of_at").alias("low"), F.max(F.col("of_at") + F.col("more")).alias("high"))
    blocks = pieces.filter("block and not none").groupBy("doc", "key", "seed", "at").agg(F.first("words").alias("words"))
    blocks = blocks.select(F.col("doc").alias("first"), F.col("key").alias("of_key"), F.col("seed").alias("of_block"), F.col("at").alias("from"), "words")
    found = skew_join(matches, blocks, ["first", "of_key", "of_block"])

    def passages(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The earlier document's words from the first to the last seed of an alignment."""
        texts = []
        for low, high, start, words in zip(*[batch.column(name).to_pylist() for name in ("low", "high", "from", "words")]):
            texts.append(b" ".join(words.split()[low - start : high - start + length]))
        start = pa.array([low + shift for low, shift in zip(batch.column("low").to_pylist(), batch.column("shift").to_pylist())], pa.int64())
        return pa.RecordBatch.from_arrays(
            [start, pa.array(texts, pa.binary()), *_keys(batch, np.arange(batch.num_rows))], names=["start", "words", "none", "doc", "key"]
        )

    held_words = found.mapInArrow(by_batch(passages), f"start bigint, words binary, {KEY}")
    # Written by document, so that the shuffles of windows are gone before texts move again.
    gone = held_words.groupBy("none", "doc", "key").agg(F.collect_set(F.struct("start", "words")).alias("others"))
    gone = stored(gone, "repeats", compression="zstd")
    for path in (pieces_path, later_path):
        paths.remove(spark, path)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, removed, kept, spans = [], [], [], []
        for text, others in zip(batch.column("text").to_pylist(), batch.column("others").to_pylist()):
            words = text.split()
            runs = []
            for other in others or ():
                start, theirs = other["start"], other["words"].split()
                runs += [(start + low, start + high) for low, high in _agreeing(words[start : start + len(theirs)], theirs, length)]
            whole: list[list[int]] = []
            for start, end in sorted(runs):
                if whole and start <= whole[-1][1]:
                    whole[-1][1] = max(whole[-1][1], end)
                else:
                    whole.append([start, end])
            left, place = [], 0
            for start, end in whole:
                left += words[place:start]
                place = end
            left += words[place:]
            counts.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(hashlib.sha256(b" ".join(left)).hexdigest())
            spans.append([{"start": start, "length": end - start} for start, end in whole])
        arrays = [
            batch.column("doc_id"),
            pa.array(counts, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(kept, pa.string()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept_sha256", "repeats"])

    result = f"doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, repeats {SPANS}"
    return _with(keyed, gone, "others").mapInArrow(by_batch(cut), result)
