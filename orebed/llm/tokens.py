"""Token ids as raw files with keyed access by a minimal perfect hash.

A written set is a folder:

``ids/part-00000-...-c000``  one file per shard, in ascending order of ids (null ids last) by name:
    the ids of its documents one after the other, as unsigned little-endian numbers of ``width``
    bytes, each document closed by the end id; then the shard's index; then the end id once more.
``shards``  a Parquet table with one row per shard: its file, range of ids, numbers and first place.

A shard's index, little-endian: the bit arrays of a minimal perfect hash over the shard's keys, with
the number of bits set before each 64 bits, its slots, the keys in the order of the documents, and a footer. A key is a
document id and the number of its repeat. The hash sends a key to a slot, and the slot holds a
fingerprint of the key, the place of its ids in the shard and their number, so
that one look finds a document, and a key that was never written is told by its fingerprint. A look
reads one word of bits and its count per level, then one slot, however many keys there are.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from mmap import ACCESS_READ, mmap

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orebed.llm.common import CLEANUP, by_batch, mix, settings, stored

MAGIC = b"ORETOK02"
# Footer: documents, ids, levels, bytes of the index, width, magic.
FOOTER = "<QQIQI8s"
# Bits per key on each level of the hash, and the most levels tried.
GAMMA = 2
MAX_LEVELS = 64
# Text per task and per shard; shards are read whole, a task writes several.
TASK_BYTES, SHARD_BYTES = 32 << 20, 6 << 20
# Spark's setting for the rows that a task takes in at a time: documents, or shards, which are large.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS, SHARDS = 500, 1
# Bytes of pieces that a task remembers besides those of the last group, what a piece
# counts for besides its letters, words encoded together, and text worked on at a time.
MAX_KNOWN = 32 << 20
KNOWN_BYTES = 160
TOGETHER = 256
GROUP_BYTES = 4 << 20
# How the tokenizer's vocabulary marks the end of a word.
END_OF_WORD = "</w>"
# Letters of Latin-1 make one word, ASCII punctuation before and after it others.
# An apostrophe before a word may be part of it ("'s").
PLAIN = r"^(?P<lead>[!-&(-/:-@\[-`{-~]*)(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-/:-@\[-`{-~]*)$"
# What a row counts for besides its text: its id, end id and place in the index.
ROW_BYTES = 64


def word_tokenizer() -> str:
    """Where the tokenizer that the queries use lies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- minimal perfect hash -------------------------------------------------


def key_hashes(ids: np.ndarray, none: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """64-bit hashes of keys; one to one for keys that are an id and its first occurrence."""
    with np.errstate(over="ignore"):
        values = mix(ids.astype(np.int64).view(np.uint64))
        more = (repeats > 0) | none
        extra = mix(repeats.astype(np.uint64) * np.uint64(2) + none.astype(np.uint64) + np.uint64(0x5BD1E995))
        return np.where(more, mix(np.where(none, np.uint64(0), values) + extra), values)


def _spots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(hashes + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(size)


@dataclass
class Level:
    """A bit array with the number of bits set before each word of 64, those of earlier levels included."""

    size: int
    words: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, bits: np.ndarray, base: int) -> Level:
        padded = np.zeros(-(-len(bits) // 64) * 64, bool)
        padded[: len(bits)] = bits
        words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(words).astype(np.int64)
        return cls(len(bits), words, (np.cumsum(ones) - ones + base).astype("<u4"))

    def ranks(self, spots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the bit of each spot is set, and how many are set before it."""
        word = (spots >> np.uint64(6)).astype(np.int64)
        # The bits up to and with the spot's own, which comes out on top.
        up_to = self.words[word] << (np.uint64(63) - (spots & np.uint64(63)))
        return (up_to >> np.uint64(63)).astype(bool), self.before[word].astype(np.int64) + np.bitwise_count(up_to) - 1


def build_levels(hashes: np.ndarray) -> list[Level]:
    """A minimal perfect hash: a key that is alone in its spot stays, the others go on to the next level."""
    levels, left, base = [], hashes, 0
    while len(left):
        if len(levels) == MAX_LEVELS:
            raise ValueError("two keys have the same hash")
        size = GAMMA * len(left) + 1
        spots = _spots(left, len(levels), size).astype(np.int64)
        taken = np.bincount(spots, minlength=size)
        levels.append(Level.of(taken == 1, base))
        alone = taken[spots] == 1
        left, base = left[~alone], base + int(alone.sum())
    return levels


def slots_of(levels: list[Level], hashes: np.ndarray) -> np.ndarray:
    """The slot of each key: the number of set bits before its own. -1 for keys that meet no set bit."""
    result = np.full(len(hashes), -1, np.int64)
    left = np.arange(len(hashes))
    for number, level in enumerate(levels):
        if not len(left):
            break
        hit, ranks = level.ranks(_spots(hashes[left], number, level.size))
        result[left[hit]] = ranks[hit]
        left = left[~hit]
    return result


def _prints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Index:
    """The index of one shard. Its arrays may lie in a file; ``nulls`` are bits, null ids come last."""

    levels: list[Level]
    prints: np.ndarray
    places: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    nulls: np.ndarray
    width: int
    total: int

    @classmethod
    def build(cls, ids: np.ndarray, none: np.ndarray, counts: np.ndarray, width: int) -> Index:
        hashes = key_hashes(ids, none, _repeats(ids, none))
        levels = build_levels(hashes)
        slots = slots_of(levels, hashes)
        prints, places, sizes = np.empty(len(ids), np.uint32), np.empty(len(ids), np.uint64), np.empty(len(ids), np.uint64)
        prints[slots] = _prints(hashes)
        places[slots] = np.cumsum(counts) - counts
        sizes[slots] = counts
        return cls(levels, prints, places, sizes, ids, np.packbits(none), width, int(counts.sum()))

    @property
    def none(self) -> np.ndarray:
        return np.unpackbits(self.nulls)[: len(self.ids)].astype(bool)

    def pack(self) -> bytes:
        parts = [np.array([level.size for level in self.levels], "<u8").tobytes()]
        parts += [array.tobytes() for level in self.levels for array in (level.words, level.before)]
        parts += [array.astype(array.dtype.newbyteorder("<")).tobytes() for array in (self.prints, self.places, self.counts)]
        parts += [self.ids.astype("<i8").tobytes(), self.nulls.tobytes()]
        body = b"".join(parts)
        return body + struct.pack(FOOTER, len(self.ids), self.total, len(self.levels), len(body), self.width, MAGIC)

    @classmethod
    def unpack(cls, content: bytes | memoryview | mmap) -> Index:
        """The index at the end of a shard. Nothing but its footer and the sizes of its levels is read here."""
        end = len(content)
        for width in (2, 4):  # the closing end id, which the footer precedes
            if content[end - width - 8 : end - width] == MAGIC:
                break
        else:
            raise ValueError("not a shard of token ids")
        foot = end - width - struct.calcsize(FOOTER)
        count, total, depth, size, width, _ = struct.unpack_from(FOOTER, content, foot)
        at = foot - size

        def take(kind: str, number: int) -> np.ndarray:
            nonlocal at
            array = np.frombuffer(content, kind, number, at)
            at += array.nbytes
            return array

        sizes = take("<u8", depth).tolist()
        levels = [Level(n, take("<u8", -(-n // 64)), take("<u4", -(-n // 64))) for n in sizes]
        prints, places, counts = take("<u4", count), take("<u8", count), take("<u8", count)
        ids = take("<i8", count)
        return cls(levels, prints, places, counts, ids, take("u1", -(-count // 8)), width, total)

    def find(self, ids: np.ndarray, none: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of ids of each key; number -1 for keys that are not there."""
        hashes = key_hashes(ids, none, repeats)
        slots = slots_of(self.levels, hashes)
        known = (slots >= 0) & (self.prints[slots] == _prints(hashes)) if len(self.prints) else np.zeros(len(ids), bool)
        safe = np.where(known, slots, 0)
        if not len(self.prints):
            return np.zeros(len(ids), np.int64), np.full(len(ids), -1, np.int64)
        return np.where(known, self.places[safe], 0).astype(np.int64), np.where(known, self.counts[safe], 0).astype(np.int64) - ~known

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All keys in the order of the documents."""
        return self.ids, self.none, _repeats(self.ids, self.none)


def _repeats(ids: np.ndarray, none: np.ndarray) -> np.ndarray:
    """The number of each key's earlier occurrences, for keys in order."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (none[1:] != none[:-1])
    starts = np.flatnonzero(new)
    return np.arange(len(ids)) - np.repeat(starts, np.diff(np.r_[starts, len(ids)]))


# --- encoding ---------------------------------------------------------------


@lru_cache(maxsize=2)
def _loaded(definition: str) -> tuple:
    """A tokenizer, which of its ids end a word, and its added tokens.

    A tokenizer that has encoded texts leaves some megabytes behind when it is dropped,
    so the tasks that a Python worker runs one after the other share one.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    last = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        last[number] = token.endswith(END_OF_WORD)
    return tokenizer, last, [token.content for token in tokenizer.get_added_tokens_decoder().values()]


class Encoder:
    """Texts to id bytes, by a tokenizer whose words end at white space.

    Chunks between ASCII white space are told apart and numbered by Arrow. Most are a
    word of Latin letters with ASCII punctuation around it, which this kind of
    tokenizer splits off; the word counts in lower case, as the tokenizer has it. Each
    different piece is encoded once and remembered for a while. That gives the ids of the whole text
    because white space always ends a word of this kind of tokenizer and is dropped.
    """

    def __init__(self, definition: str, width: int):
        # Added tokens are found before a text is split, so a chunk that holds one is no plain word.
        self.tokenizer, self.last, self.added = _loaded(definition)
        self.kind = np.dtype(f"<u{width}")
        self._start()

    def _start(self) -> None:
        """Nothing is known but the empty piece, which has no ids."""
        self.places: dict[str, int] = {"": 0}
        self.ids = np.empty(0, self.kind)
        self.ends = np.zeros(2, np.int64)
        self.uses = np.zeros(1, np.int64)
        self.held = 0

    def _forget(self) -> None:
        """Keep what several groups had, if that is less than half."""
        kept = np.flatnonzero(self.uses > 1)
        pieces = [piece for piece, place in self.places.items() if place and self.uses[place] > 1]
        ids, counts = self.ids[_runs(self.ends[kept], np.diff(self.ends)[kept])], np.diff(self.ends)[kept]
        self._start()
        size = sum(map(len, pieces)) + KNOWN_BYTES * len(pieces)
        if size < MAX_KNOWN // 2:
            # Places follow the order in which pieces were met, as the dictionary does.
            self._add(pieces, [ids], [counts[len(counts) - len(pieces) :]])

    def _add(self, pieces: list[str], runs: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
        """Remember pieces with their ids; their places."""
        places = np.arange(len(pieces)) + len(self.uses)
        self.places.update(zip(pieces, places.tolist()))
        self.ids = np.concatenate([self.ids, *runs])
        self.ends = np.r_[self.ends, self.ends[-1] + np.cumsum(np.concatenate(counts))] if len(pieces) else self.ends
        self.uses = np.r_[self.uses, np.zeros(len(pieces), np.int64)]
        self.held += sum(map(len, pieces)) + KNOWN_BYTES * len(pieces)
        return places

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, self.kind) for one in found]

    def _each(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Runs of ids of pieces, and how many each piece has."""
        ids = self._ids(pieces)
        return ids, [np.array([len(one) for one in ids], np.int64)]

    def _words(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The same of plain words: encoded many at a time and told apart by the ids that end a word."""
        runs, counts = [], []
        for first in range(0, len(words), TOGETHER):
            group = words[first : first + TOGETHER]
            ids = self._ids([" ".join(group)])[0]
            stops = np.flatnonzero(self.last[ids]) + 1
            if len(stops) == len(group) and stops[-1] == len(ids):
                found = [ids], [np.diff(np.r_[0, stops])]
            else:  # not one end for each word
                found = self._each(group)
            runs += found[0]
            counts += found[1]
        return runs, counts

    def _know(self, pieces: pa.Array, plain: bool) -> np.ndarray:
        """The place of each piece among the known ones."""
        found = pieces.dictionary_encode()
        listed = found.dictionary.to_pylist()
        get = self.places.get
        places = np.array([get(piece, -1) for piece in listed], np.int64)
        unknown = np.flatnonzero(places < 0)
        if len(unknown):
            news = [listed[place] for place in unknown.tolist()]
            places[unknown] = self._add(news, *(self._words(news) if plain else self._each(news)))
        self.uses[places] += 1
        return places[found.indices.to_numpy(zero_copy_only=False)]

    def _chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different chunks one after the other, and where each one's end."""
        parts = pc.extract_regex(chunks, PLAIN)
        whole = np.asarray(pc.is_valid(parts))
        for token in self.added:
            whole &= ~np.asarray(pc.match_substring(chunks, token, ignore_case=True))
        places = np.zeros((len(chunks), 3), np.int64)
        split = parts.filter(pa.array(whole))
        places[whole, 0] = self._know(pc.struct_field(split, "lead"), False)
        places[whole, 1] = self._know(pc.utf8_lower(pc.struct_field(split, "word")), True)
        places[whole, 2] = self._know(pc.struct_field(split, "tail"), False)
        places[~whole, 0] = self._know(chunks.filter(pa.array(~whole)), False)
        flat = places.ravel()
        counts = self.ends[flat + 1] - self.ends[flat]
        return self.ids[_runs(self.ends[flat], counts)], np.r_[0, np.cumsum(counts.reshape(-1, 3).sum(axis=1))]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Id bytes of each text; the texts are taken together."""
        if self.held > MAX_KNOWN:
            self._forget()
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        found = lists.flatten().dictionary_encode()
        ids, ends = self._chunk_ids(found.dictionary)
        chunks = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = ends[chunks + 1] - ends[chunks]
        data = ids[_runs(ends[chunks], counts)].tobytes()
        # Where each text's ids end, from where its chunks end.
        sums = np.r_[0, np.cumsum(counts)][np.asarray(lists.offsets) - lists.offsets[0].as_py()] * self.kind.itemsize
        return [data[low:high] for low, high in zip(sums[:-1].tolist(), sums[1:].tolist())]


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``counts`` of them, one run behind the other."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


def _groups(rows: Iterable[tuple[int | None, bytes]]) -> Iterator[list[tuple[int | None, bytes]]]:
    """Runs of rows that have about ``GROUP_BYTES``, texts and rows counted."""
    group, size = [], 0
    for row in rows:
        group.append(row)
        size += len(row[1]) + ROW_BYTES
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


# --- writing and reading ------------------------------------------------------


def _end_mark(end_id: int, width: int) -> str:
    """The end id as the text writer's line separator."""
    mark = end_id.to_bytes(width, "little")
    if max(mark) > 127:
        raise ValueError("the end id must consist of bytes below 128")
    return mark.decode("ascii")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the ids of all texts below ``path``, in ascending order of ids, null ids last.

    ``tokenizer`` is the local path of a tokenizers definition; its content travels with
    the tasks. Texts are encoded whole, without special tokens, and closed by ``end_id``. A null
    text has the end id alone. Rows that share an id are written in the order of a hash of their
    text; repeated rows are written as often as they occur. Other columns are ignored.

    Each task makes the shards of its range of ids in one pass, indexes included: two rows a file.
    Spark's own commit of the task makes them appear whole or not at all.
    """
    from tokenizers import Tokenizer

    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    width = 2 if Tokenizer.from_str(definition).get_vocab_size() <= 1 << 16 else 4
    mark = _end_mark(end_id, width)
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    # Rows that tie have the same id and text, so a running number may spread them.
    ranges = [*order[:2], F.col("_tie")]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(total // max(shard_bytes, TASK_BYTES) + 1, *ranges).sortWithinPartitions(*order)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, close = Encoder(definition, width), mark.encode("ascii")
        ids, parts, size = [], [], 0

        def written() -> pa.RecordBatch:
            """The two rows of a shard. The writer closes a row with the end id, as each document is closed here."""
            none = np.array([key is None for key in ids])
            keys = np.array([key or 0 for key in ids], np.int64)
            index = Index.build(keys, none, np.array([len(part) // width + 1 for part in parts]), width)
            return pa.RecordBatch.from_arrays([pa.array([close.join(parts), index.pack()], pa.binary())], names=["value"])

        rows = (row for batch in batches for row in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()))
        for group in _groups(rows):
            ids += [key for key, _ in group]
            parts += encoder.encode([text for _, text in group])
            size += sum(len(text) + ROW_BYTES for _, text in group)
            if size >= shard_bytes:
                yield written()
                ids, parts, size = [], [], 0
        if ids:
            yield written()

    dealt = dealt.select("doc_id", F.col("text").cast("binary").alias("text"))
    raw = dealt.mapInArrow(shard, "value binary").select(F.col("value").cast("string"))
    with settings(spark, {CLEANUP: "true", BATCH: str(ROWS)}):
        raw.write.option("lineSep", mark).option("maxRecordsPerFile", 2).text(f"{path}/ids")

    def summary(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(enumerate(map(Index.unpack, _contents(batch))))
        real = [(index.ids[~index.none]) for _, index in found]
        highest = [int((ids == ids[-1]).sum()) if len(ids) else 0 for ids in real]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("file"),
                pa.array([int(ids[0]) if len(ids) else None for ids in real], pa.int64()),
                pa.array([int(ids[-1]) if len(ids) else None for ids in real], pa.int64()),
                pa.array(highest, pa.int64()),
                pa.array([len(index.ids) - len(ids) for (_, index), ids in zip(found, real)], pa.int64()),
                pa.array([len(index.ids) for _, index in found], pa.int64()),
                pa.array([index.total for _, index in found], pa.int64()),
            ],
            names=["file", "low", "high", "at_high", "nulls", "documents", "ids"],
        )

    fields = "file string, low bigint, high bigint, at_high bigint, nulls bigint, documents bigint, ids bigint"
    with settings(spark, {BATCH: str(SHARDS)}):
        shards = stored(_files(spark, path).mapInArrow(by_batch(summary), fields), "shards")
    # The first place of a shard, by way of sums over groups of 1,024 tasks. A task's files are numbered by name.
    # A group of the run's id, between the two numbers, may start like the second ("-c4a1-").
    number = F.regexp_extract("file", r"-c(\d+)[^-]*$", 1).cast("bigint")
    shards = shards.withColumn("task", F.regexp_extract("file", r"^part-(\d+)-", 1).cast("bigint"))
    shards = shards.withColumn("shard", number).withColumn("part", F.floor(F.col("task") / 1024))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("ids").alias("n"))
    parts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("part").orderBy("task", "shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("ids").over(inner), F.lit(0))
    placed = shards.withColumn("inner", start).join(parts, F.col("part") == F.col("_part"))
    placed = placed.withColumn("start", F.col("base") + F.col("inner"))
    names = ["task", "shard", "file", "start", "low", "high", "nulls", "documents", "ids"]
    placed = placed.select(*names, "at_high")
    repeats = _first_repeats(placed, "low", "high", "at_high", "low_repeat")
    # Null ids are one key more, which several shards may share likewise.
    has_nulls = F.when(F.col("nulls") > 0, 0)
    nulls = _first_repeats(placed.withColumn("null", has_nulls), "null", "null", "nulls", "null_repeat")
    named = placed.select(*names).join(repeats, ["task", "shard"], "left").join(nulls, ["task", "shard"], "left")
    named.write.parquet(f"{path}/shards")


def _first_repeats(shards: DataFrame, first: str, last: str, count: str, name: str) -> DataFrame:
    """(task, shard, name): how many rows of each shard's first key lie in the shards before it, as their last key."""
    asked = shards.select(F.col(first).alias("key"), "task", "shard", F.lit(0).alias("held"), F.lit(0).cast("bigint").alias("n"))
    held = shards.select(F.col(last).alias("key"), "task", "shard", F.lit(1).alias("held"), F.col(count).alias("n"))
    order = Window.partitionBy("key").orderBy("task", "shard", "held").rowsBetween(Window.unboundedPreceding, 0)
    sums = asked.unionByName(held).filter("key IS NOT NULL").withColumn(name, F.sum("n").over(order))
    return sums.filter("held = 0").select("task", "shard", name)


def _files(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> DataFrame:
    """(file, content) of the shard files; tasks without documents leave empty ones, which are left out."""
    where = [f"{path}/ids/{name}" for name in names] if names is not None else f"{path}/ids"
    files = spark.read.format("binaryFile").load(where).filter("length > 0")
    return files.select(F.substring_index("path", "/", -1).alias("file"), "content")


def _contents(batch: pa.RecordBatch) -> list[memoryview]:
    """The contents of the batch's files, not copied."""
    return [memoryview(content.as_buffer()).cast("B") for content in batch.column("content")]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a written set.

    Every key of a shard is looked up in the shard's index, and the ids found
    there are read: ``start`` counts the ids of all documents before, ``n_tokens`` includes
    the end id, ``ids_crc32`` is over the ids as unsigned little-endian 32-bit numbers.

    The rows are stored, as a task holds one shard at a time only under a setting of the run.
    """

    def documents(batch: pa.RecordBatch) -> pa.RecordBatch:
        files, ids, places, counts, sums = [], [], [], [], []
        for file, content in zip(batch.column("file").to_pylist(), _contents(batch)):
            index = Index.unpack(content)
            at, number = index.find(*index.keys())
            if (number < 0).any():
                raise ValueError(f"{file}: a key is missing from its index")
            payload = np.frombuffer(content, f"<u{index.width}", index.total)
            files += [file] * len(at)
            ids += [None if none else key for key, none in zip(index.ids.tolist(), index.none.tolist())]
            places += at.tolist()
            counts += number.tolist()
            sums += [zlib.crc32(payload[low : low + n].astype("<u4")) for low, n in zip(at.tolist(), number.tolist())]
        arrays = [pa.array(files, pa.string()), *(pa.array(values, pa.int64()) for values in (ids, places, counts, sums))]
        return pa.RecordBatch.from_arrays(arrays, names=["file", "doc_id", "place", "n_tokens", "ids_crc32"])

    fields = "file string, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint"
    with settings(spark, {BATCH: str(SHARDS)}):
        found = stored(_files(spark, path).mapInArrow(by_batch(documents), fields), "found")
    starts = spark.read.parquet(f"{path}/shards").select(F.col("file").alias("_file"), F.col("start").alias("_start"))
    joined = found.join(starts, F.col("file") == F.col("_file"))
    return joined.select("doc_id", (F.col("_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, doc_ids: Sequence[int | None]) -> DataFrame:
    """(doc_id, repeat, ids) of the documents with the given ids; ids that were not written give no row.

    None stands for the documents without id. Rows that share an id are numbered from 0 in the
    order in which they were written, over all shards. Only the shards whose range holds a wanted id are read.
    """
    wanted = sorted({key for key in doc_ids if key is not None})
    nulls = None in doc_ids
    inside = F.exists(F.lit(wanted).cast("array<bigint>"), lambda key: key.between(F.col("low"), F.col("high")))
    held = F.coalesce(inside, F.lit(False)) | ((F.col("nulls") > 0) & F.lit(nulls))
    shards = spark.read.parquet(f"{path}/shards").filter(held)
    names = sorted(row["file"] for row in shards.select("file").collect())
    schema = "doc_id bigint, repeat bigint, ids array<bigint>"
    if not names:
        return spark.createDataFrame([], schema)

    def pick(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for content, low, *firsts in zip(*[batch.column(name).to_pylist() for name in ("content", "low", "low_repeat", "null_repeat")]):
            index = Index.unpack(content)
            payload = np.frombuffer(content, f"<u{index.width}", index.total)
            for none, all_keys, first in ((False, wanted, firsts[0]), (True, [0] * nulls, firsts[1])):
                keys, repeat = np.array(all_keys, np.int64), 0
                while len(keys):
                    at, number = index.find(keys, np.full(len(keys), none), np.full(len(keys), repeat))
                    there = number >= 0
                    for key, place, n in zip(keys[there].tolist(), at[there].tolist(), number[there].tolist()):
                        before = first if none or key == low else 0
                        rows.append((None if none else key, before + repeat, payload[place : place + n].tolist()))
                    keys, repeat = keys[there], repeat + 1
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "repeat", "ids"])

    known = shards.select(F.col("file").alias("_file"), "low", "low_repeat", "null_repeat")
    files = _files(spark, path, names).join(known, F.col("file") == F.col("_file"))
    return files.select("content", "low", "low_repeat", "null_repeat").mapInArrow(by_batch(pick), schema)


def read_one(file: str, doc_id: int | None, repeat: int = 0) -> np.ndarray | None:
    """The ids of one document of a shard file that this machine can open, or None if the shard has not got it.

    The file is mapped, so only the pages with its footer, one word of bits a level, one slot
    and the ids are read. ``repeat`` counts within the shard.
    """
    with open(file, "rb") as opened, mmap(opened.fileno(), 0, access=ACCESS_READ) as content:
        index = Index.unpack(content)
        none = np.array([doc_id is None])
        (at,), (number,) = index.find(np.array([doc_id or 0], np.int64), none, np.array([repeat]))
        found = None
        if number >= 0:
            found = np.frombuffer(content, f"<u{index.width}", number, at * index.width).copy()
        del index
    return found
