"""Benchmark passages in documents: SimHash windows, multi-index blocks, exact verification."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import run_hashes, word_hashes

SHINGLE = 5
LEAST = 0.8
# Windows this many bits apart and closer are candidates. A weighted similarity of 0.8 makes bits
# differ with a chance of 15 %, so that more than 19 of 64 do once in a thousand windows.
RADIUS = 19
# Votes are whole numbers, so that sums over windows are exact: roots of weights times this.
SCALE = 1 << 10
BLOCKS, BLOCK_BITS = 4, 16
# Benchmark items compared in one pass over the documents; longer benchmarks take more passes.
ITEMS = 1000
# Words around hits whose votes are summed at a time.
SPAN = 1 << 14


def _force(weights: np.ndarray) -> np.ndarray:
    """The root of a weight: the angle between sums of random signs goes by squared votes, the similarity by weights."""
    return np.rint(np.sqrt(weights) * SCALE).astype(np.int64)


def _spread(hashes: np.ndarray, forces: np.ndarray) -> np.ndarray:
    """The votes of shingles: one row of 64 signed forces each."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
    return np.where(bits == 1, forces[:, None], -forces[:, None]).astype(np.int64)


def _sums(rows: np.ndarray) -> np.ndarray:
    return np.vstack([np.zeros((1, 64), np.int64), np.cumsum(rows, axis=0)])


class Votes:
    """Votes of all windows of a run of shingles. A shingle votes once in a window, with the root of its whole weight there."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray):
        self.hashes, self.weights = hashes, weights
        self.single = _sums(_spread(hashes, _force(weights)))
        order = np.argsort(hashes, kind="stable")
        kind = np.r_[0, np.cumsum(np.diff(hashes[order]) != 0)] if len(hashes) else order
        # Shingles in order, and within one its places.
        self.width = 2 * len(hashes) + 2
        self.keys = kind * self.width + order
        self.rank = np.empty_like(order)
        self.rank[order] = np.arange(len(order))
        gaps = np.diff(order)[np.diff(kind) == 0]
        self.closest = int(gaps.min()) if len(gaps) else len(hashes)

    def of(self, starts: np.ndarray, span: int) -> np.ndarray:
        """One row of 64 sums for each window of ``span`` shingles."""
        if span <= self.closest:
            return self.single[starts + span] - self.single[starts]
        keys = self.keys[self.rank]
        entered = self.rank - np.searchsorted(self.keys, np.maximum(keys - span + 1, keys // self.width * self.width)) + 1
        left = np.searchsorted(self.keys, np.minimum(keys + span, (keys // self.width + 1) * self.width)) - self.rank
        # What a shingle adds as the window's last, and takes along as its first, by how often the window holds it.
        gains = [_force(count * self.weights) - _force((count - 1) * self.weights) for count in (entered, left)]
        into, out = [_sums(_spread(self.hashes, gain)) for gain in gains]
        return into[starts + span] - out[starts]


def _prints(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1).view(">u8")[:, 0].astype(np.uint64)


def _blocks(prints: np.ndarray) -> list[np.ndarray]:
    low = np.uint64((1 << BLOCK_BITS) - 1)
    return [((prints >> np.uint64(BLOCK_BITS * place)) & low).astype(np.int64) for place in range(BLOCKS)]


@dataclass
class Text:
    """A text's lower-cased words as hashes, and the length of each."""

    words: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, text: bytes | None) -> Text:
        words = (text or b"").lower().split()
        return cls(word_hashes(words), np.fromiter(map(len, words), np.int64, len(words)))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each run of ``size`` words, and its weight: the bytes of its words."""
        total = np.r_[0, np.cumsum(self.lengths)]
        return run_hashes(self.words, size), total[size:] - total[: len(total) - size]


def _bag(hashes: np.ndarray, weights: np.ndarray) -> dict[int, tuple[int, int]]:
    """Shingles with how often they occur and their weight."""
    counts = Counter(hashes.tolist())
    return {h: (counts[h], w) for h, w in zip(hashes.tolist(), weights.tolist())}


def similarity(one: dict, two: dict) -> float:
    """Weighted Jaccard similarity: shared weight by all weight, repeats included."""
    shared = sum(w * min(n, two[h][0]) for h, (n, w) in one.items() if h in two)
    total = sum(n * w for n, w in one.values()) + sum(n * w for n, w in two.values()) - shared
    return shared / total if total else 0.0


class Items:
    """Benchmark items of one pass: shingles, fingerprints and the multi-index."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        texts = [(item, Text.of(text)) for item, text in rows]
        texts = [(item, text) for item, text in texts if len(text.words)]
        self.ids = [item for item, _ in texts]
        self.sizes = np.array([len(text.words) for _, text in texts], np.int64)
        self.runs = np.minimum(self.sizes, SHINGLE)
        parts = [text.shingles(int(run)) for (_, text), run in zip(texts, self.runs)]
        self.bags = [_bag(*part) for part in parts]
        votes = [Votes(*part).of(np.zeros(1, np.int64), len(part[0]))[0] for part in parts]
        self.prints = _prints(np.array(votes)) if votes else np.empty(0, np.uint64)
        # By length of shingle: known shingles in order, and the items each occurs in.
        self.anchors: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}
        for run in np.unique(self.runs).tolist():
            where: dict[int, list[int]] = {}
            for number in np.flatnonzero(self.runs == run).tolist():
                for shingle in self.bags[number]:
                    where.setdefault(shingle, []).append(number)
            known = np.array(sorted(where), np.uint64)
            self.anchors[run] = known, [np.array(where[h]) for h in known.tolist()]

    @cached_property
    def index(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per block, items by every value that differs from theirs in few enough bits.

        ``RADIUS`` differing bits in four blocks leave one block with at most a quarter of them.
        """
        flips = range(RADIUS // BLOCKS + 1)
        masks = [sum(1 << bit for bit in bits) for n in flips for bits in combinations(range(BLOCK_BITS), n)]
        result = []
        for values in _blocks(self.prints):
            spots = (values[:, None] ^ np.array(masks)[None, :]).ravel()
            items = np.repeat(np.arange(len(values)), len(masks))
            order = np.argsort(spots, kind="stable")
            starts = np.searchsorted(spots[order], np.arange((1 << BLOCK_BITS) + 1))
            result.append((starts, items[order]))
        return result

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, item) within the radius."""
        windows, items = [], []
        for (starts, listed), values in zip(self.index, _blocks(prints)):
            counts = starts[values + 1] - starts[values]
            window = np.repeat(np.arange(len(prints)), counts)
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts[values], counts)
            item = listed[place]
            near = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
            windows.append(window[near])
            items.append(item[near])
        pairs = np.unique(np.concatenate(windows) * len(self.ids) + np.concatenate(items))
        return pairs // len(self.ids), pairs % len(self.ids)

    def hits(self, texts: list[Text], run: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(text, places, numbers) of known shingles of one length, for texts that have any."""
        known = self.anchors[run][0]
        words = np.concatenate([text.words for text in texts])
        ends = np.cumsum([len(text.words) for text in texts])
        shingles = run_hashes(words, run)
        # A coarse table rules nearly all shingles out.
        table = np.zeros(1 << 20, bool)
        table[known >> np.uint64(44)] = True
        places = np.flatnonzero(table[shingles >> np.uint64(44)])
        numbers = np.minimum(np.searchsorted(known, shingles[places]), len(known) - 1)
        owners = np.searchsorted(ends, places, "right")
        real = (known[numbers] == shingles[places]) & (places + run <= ends[owners])
        places, numbers, owners = places[real], numbers[real], owners[real]
        found = []
        for owner in np.unique(owners).tolist():
            mine = owners == owner
            found.append((owner, places[mine] - (ends[owner] - len(texts[owner].words)), numbers[mine]))
        return found

    def search(self, text: Text, run: int, places: np.ndarray, numbers: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """For each item found (its number) the most similar window: similarity, -start, words."""
        best: dict[int, tuple[float, int, int]] = {}
        hashes, weights = text.shingles(run)
        listed = self.anchors[run][1]
        near = np.unique(np.concatenate([listed[number] for number in np.unique(numbers)]))
        sizes = np.unique(np.minimum(self.sizes[near], len(text.words)))
        reach = int(sizes.max())
        groups = np.split(places, np.flatnonzero(np.diff(places) > reach) + 1)
        pieces = [part for group in groups for part in np.split(group, np.flatnonzero(np.diff(group // SPAN)) + 1)]
        for part in pieces:
            low, high = max(0, part[0] + run - reach), min(len(hashes), part[-1] + reach - run + 1)
            votes = Votes(hashes[low:high], weights[low:high])
            for size in sizes.tolist():
                span = size - run + 1
                # Windows that hold one of the known shingles; others share nothing with any item.
                first = np.unique((part[:, None] - np.arange(span)[None, :]).ravel())
                first = first[(first >= low) & (first + span <= high)]
                if not len(first):
                    continue
                prints = _prints(votes.of(first - low, span))
                windows, items = self.candidates(prints)
                fits = (np.minimum(self.sizes[items], len(text.words)) == size) & (self.runs[items] == run)
                for window, item in zip(windows[fits].tolist(), items[fits].tolist()):
                    start = int(first[window])
                    bag = _bag(hashes[start : start + span], weights[start : start + span])
                    alike = similarity(bag, self.bags[item])
                    if alike >= LEAST:
                        best[item] = max(best.get(item, (0.0, 0, 0)), (alike, -start, size))
        return best


def _leaks(batch: pa.RecordBatch, items: Items) -> list[tuple[int, int | None, int, int, float]]:
    """(row, item, start, words, similarity) of all leaks in a batch."""
    if not items.ids:
        return []
    texts = [Text.of(text) for text in batch.column("text").cast(pa.binary()).to_pylist()]
    found = []
    for run in items.anchors:
        for row, places, numbers in items.hits(texts, run):
            for number, (alike, start, size) in items.search(texts[row], run, places, numbers).items():
                found.append((row, items.ids[number], -start, size, alike))
    return found


def _passes(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark by groups of about ``ITEMS`` items, each small enough to travel with the tasks."""
    count = -(-benchmark.count() // ITEMS)
    group = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(count, 1)))
    for number in range(count):
        rows = benchmark.filter(group == number).select("item_id", "text").collect()
        yield Items([(row["item_id"], (row["text"] or "").encode()) for row in rows])


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): benchmark items that documents hold.

    One row per document and item: the most similar window of the document, the first of these, as
    its first word, its number of words and its similarity. A window has as many words as the item;
    a document shorter than the item is one window. Similarity is the weighted
    Jaccard similarity of shingles of five lower-cased words (a shorter item is one shingle), each weighing its bytes; 0.8 and
    more is a leak. Null or wordless texts and items match nothing; rows without id appear with a null
    id; repeated rows and items give repeated rows. Other columns are ignored.

    The benchmark is the stated query set: it is taken in groups of about a thousand items, one pass over all
    documents each. Only windows that hold at least one shingle of an item can be similar to any, so
    only these get a SimHash; its four 16-bit blocks find all items within 19 bits, and each
    candidate's similarity is computed in full.
    """
    schema = "doc_id bigint, item_id bigint, start bigint, n_words bigint, similarity double"
    rows = docs.select("doc_id", "text")
    result = docs.sparkSession.createDataFrame([], schema)
    for items in _passes(benchmark):

        def leaks(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if found := _leaks(batch, items):
                    places, *columns = zip(*found)
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
                    arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
                    ids = batch.column("doc_id").take(pa.array(places))
                    yield pa.RecordBatch.from_arrays([ids, *arrays], names=["doc_id", "item_id", "start", "n_words", "similarity"])

        result = result.unionByName(rows.mapInArrow(leaks, schema))
    return result


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without leaks, as :func:`find_leaks` has them, with all columns."""
    for items in _passes(benchmark):

        def clean(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[row for row, *_ in _leaks(batch, items)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
