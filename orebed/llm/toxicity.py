"""Toxic text by a support vector machine over a subsequence string kernel, with Nyström landmarks.

The kernel of two strings sums over all four-letter subsequences they share,
each weighted by ``DECAY`` per letter skipped, up to three skips in all; the edge of a word
counts as a letter at either end of one. Marks in a row, white space
included, count as one, and as none between four or more single letters. An insult with letters put in
or with marks between its letters, however many, so keeps much of its kernel value with the insult itself. Landmarks are words, and parts of words, of the training texts; the kernel
values with them, whitened by their own kernel matrix, are the features of a linear
machine trained on pieces of sentences.

The machine's answer is linear in the subsequences of a piece, so the weights of landmarks
fold into one weight per subsequence, and a text of any length is scored in
a pass of table look-ups.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import by_batch, held_out, labelled_sample, text_bytes

BEYOND = 13  # codes that characters beyond ASCII share
LETTERS = 27 + BEYOND  # none, a to z, and these
ORDER, SKIPS, DECAY = 4, 3, 0.8
# Sentences are scored by pieces that start every STEP bytes and are PIECE long.
PIECE, STEP = 48, 16
LANDMARKS = 256
# The training sample: texts of each label, and the longest text taken.
PER_CLASS, MAX_CHARS = 1000, 6000
ROUNDS, PENALTY = 3, 1e-3

# Places of the three later letters of a subsequence, as distances from the first, by letters skipped.
SHAPES = [
    (a, a + b, a + b + c, DECAY ** (a + b + c - ORDER + 1))
    for a, b, c in product(range(1, SKIPS + 2), repeat=3)
    if a + b + c <= SKIPS + ORDER - 1
]
REACH = SKIPS + ORDER - 1

CODES = np.zeros(256, np.int32)
CODES[ord("a") : ord("z") + 1] = CODES[ord("A") : ord("Z") + 1] = np.arange(1, 27)
# Between texts; no UTF-8 text has this byte.
APART = b"\xff" * REACH


def _letters(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a text's characters, and the place of the last byte of each.

    Marks in a row are one, and those between the letters of a word spelled out by single letters are none.
    """
    data = np.frombuffer(text, np.uint8)
    before, after = np.r_[np.uint8(0), data[:-1]], np.r_[data[1:], np.uint8(0)]
    inner = (data & 0xC0) == 0x80
    codes = CODES[data]
    codes[inner] = 27 + (data[inner] + 5 * before[inner].astype(np.int32)) % BEYOND
    mark = (data < 128) & (codes == 0)
    again = np.r_[False, mark[:-1]] & mark
    kept = np.flatnonzero((data < 128) & ~again | inner & ((after & 0xC0) != 0x80) | (data == APART[0]))
    # Letters that stand alone, and those of them that follow each other.
    gap = np.r_[True, codes[kept] == 0, True]
    alone = np.flatnonzero(gap[:-2] & ~gap[1:-1] & gap[2:])
    runs = np.split(np.arange(len(alone)), np.flatnonzero(np.diff(alone) != 2) + 1)
    spelled = [alone[run[:-1]] + 1 for run in runs if len(run) >= ORDER]
    kept = np.delete(kept, np.concatenate(spelled)) if spelled else kept
    return codes[kept], kept


def _subsequences(codes: np.ndarray):
    """For each shape the number of the subsequence that starts at each place, and its weight."""
    padded = np.r_[codes, np.zeros(REACH, np.int32)]
    count = len(codes)
    for one, two, three, weight in SHAPES:
        number = codes * LETTERS + padded[one : one + count]
        number = (number * LETTERS + padded[two : two + count]) * LETTERS + padded[three : three + count]
        yield number, weight


def _real() -> np.ndarray:
    """Which subsequence numbers count: letters, of which the first or the last may be the edge of a word."""
    first, second, third, last = np.meshgrid(*[np.arange(LETTERS) > 0] * ORDER, indexing="ij")
    return (second & third & (first | last)).ravel()


def features(text: bytes, real: np.ndarray) -> Counter:
    """The weight of each subsequence of a string."""
    found: Counter = Counter()
    for numbers, weight in _subsequences(_letters(text)[0]):
        for number in numbers[real[numbers]].tolist():
            found[number] += weight
    return found


def kernel(one: bytes, two: bytes) -> float:
    """The kernel of two strings, normalised to 1 for equal ones."""
    real = _real()
    a, b = features(one, real), features(two, real)
    norm = (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5
    return sum(v * b[k] for k, v in a.items() if k in b) / norm if norm else 0.0


def _piece_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all sentences of a text; together they cover it."""
    stops = [match.end() for match in re.finditer(rb"[.!?\n]+", text)]
    edges = np.unique(np.array([0, *stops, len(text)], np.int64))
    if len(edges) < 2:
        return np.zeros(1, np.int64), np.full(1, len(text), np.int64)
    lows, highs = edges[:-1], edges[1:]
    # A piece every STEP bytes, but none that lies in the last one of its sentence.
    counts = np.maximum(1, -(-(highs - lows - PIECE) // STEP) + 1)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(lows, counts) + place * STEP
    return starts, np.minimum(starts + PIECE, np.repeat(highs, counts))


@dataclass
class Model:
    """Folded weights of subsequences, and the logistic curve that turns an answer into a probability."""

    table: np.ndarray
    slope: float
    shift: float

    def worst(self, texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """The largest answer over the pieces of each text, and the piece that gives it."""
        data = APART.join(texts) + APART  # wide enough that no subsequence spans two texts
        codes, places = _letters(data)
        answers = np.zeros(len(codes), np.float32)
        for numbers, weight in _subsequences(codes):
            answers += self.table[numbers] * np.float32(weight)
        sums = np.zeros(len(data), np.float32)
        sums[places] = answers
        total = np.r_[0.0, np.cumsum(sums, dtype=np.float64)]
        result, found, base = np.empty(len(texts)), [], 0
        for row, text in enumerate(texts):
            starts, ends = _piece_bounds(text)
            answers = total[base + ends] - total[base + starts]
            most = int(answers.argmax())
            result[row] = answers[most]
            found.append(text[starts[most] : ends[most]])
            base += len(text) + REACH
        return result, found

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return _logistic(self.slope * self.worst(texts)[0] + self.shift)


def _logistic(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -50, 50)))


def _landmarks(sample: list[tuple[bytes, int]]) -> list[bytes]:
    """Word parts that tell the labels apart best, no two of them much alike, and clean words.

    Half of the clean words are the commonest that have four letters in a row from such a part: what
    toxic words are most easily taken for. The others are the commonest of all.
    """
    found = [(re.findall(r"[a-z\x80-\U0010ffff]{3,}", text.lower().decode("utf-8", "replace")), label) for text, label in sample]
    own = [({word for word in words if len(word.encode()) > 3}, label) for words, label in found]

    def parts_of(chosen: set[str]) -> set[str]:
        edged = [f" {word} " for word in chosen]
        return {word[at : at + n] for word in edged for n in (4, 5, 6, 7, 8) for at in range(len(word) - n + 1)}

    toxic, clean, words = Counter(), Counter(), Counter()
    for chosen, label in own:
        if label:
            toxic.update(parts_of(chosen))
    toxic = Counter({part: n for part, n in toxic.items() if n > 2})
    for chosen, label in own:
        if not label:
            clean.update(part for part in parts_of(chosen) if part in toxic)
            words.update(chosen)
    many = {label: max(1, sum(one == label for _, one in sample)) for label in (0, 1)}
    telling = {
        g: n / many[1] * (np.log((n + 0.5) / (many[1] + 1)) - np.log((clean[g] + 0.5) / (many[0] + 1)))
        for g, n in toxic.items()
    }
    worst: list[str] = []
    used: set[str] = set()
    for part in sorted(telling, key=lambda g: (-telling[g], -len(g), g)):
        runs = {part[at : at + 5] for at in range(max(1, len(part) - 4))}
        if not runs & used:
            worst.append(part)
            used |= runs
        if len(worst) == LANDMARKS // 2:
            break
    near = {part[at : at + 4] for part in worst for at in range(len(part) - 3)}
    usual = sorted((w for w in words if w not in set(worst)), key=lambda w: (-words[w], w))
    alike = [w for w in usual if any(w[at : at + 4] in near for at in range(len(w) - 3))][: LANDMARKS // 4]
    return [mark.encode() for mark in dict.fromkeys(worst + alike + usual)][:LANDMARKS]


def _machine(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, both labels weighing alike, by Newton steps."""
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    padded = np.hstack([values, np.ones((len(values), 1))])
    ridge = PENALTY * np.eye(padded.shape[1])
    ridge[-1, -1] = 1e-9
    weights = np.zeros(padded.shape[1])
    for _ in range(30):
        near = signs * (padded @ weights) < 1
        active, pull = padded[near], share[near]
        new = np.linalg.solve((active * pull[:, None]).T @ active + ridge, (active * (pull * signs[near])[:, None]).sum(axis=0))
        if np.allclose(new, weights, atol=1e-8):
            break
        weights = new
    return weights[:-1], weights[-1]


def _curve(answers: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, after Platt: smoothed targets, damped Newton steps."""
    ones, zeros = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = max(answers.std(), 1e-6)
    x = np.stack([answers / scale, np.ones(len(answers))], axis=1)
    w = np.array([1.0, 0.0])
    loss = lambda v: float(np.sum(np.logaddexp(0, x @ v) - target * (x @ v)))
    for _ in range(100):
        p = _logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        rate = 1.0
        while rate > 1e-6 and loss(w - rate * step) > loss(w):
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def train(sample: list[tuple[bytes, int]]) -> Model:
    """A model from labelled texts. A sample of one label only gives one that always answers with it."""
    labels = np.array([label for _, label in sample])
    table = np.zeros(LETTERS**ORDER, np.float32)
    if len(set(labels.tolist())) < 2 or not (marks := _landmarks(sample)):
        known = len(set(labels.tolist())) == 1
        return Model(table, 0.0, (4.0 if labels[0] else -4.0) if known else 0.0)
    real = _real()
    # Landmarks as columns of normalised subsequence weights, over the subsequences they have.
    found = [features(mark, real) for mark in marks]
    numbers = np.array(sorted(set().union(*found)), np.int64)
    row_of = np.full(LETTERS**ORDER, -1, np.int32)
    row_of[numbers] = np.arange(len(numbers))
    columns = np.zeros((len(numbers), len(marks)), np.float32)
    for place, one in enumerate(found):
        if one:
            columns[row_of[list(one)], place] = list(one.values())
    columns /= np.maximum(np.linalg.norm(columns, axis=0), 1e-9)
    values, vectors = np.linalg.eigh((columns.T @ columns).astype(np.float64))
    kept = values > 1e-4
    whiten = vectors[:, kept] / np.sqrt(values[kept])

    def mapped(texts: list[bytes]) -> np.ndarray:
        """Whitened kernel values of strings with the landmarks."""
        result = np.zeros((len(texts), len(marks)), np.float32)
        for low in range(0, len(texts), 500):
            group = texts[low : low + 500]
            ends = np.cumsum([len(text) + REACH for text in group])
            codes, places = _letters(APART.join(group) + APART)
            for spots, weight in _subsequences(codes):
                rows = row_of[spots]
                hits = np.flatnonzero(rows >= 0)
                if len(hits):
                    owners, starts = np.unique(np.searchsorted(ends, places[hits], "right"), return_index=True)
                    result[low + owners] += np.float32(weight) * np.add.reduceat(columns[rows[hits]], starts, axis=0)
        return result @ whiten

    # Which piece makes a text toxic is not labelled: it is the one the machine finds worst, and clean
    # texts are to stay clean at their worst. The first guess is the piece nearest a telling landmark.
    table[numbers] = columns[:, : LANDMARKS // 2].max(axis=1)
    model = Model(table, 1.0, 0.0)
    texts, chosen = [text for text, _ in sample], {}
    for _ in range(ROUNDS):
        found = _grouped(model, texts)[1]
        # Pieces of clean texts found earlier stay, so that they do not come back.
        chosen = {pair: None for pair in chosen if not pair[1]} | dict.fromkeys(zip(found, labels.tolist()))
        points, marked = zip(*chosen)
        weights, _ = _machine(mapped(list(points)), np.array(marked))
        table = np.zeros(LETTERS**ORDER, np.float32)
        table[numbers] = columns @ (whiten @ weights)
        model = Model(table, 1.0, 0.0)
    return Model(table, *_curve(_grouped(model, texts)[0], labels))


def _grouped(model: Model, texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Answers and worst pieces of many texts, a hundred at a time."""
    parts = [model.worst(texts[place : place + 100]) for place in range(0, len(texts), 100)]
    return np.concatenate([answers for answers, _ in parts]), [piece for _, pieces in parts for piece in pieces]


def fit(docs: DataFrame, labels: DataFrame, folds: int, fold: int) -> Model:
    """Train on at most 1,000 texts of each label, or pieces of 6,000 characters of longer ones, picked by hash.

    The curve's odds, those of the sample, are then set to those of all training labels.
    """
    usable = ~held_out(F.col("doc_id"), folds, fold)
    sample = labelled_sample(docs, labels, "toxic", usable, PER_CLASS, MAX_CHARS)
    model = train(sample)
    clean, toxic = labels.filter(usable).agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    ones = sum(label for _, label in sample)
    if clean and toxic and 0 < ones < len(sample):
        model.shift += float(np.log(toxic / clean) - np.log(ones / (len(sample) - ones)))
    return model


# Bytes of text scored together.
GROUP_BYTES = 1 << 18


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Labels of rows whose ``crc32(doc_id as text) mod folds`` is ``fold`` are not learnt from.
    ``score`` is the probability that the whole text is toxic, by its worst piece of a sentence; nothing
    but the text goes into it. A null text is empty, and an empty one has a piece without letters. Null ids
    are not held out. Without labels every score is 0.5. Repeated rows give repeated rows; other columns
    are ignored. Repeated labels count once, contradicting ones as the larger.
    """
    model = fit(docs, labels, folds, fold)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, parts, group, size = batch.column("text").to_pylist(), [], [], 0
        for place, text in enumerate(texts):
            group.append(text)
            size += len(text)
            if size >= GROUP_BYTES or place == len(texts) - 1:
                parts.append(model.scores(group))
                group, size = [], 0
        scores = np.concatenate(parts)
        arrays = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(docs["doc_id"], folds, fold).alias("held_out"), text_bytes(docs).alias("text"))
    return rows.mapInArrow(by_batch(work), "doc_id bigint, held_out boolean, score double, predicted int")
