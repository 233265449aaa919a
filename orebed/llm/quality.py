"""A quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters run over overlapping chunks that cover the
whole document; each filter keeps its largest answer per chunk; a small dense
layer reads a chunk, and its mean and maximum over the chunks give one
probability. Trained with Adam on a bounded sample of labelled texts.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import by_batch, held_out, labelled_sample, text_bytes

CHUNK, OVERLAP = 512, 64
EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 8, 8, 2, 32, 16
# Chunks worked on at a time.
AT_ONCE = 256
# The training sample: texts of each label, and the longest text taken.
PER_CLASS, MAX_CHARS = 2000, 6000
STEPS, BATCH, RATE, DECAY = 500, 32, 0.004, 1e-4

Weights = dict[str, np.ndarray]


def chunks_of(text: bytes) -> np.ndarray:
    """Equal chunks that cover the whole text, neighbours overlapping by 64 bytes or more; short texts are padded with zeros."""
    data = np.frombuffer(text, np.uint8)
    if len(data) <= CHUNK:
        return np.pad(data, (0, CHUNK - len(data)))[None, :]
    count = -(-(len(data) - OVERLAP) // (CHUNK - OVERLAP))
    starts = np.linspace(0, len(data) - CHUNK, count).round().astype(np.int64)
    return sliding_window_view(data, CHUNK)[starts]


def initial(rng: np.random.Generator) -> Weights:
    fan = EMBED * WIDTH
    return {
        "embed": rng.normal(0, 1, (256, EMBED)).astype(np.float32),
        "filters": rng.normal(0, fan**-0.5, (fan, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "dense": rng.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(np.float32),
        "shift": np.zeros(HIDDEN, np.float32),
        "out": rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32),
        "base": np.zeros(1, np.float32),
    }


def _windows(chunks: np.ndarray, weights: Weights) -> np.ndarray:
    """The embedded bytes below each place of the filters: (chunk, place, width * embed)."""
    embedded = weights["embed"][chunks].reshape(len(chunks), CHUNK * EMBED)
    return sliding_window_view(embedded, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]


def _pooled(chunks: np.ndarray, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's largest answer per chunk and the place of it."""
    answers = _windows(chunks, weights) @ weights["filters"]
    places = answers.argmax(axis=1)
    return np.take_along_axis(answers, places[:, None, :], 1)[:, 0] + weights["bias"], places


def _combined(pooled: np.ndarray, starts: np.ndarray, weights: Weights):
    """Hidden values of all chunks, their mean and maximum per document, and the logits."""
    hidden = np.maximum(np.maximum(pooled, 0) @ weights["dense"] + weights["shift"], 0)
    counts = np.diff(np.r_[starts, len(pooled)])[:, None]
    both = np.hstack([np.add.reduceat(hidden, starts) / counts, np.maximum.reduceat(hidden, starts)])
    return hidden, counts, both, both @ weights["out"] + weights["base"][0]


def score(texts: list[bytes], weights: Weights) -> np.ndarray:
    """The probability of label 1 for each whole text."""
    result, group, size = [], [], 0

    def flush() -> None:
        nonlocal group, size
        if group:
            starts = np.cumsum([0, *(len(part) for part in group)])[:-1]
            stacked = np.concatenate(group)
            pooled = [_pooled(stacked[at : at + AT_ONCE], weights)[0] for at in range(0, len(stacked), AT_ONCE)]
            logits = _combined(np.concatenate(pooled), starts, weights)[3]
            result.append(1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -50, 50))))
        group, size = [], 0

    for text in texts:
        group.append(chunks_of(text))
        size += len(group[-1])
        if size >= 4 * AT_ONCE:
            flush()
    flush()
    return np.concatenate(result) if result else np.empty(0)


def _gradients(chunks: np.ndarray, starts: np.ndarray, labels: np.ndarray, weights: Weights) -> Weights:
    pooled, places = _pooled(chunks, weights)
    hidden, counts, both, logits = _combined(pooled, starts, weights)
    error = ((1 / (1 + np.exp(-np.clip(logits, -50, 50))) - labels) / len(labels)).astype(np.float32)
    grads = {"out": both.T @ error, "base": np.array([error.sum()], np.float32)}
    owner = np.repeat(np.arange(len(labels)), counts[:, 0])
    back = error[:, None] * weights["out"][None, :]
    to_hidden = back[owner, :HIDDEN] / counts[owner]
    top = hidden == both[owner, HIDDEN:]
    to_hidden = to_hidden + np.where(top, back[owner, HIDDEN:], 0)
    to_hidden *= hidden > 0
    active = np.maximum(pooled, 0)
    grads["dense"], grads["shift"] = active.T @ to_hidden, to_hidden.sum(axis=0)
    to_pooled = (to_hidden @ weights["dense"].T) * (pooled > 0)
    grads["bias"] = to_pooled.sum(axis=0)
    # Only the place with the largest answer takes part.
    spots = places[:, :, None] * STRIDE + np.arange(WIDTH)
    under = np.take_along_axis(chunks[:, None, :], spots.reshape(len(chunks), 1, -1), 2).reshape(spots.shape)
    seen = weights["embed"][under].reshape(*places.shape, WIDTH * EMBED)
    grads["filters"] = np.einsum("nf,nfk->kf", to_pooled, seen)
    to_seen = to_pooled[:, :, None] * weights["filters"].T[None]
    grads["embed"] = np.zeros_like(weights["embed"])
    np.add.at(grads["embed"], under.ravel(), to_seen.reshape(-1, EMBED))
    return grads


def train(sample: list[tuple[bytes, int]], seed: int = 7, steps: int = STEPS) -> Weights:
    """Weights from labelled texts; a sample of one label only gives a network that always answers with it."""
    rng = np.random.default_rng(seed)
    weights = initial(rng)
    labels = np.array([label for _, label in sample], np.float32)
    if len(set(labels.tolist())) < 2:
        weights["out"][:] = 0
        weights["base"][:] = 0 if not len(labels) else (4 if labels[0] else -4)
        return weights
    parts = [chunks_of(text) for text, _ in sample]
    moments = {name: (np.zeros_like(value), np.zeros_like(value)) for name, value in weights.items()}
    groups = [np.flatnonzero(labels == value) for value in (0, 1)]
    for step in range(1, steps + 1):
        picks = np.concatenate([rng.choice(group, BATCH // 2) for group in groups])
        lengths = [len(parts[pick]) for pick in picks]
        starts = np.cumsum([0, *lengths])[:-1]
        grads = _gradients(np.concatenate([parts[pick] for pick in picks]), starts, labels[picks], weights)
        rate = RATE * (0.5 + 0.5 * np.cos(np.pi * step / steps))
        for name, grad in grads.items():
            grad = grad + DECAY * weights[name]
            first, second = moments[name]
            first += 0.1 * (grad - first)
            second += 0.001 * (grad * grad - second)
            weights[name] -= (rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return weights


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column) -> Weights:
    """Train on at most 2,000 texts of each quality label, or pieces of 6,000 characters of longer ones, picked by hash.

    Training sees both labels equally often; the odds are then set to those of all training labels.
    """
    sample = labelled_sample(docs, labels, "quality", train_rows, PER_CLASS, MAX_CHARS)
    weights = train(sample)
    if len({label for _, label in sample}) < 2:
        return weights  # nothing was learnt whose odds could be set
    bad, good = labels.filter(train_rows).agg(F.count_if(F.col("quality") == 0), F.count_if(F.col("quality") == 1)).first()
    if bad and good:
        weights["base"] = weights["base"] + np.float32(np.log(good / bad))
    return weights


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Labels of rows whose ``crc32(doc_id as text) mod folds`` is ``fold`` are not learnt from.
    ``score`` is the probability of good quality for the whole text, whatever its length; nothing
    but the text goes into it. A null or empty text is one chunk of padding. Null ids are
    not held out. Without labels every score is 0.5. Repeated rows give repeated rows; other
    columns are ignored. Repeated labels count once, contradicting ones as the larger.
    """
    weights = fit(docs, labels, ~held_out(F.col("doc_id"), folds, fold))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = score(batch.column("text").to_pylist(), weights)
        arrays = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(docs["doc_id"], folds, fold).alias("held_out"), text_bytes(docs).alias("text"))
    return rows.mapInArrow(by_batch(work), "doc_id bigint, held_out boolean, score double, predicted int")


def good_documents(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """The documents that :func:`score_documents` predicts to be good, with all columns."""
    weights = fit(docs, labels, ~held_out(F.col("doc_id"), folds, fold))

    def work(batch: pa.RecordBatch, weights: Weights) -> pa.RecordBatch:
        texts = [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]
        return batch.filter(pa.array(score(texts, weights) >= 0.5))

    return docs.mapInArrow(by_batch(functools.partial(work, weights=weights)), docs.schema)
