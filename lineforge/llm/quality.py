"""Quality classifier: hashed word n-grams, logistic regression, follow the regularised leader.

A text is cut into words (runs of letters and digits) and marks (runs of other visible
characters). Its features are single tokens, pairs of neighbours, and single, paired and triple
token *shapes* (lower, Title, UPPER, digits, marks, with a note on repetition), each hashed to one
of ``buckets`` weights; a feature's value is its share of the text's tokens. Scoring is a sparse
dot product: the weights of all n-grams are looked up and summed.

Training takes a sample of the labelled rows of bounded size (``sample_rows``, the rows with the
smallest hashes of their texts). It is dealt to ``shards`` tasks; each runs FTRL-proximal over
its rows and the weights are averaged. The model has ``buckets`` weights whatever the corpus holds,
so broadcasting it is bounded by a parameter.

Defined results: null text counts as empty; a text without tokens has the score of the bias
alone; rows with a null label or text are not trained on; without any label, or with only one
class among them, every score is 0.5; input columns beyond the named ones pass through, but for one
that has the score's name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineforge.llm.text import PIECE, SpanHasher, mix, row_slices, runs, utf8


@dataclass(frozen=True)
class QualitySettings:
    buckets: int = 1 << 18
    sample_rows: int = 6000
    shards: int = 4
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.0005
    l2: float = 0.0005
    threshold: float = 0.7
    # Features are shares; the scale brings a usual text's weights to a range that learns fast.
    scale: float = 24.0


# Byte classes: 0 space, 1 mark, 2 digit, 3 small letter (with all bytes beyond ASCII), 4 capital.
_CLASS = np.ones(256, np.uint8)
_CLASS[:33] = 0
_CLASS[127] = 0
_CLASS[48:58] = 2
_CLASS[97:123] = 3
_CLASS[128:] = 3
_CLASS[65:91] = 4
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Seeds that keep the kinds of features apart.
_SEEDS = [np.uint64(0xA0761D6478BD642F + 0x1000193 * k) for k in range(5)]
_hasher = SpanHasher()


def _features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram: rows (index of the text) and buckets; a piece holds whole texts."""
    kind = _CLASS[data]
    word_starts, word_ends = runs(kind >= 2, offsets)
    mark_starts, mark_ends = runs(kind == 1, offsets)
    starts = np.concatenate([word_starts, mark_starts])
    order = np.argsort(starts, kind="stable")
    starts = starts[order]
    ends = np.concatenate([word_ends, mark_ends])[order]
    if not len(starts):
        return
    row = np.searchsorted(offsets, starts, "right") - 1
    words = _hasher(_LOWER[data], starts, ends)
    capitals = np.concatenate([[0], np.cumsum(kind == 4)])
    small = np.concatenate([[0], np.cumsum(kind == 3)])
    n_capital, n_small = capitals[ends] - capitals[starts], small[ends] - small[starts]
    first = kind[starts]
    shape = np.select(
        [first == 1, (n_capital == 0) & (n_small == 0), n_capital == 0, n_small == 0, (first == 4) & (n_capital == 1)],
        [0, 1, 2, 3, 4],
        5,
    ).astype(np.uint64)
    shape = np.where(first == 1, words | np.uint64(8), shape)
    shape[1:] += np.where((words[1:] == words[:-1]) & (row[1:] == row[:-1]), np.uint64(1 << 40), np.uint64(0))

    def of(*parts: np.ndarray, seed: int) -> np.ndarray:
        h = np.full(len(parts[0]), _SEEDS[seed], np.uint64)
        for part in parts:
            h = mix(h ^ part)
        return (h & np.uint64(buckets - 1)).astype(np.int64)

    pair = row[1:] == row[:-1]
    triple = pair[1:] & pair[:-1]
    yield row, of(words, seed=0)
    yield row[1:][pair], of(words[:-1][pair], words[1:][pair], seed=1)
    yield row, of(shape, seed=2)
    yield row[1:][pair], of(shape[:-1][pair], shape[1:][pair], seed=3)
    yield row[2:][triple], of(shape[:-2][triple], shape[1:-1][triple], shape[2:][triple], seed=4)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Bounded runs of texts; a very long text comes in several pieces, cut after white space."""
    for first, last in row_slices(offsets, PIECE):
        low, high = offsets[first], offsets[last]
        if high - low <= 2 * PIECE:
            yield first, last, data[low:high], offsets[first : last + 1] - low
            continue
        while low < high:
            end = min(low + PIECE, high)
            while end < high and _CLASS[data[end - 1]]:
                end += 1
            yield first, last, data[low:end], np.array([0, end - low])
            low = end


def sparse_rows(texts: pa.Array, settings: QualitySettings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its buckets, ascending, and their values."""
    data, offsets = utf8(texts)
    counts: list[dict] = [{} for _ in range(len(texts))]
    totals = np.zeros(len(texts))
    for first, last, piece, places in _pieces(data, offsets):
        found = list(_features(piece, places, settings.buckets))
        if not found:
            continue
        totals[first:last] += np.bincount(found[0][0], minlength=last - first)
        keys, n = np.unique(
            np.concatenate([r * settings.buckets + b for r, b in found]), return_counts=True
        )
        bounds = np.searchsorted(keys, np.arange(last - first + 1) * settings.buckets)
        for r in range(last - first):
            mine = slice(bounds[r], bounds[r + 1])
            for b, c in zip((keys[mine] % settings.buckets).tolist(), n[mine].tolist(), strict=True):
                counts[first + r][b] = counts[first + r].get(b, 0) + c
    out = []
    for found, total in zip(counts, totals, strict=True):
        index = np.array(sorted(found), np.int64)
        out.append((index, np.array([found[b] for b in index.tolist()]) * (settings.scale / max(total, 1))))
    return out


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: QualitySettings) -> np.ndarray:
    """Weights (the last is the bias) by FTRL-proximal, row after row."""
    s, n_weights = settings, settings.buckets + 1
    z, n = np.zeros(n_weights), np.zeros(n_weights)

    def weights(index: np.ndarray) -> np.ndarray:
        zi = z[index]
        w = (np.sign(zi) * s.l1 - zi) / ((s.beta + np.sqrt(n[index])) / s.alpha + s.l2)
        return np.where(np.abs(zi) <= s.l1, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            index, value = np.append(index, s.buckets), np.append(value, 1.0)
            w = weights(index)
            gradient = (sigmoid(w @ value) - labels[i]) * value
            sigma = (np.sqrt(n[index] + gradient**2) - np.sqrt(n[index])) / s.alpha
            z[index] += gradient - sigma * w
            n[index] += gradient**2
    return weights(np.arange(n_weights))


def fit_quality(labelled: DataFrame, settings: QualitySettings = QualitySettings()) -> np.ndarray:
    """Train on ``labelled`` (text, label 0/1). Runs jobs; returns ``buckets + 1`` weights."""
    s = settings
    sample = (
        labelled.where(F.col("text").isNotNull() & F.col("label").isNotNull())
        .select("text", F.col("label").cast("double").alias("label"), F.xxhash64("text").alias("order"))
        .orderBy("order", "label")
        .limit(s.sample_rows)
    )

    def train(_key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "label"])
        labels = rows["label"].to_numpy()
        share = min(max(labels.mean(), 0.5 / len(labels)), 1 - 0.5 / len(labels))
        if labels.min() == labels.max():
            w = np.zeros(s.buckets + 1)
        else:
            w = train_ftrl(sparse_rows(pa.array(rows["text"]), s), labels, s)
        used = np.flatnonzero(w)
        return pd.DataFrame({"place": used, "weight": w[used], "share": share})

    shard = F.pmod(F.xxhash64("order"), F.lit(s.shards))
    model = (
        sample.groupBy(shard.alias("shard"))
        .applyInPandas(train, "place long, weight double, share double")
        .groupBy("place")
        .agg(F.sum("weight").alias("weight"))
    )
    # At most buckets + 1 rows, whatever the input.
    rows = model.toPandas()
    weights = np.zeros(s.buckets + 1)
    weights[rows["place"].to_numpy(np.int64)] = rows["weight"].to_numpy(float) / s.shards
    return weights


def score_quality(
    docs: DataFrame, weights: np.ndarray, settings: QualitySettings = QualitySettings(), name: str = "score"
) -> DataFrame:
    """``docs`` with a column ``name``, the score of the whole of ``text``; it replaces one of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            sums, tokens = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for first, last, piece, places in _pieces(data, offsets):
                for kind, (row, bucket) in enumerate(_features(piece, places, settings.buckets)):
                    sums[first:last] += np.bincount(row, w[bucket], last - first)
                    if not kind:
                        tokens[first:last] += np.bincount(row, minlength=last - first)
            scores = sigmoid(w[-1] + settings.scale * sums / np.maximum(tokens, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=schema.names)

    return docs.mapInArrow(score, schema)


def held_out() -> F.Column:
    """Rows that no label is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()) -> DataFrame:
    """Labelled texts outside the held-out quarter, a bounded number by hash of the id.

    The ids are bounded before texts are fetched, so the join's side of ids is at most
    ``sample_rows`` rows and can be broadcast.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(settings.sample_rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


def keep_good(docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()) -> DataFrame:
    """``docs`` without the documents whose score is below the threshold. Runs jobs to train."""
    name = "score"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    weights = fit_quality(training_rows(docs, labels, settings), settings)
    return score_quality(docs, weights, settings, name).where(F.col(name) >= settings.threshold).drop(name)
