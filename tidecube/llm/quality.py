"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled 1; the web text is unlabelled, a mixture of good and
bad in unknown shares. A first classifier tells positives from unlabelled text; where it is
surest of positives, the ratio of the shares of both that it accepts estimates the class prior.
The quality classifier then minimises the non-negative unbiased risk

    prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)])

with the logistic loss over piecewise features of the text. Labels of bad documents are not used.

It is fitted on the driver on at most ``SAMPLE`` positives and ``SAMPLE`` unlabelled documents,
as feature vectors of a few dozen numbers. Every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import bounded, table, written
from .words import words

SAMPLE = 20_000
FOLDS, HELD_OUT = 4, 2
ACCEPTED = 0.7
BINS = 4
STEPS = 400
RATE = 0.05
DECAY = 1e-3
_SYMBOLS = "#$%&*!|.,;:?()[]{}<>=+/\\_~^@\"'-"
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_OTHER = ~(_LETTER | _DIGIT | _SPACE)
_PROSE = np.isin(_BYTES, [ord(c) for c in ".,;:?'\"-()"])


def features(text: str | None) -> np.ndarray:
    """Measures of one whole text; zeros where there is nothing to measure."""
    data = (text or "").encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, dtype=np.uint8)
    counts = np.bincount(raw, minlength=256)
    size = max(1, len(raw))
    letters = max(1, int(counts[_LETTER].sum()))
    ascii_lowered = data.lower()
    found = words(ascii_lowered)
    n = max(1, len(found.hashes))
    lengths = found.ends - found.starts
    same = (found.hashes[1:] == found.hashes[:-1]).sum() if len(found.hashes) > 1 else 0
    pairs = found.hashes[1:] * np.uint64(3) + found.hashes[:-1]
    after = raw[np.minimum(found.ends, len(raw) - 1)] if len(found.ends) else raw[:0]
    first = raw[found.starts] if len(found.starts) else raw[:0]
    last = raw[found.ends - 1] if len(found.ends) else raw[:0]
    lines = data.split(b"\n")
    odd = counts * (_OTHER & ~_PROSE)
    return np.array(
        [
            np.log1p(len(raw)),
            np.log1p(len(found.hashes)),
            lengths.mean() if len(lengths) else 0.0,
            lengths.std() if len(lengths) else 0.0,
            counts[_LETTER].sum() / size,
            counts[_UPPER].sum() / letters,
            counts[_DIGIT].sum() / size,
            counts[_SPACE].sum() / size,
            counts[_OTHER].sum() / size,
            odd.sum() / size,
            counts[ord("!")] / n,
            counts[ord("|")] / n,
            counts[ord(".")] / n,
            counts[ord(",")] / n,
            counts[10] / n,
            same / n,
            len(np.unique(found.hashes)) / n,
            len(np.unique(pairs)) / n,
            (_OTHER & ~_PROSE)[after].sum() / n,
            (_UPPER[first] & _UPPER[last] & (lengths > 1)).sum() / n,
            _UPPER[first].sum() / n,
            len(set(lines)) / len(lines),
            np.log1p(size / len(lines)),
        ],
        dtype=np.float32,
    )


N_FEATURES = len(features(""))


class Model(NamedTuple):
    """Inner edges of the features' bins, a weight for each bin and the rest of a linear model."""

    edges: np.ndarray
    weights: np.ndarray
    intercept: float
    prior: float


def _binned(edges: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The number of each feature's bin, counted on over all features."""
    out = np.empty(x.shape, dtype=np.int64)
    for j in range(x.shape[1]):
        out[:, j] = np.searchsorted(edges[j], x[:, j]) + j * (edges.shape[1] + 1)
    return out


def _descend(edges: np.ndarray, gradient, steps: int = STEPS) -> np.ndarray:
    """Adam on the bins' weights and an intercept, from zero."""
    w = np.zeros(N_FEATURES * (edges.shape[1] + 1) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = gradient(w) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _margin(w: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return w[:-1][bins].sum(axis=1) + w[-1]


def _spread(bins: np.ndarray, slope: np.ndarray, size: int) -> np.ndarray:
    """The gradient for the weights of a mean loss with these slopes."""
    each = np.bincount(bins.ravel(), np.repeat(slope, bins.shape[1]), minlength=size - 1)
    return np.append(each, slope.sum()) / max(1, len(slope))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, edges: np.ndarray) -> float:
    """The share of positives in unlabelled data, by the best bin of a first classifier's scores.

    The classifier is fitted on one half of both samples. On the other half, the shares of both
    that score at least some value have a ratio that is at least the prior, and near it where few
    negatives score so high. The value is the one with the least upper bound of that ratio. The
    halves then change places, and as both estimates err upwards the smaller one is taken.
    """
    p, u = _binned(edges, positive), _binned(edges, unlabelled)
    if len(p) < 2 or len(u) < 2:
        return 0.5
    halves = [(p[::2], u[::2], p[1::2], u[1::2]), (p[1::2], u[1::2], p[::2], u[::2])]
    return float(np.clip(min(_best_bin(edges, *x) for x in halves), 0.01, 0.99))


def _best_bin(edges: np.ndarray, p, u, other_p, other_u) -> float:
    def gradient(w: np.ndarray) -> np.ndarray:
        up, uu = _sigmoid(_margin(w, p)), _sigmoid(_margin(w, u))
        return 0.5 * (_spread(p, up - 1, len(w)) + _spread(u, uu, len(w)))

    w = _descend(edges, gradient)
    held_p, held_u = np.sort(_margin(w, other_p)), np.sort(_margin(w, other_u))
    above_p = 1 - np.searchsorted(held_p, held_p) / len(held_p)
    above_u = 1 - np.searchsorted(held_u, held_p) / len(held_u)
    slack = np.sqrt(np.log(40) / (2 * len(held_p))) + np.sqrt(np.log(40) / (2 * len(held_u)))
    best = int(np.argmin((above_u + slack) / above_p))
    return above_u[best] / above_p[best]


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model | None:
    """The classifier, or none without positives or without unlabelled documents."""
    if not len(positive) or not len(unlabelled):
        return None
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    # Half of the edges follow the bulk and half the range, so that rare values have bins too.
    bulk = np.quantile(unlabelled, cuts, axis=0).T
    low, high = unlabelled.min(axis=0)[:, None], unlabelled.max(axis=0)[:, None]
    edges = np.sort(np.concatenate([bulk, low + (high - low) * cuts], axis=1), axis=1)
    prior = class_prior(positive, unlabelled, edges)
    p, u = _binned(edges, positive), _binned(edges, unlabelled)

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = _margin(w, p), _margin(w, u)
        minus = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        rest = _spread(u, _sigmoid(zu), len(w)) - prior * _spread(p, _sigmoid(zp), len(w))
        if minus < 0:  # overfitted to the unlabelled text: only this part is walked back
            return -rest
        return prior * _spread(p, _sigmoid(zp) - 1, len(w)) + rest

    w = _descend(edges, gradient)
    return Model(edges, w[:-1], float(w[-1]), prior)


def score(model: Model | None, x: np.ndarray) -> np.ndarray:
    """Probability of quality; 1 without a model, as nothing speaks against any document."""
    if model is None:
        return np.ones(len(x))
    return _sigmoid(model.weights[_binned(model.edges, x)].sum(axis=1) + model.intercept)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from; so for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(True))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(x.as_py()) for x in batch.column(2)]
        flat = np.concatenate([*rows, np.empty(0, dtype=np.float32)])
        lists = pa.FixedSizeListArray.from_arrays(pa.array(flat), N_FEATURES)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), lists.cast(pa.list_(pa.float32()))],
            ["doc_id", "held_out", "features"],
        )


def featured(docs: DataFrame) -> DataFrame:
    rows = bounded(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kinds = "doc_id long, held_out boolean, features array<float>"
    return written(rows.mapInArrow(_featured, kinds), "features")


def fitted(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fits the classifier on bounded samples, drawn by a hash of doc_id.

    Learns from labels of documents that are not held out, and from the features of those. A
    document with several labels is trusted if all are 1; null labels count as none.
    """
    trusted = (
        labels.filter(~held_out(F.col("doc_id"))).groupBy("doc_id")
        .agg(F.min("quality").alias("_quality")).filter("_quality = 1").select("doc_id")
    )
    learned = measured.filter(~F.col("held_out"))
    draw = F.xxhash64("doc_id", F.lit(3))

    def drawn(rows: DataFrame) -> np.ndarray:
        # Every task offers ``sample`` rows at most, and far fewer where there are many tasks.
        share = min(1.0, 1.5 * sample / max(1, rows.count()))
        near = rows.filter(F.pmod(draw, F.lit(1 << 20)) <= int(share * (1 << 20)))
        picked = near.orderBy(F.pmod(draw, F.lit(1 << 20)), draw, "doc_id").limit(sample)
        picked = picked.select("features").toPandas()["features"]
        return np.array(picked.tolist(), dtype=np.float32).reshape(-1, N_FEATURES)

    return fit(drawn(learned.join(trusted, "doc_id", "left_semi")), drawn(learned))


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
        found = score(model, flat.reshape(-1, N_FEATURES))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found),
             pa.array((found >= ACCEPTED).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per row of ``docs``.

    Null and empty texts are measured as empty and scored like others. Without trusted labels
    every score is 1. Rows that repeat are scored alike. Columns other than doc_id and text are
    not read. An empty table gives no rows.
    """
    measured = featured(docs)
    model = fitted(measured, labels)
    kinds = "doc_id long, held_out boolean, score double, predicted int"
    return measured.mapInArrow(lambda it: _scored(it, model), kinds)


def _accepted(batches: Iterator[pa.RecordBatch], model, column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(x.as_py()) for x in batch.column(column)]
        measured = np.array(rows, dtype=np.float32).reshape(-1, N_FEATURES)
        yield batch.filter(pa.array(score(model, measured) >= ACCEPTED))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with all their columns. See ``scored``."""
    model = fitted(featured(docs), labels)
    column = docs.columns.index("text")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
    return docs.mapInArrow(lambda it: _accepted(it, model, column), schema)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of ``documents``: doc_id, held_out, score, predicted."""
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
