"""Language identification by string kernels and kernel ridge regression.

The kernel of two texts is the number of character n-grams, of all lengths from 1 to 3, that are
present in both, divided by the geometric mean of the numbers present in each. N-grams of the
lower-cased text, with everything but letters as a blank, are told apart by a 16-bit hash. A few
landmark texts stand for the whole kernel matrix (Nystroem), and one ridge regression on the
kernel values against them is solved for each language against the rest.

The kernel is a scalar product of presence vectors, so the landmarks are multiplied out with
their coefficients once; a batch of texts is then scored by one matrix product.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import bounded, table

LENGTHS = (1, 2, 3)
SAMPLE = 3000
LANDMARKS = 200
RIDGE = 1e-3
SLOTS = 1 << 16
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
AT_ONCE = 128
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"
_FACTOR = np.uint32(0x9E3779B1)


@cache
def letters() -> np.ndarray:
    """Which code points are letters; a table of 1.1 MB, made once for each Python process."""
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


def present(text: str | None, is_letter: np.ndarray) -> np.ndarray | None:
    """Presence of each n-gram slot in a text; none if it has no letter."""
    raw = (text or "").lower().encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, dtype="<u4")
    letter = is_letter[points]
    if not letter.any():
        return None
    points = points * letter + np.uint32(1)
    slots = np.zeros(SLOTS, dtype=bool)
    grams = np.zeros(len(points), dtype=np.uint32)
    for n in LENGTHS:
        if len(points) < n:
            break
        grams = (grams[: len(points) - n + 1] + points[n - 1 :]) * _FACTOR
        grams ^= grams >> np.uint32(15)
        slots[(grams * _FACTOR) >> np.uint32(16)] = True
    return slots


class Model(NamedTuple):
    """Languages, the slots that any landmark has, and their weights for each language."""

    languages: list[str]
    slots: np.ndarray
    weights: np.ndarray


def fit(sets: list[np.ndarray], languages: list[str]) -> Model | None:
    """From sets of slots (sorted arrays) and their languages; none without any."""
    names = sorted(set(languages))
    if not names:
        return None
    # Landmarks are dealt to the languages in turn, as far as each has texts.
    turn: dict[str, int] = {}
    order = []
    for k, lang in enumerate(languages):
        order.append((turn.get(lang, 0), k))
        turn[lang] = turn.get(lang, 0) + 1
    chosen = [k for _, k in sorted(order)[:LANDMARKS]]
    used = np.unique(np.concatenate([sets[k] for k in chosen]))

    def unit(which: list[int]) -> np.ndarray:
        out = np.zeros((len(which), len(used)), dtype=np.float32)
        for row, k in enumerate(which):
            at = np.searchsorted(used, sets[k])
            at[at == len(used)] = 0
            out[row, at[used[at] == sets[k]]] = 1 / np.sqrt(len(sets[k]))
        return out

    marks = unit(chosen)
    own = (marks @ marks.T).astype(np.float64)
    gram, aim = np.zeros_like(own), np.zeros((len(chosen), len(names)))
    for at in range(0, len(sets), 512):
        which = list(range(at, min(len(sets), at + 512)))
        kernel = (unit(which) @ marks.T).astype(np.float64)
        truth = np.array([[1.0 if languages[k] == x else -1.0 for x in names] for k in which])
        gram += kernel.T @ kernel
        aim += kernel.T @ truth
    left = gram + RIDGE * len(sets) * own + 1e-6 * np.eye(len(chosen))
    return Model(names, used, marks.T @ np.linalg.solve(left, aim).astype(np.float32))


def _predict(model: Model | None, texts: list[str | None], is_letter) -> list[tuple[str, float]]:
    out = [(UNKNOWN, 0.0)] * len(texts)
    if model is None:
        return out
    for at in range(0, len(texts), AT_ONCE):
        found = [(k, present(texts[k], is_letter)) for k in range(at, min(len(texts), at + AT_ONCE))]
        found = [(k, x) for k, x in found if x is not None]
        if not found:
            continue
        rows = np.stack([x[model.slots] for _, x in found]).astype(np.float32)
        sizes = np.array([x.sum() for _, x in found], dtype=np.float32)
        margins = (rows @ model.weights) / np.sqrt(sizes)[:, None]
        best = margins.argmax(axis=1)
        for (k, _), j, row in zip(found, best, margins, strict=True):
            out[k] = model.languages[j], float(np.clip((row[j] + 1) / 2, 0, 1))
    return out


def held_out(doc_id: Column) -> Column:
    """Whether a document's language may not be learned from; so for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(True))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    is_letter = letters()
    for batch in batches:
        found = [present(x.as_py(), is_letter) for x in batch.column(1)]
        sets = [None if x is None else np.flatnonzero(x).astype(np.uint16).tobytes() for x in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sets, pa.binary())], ["lang", "slots"]
        )


def fitted(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fits on at most ``sample`` documents, drawn by a hash of doc_id, as sets of slots.

    Only documents with a language and a letter, and that are not held out, are learned from.
    """
    known = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    drawn = known.select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(sample)
    rows = (
        known.join(F.broadcast(drawn.distinct()), "doc_id", "left_semi")  # at most ``sample`` ids
        .select("lang", "text", "doc_id").mapInArrow(_sets, "lang string, slots binary")
        .filter(F.col("slots").isNotNull())
        .orderBy("slots", "lang").limit(sample).collect()
    )
    return fit([np.frombuffer(r.slots, dtype=np.uint16) for r in rows], [r.lang for r in rows])


def _predicted(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    is_letter = letters()
    for batch in batches:
        found = _predict(model, batch.column(2).to_pylist(), is_letter)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()),
             pa.array([x for _, x in found], pa.float64())],
            ["doc_id", "held_out", "lang_pred", "score"],
        )


def languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per row of ``docs``.

    Without a given model one is fitted on the documents themselves. A text that is null or has
    no letter is ``und`` with score 0, and so is every text if there was nothing to learn from.
    Ties go to the language that sorts first. Columns other than doc_id, lang and text are not
    read. An empty table gives no rows.
    """
    model = model or fitted(bounded(docs))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(lambda it: _predicted(it, model), PREDICTED)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of ``documents``: doc_id, held_out, lang_pred, score."""
    return languages(table(spark, sf_dir, "documents"))
