"""Finding benchmark items in training documents: n-gram seeds, then local alignment.

Every word n-gram of an item is a seed for it, however many documents hold it, so what is found
in a document does not depend on the other documents. One scan looks the seeds up, takes the
stretch of the document around the hits of each item, leaves out those with too few of the item's
words for any alignment to reach the threshold, and scores the others by Smith-Waterman alignment
over words, which tolerates replaced, lost and added words. The score is a share of what the whole
item would score.

Items travel to the executors in blocks of a bounded number of n-grams; more items mean more
scans, not larger blocks. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import bounded, table
from .words import lowered, ngrams, words

SEED_WORDS = 3
THRESHOLD = 0.5
BLOCK_SEEDS = 1 << 20
MATCH, MISMATCH, GAP = 2, -1, 1
FOUND = "doc_id long, item_id long, score double, first_word long, last_word long"
ALIGNED_AT_ONCE, ALIGNED_CELLS = 256, 1 << 21


class Items(NamedTuple):
    """Items of one block. Seeds are sorted n-gram hashes, each with the items that have it."""

    ids: list[int | None]
    words: list[np.ndarray]
    seeds: np.ndarray
    begins: np.ndarray
    owners: np.ndarray


def _items(rows: list[tuple[int | None, str | None]]) -> Items:
    ids = [i for i, _ in rows]
    texts = [words(lowered(t)).hashes for _, t in rows]
    grams = [np.unique(ngrams(x, SEED_WORDS)) for x in texts]
    owners = np.repeat(np.arange(len(rows)), [len(x) for x in grams])
    flat = np.concatenate([*grams, np.empty(0, dtype=np.uint64)])
    order = np.lexsort((owners, flat))
    seeds, begins = np.unique(flat[order], return_index=True)
    return Items(ids, texts, seeds, np.append(begins, len(flat)), owners[order])


def _lookup(seeds: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams that are seeds, and the numbers of those seeds."""
    if not len(seeds) or not len(grams):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at = np.searchsorted(seeds, grams)
    at[at == len(seeds)] = 0
    places = np.flatnonzero(seeds[at] == grams)
    return places, at[places]


def align(items: list[np.ndarray], stretches: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment scores of pairs of word sequences, and where they end (exclusive)."""
    if not items:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    rows, columns = max(map(len, items)), max(map(len, stretches))
    left = np.zeros((len(items), rows), dtype=np.uint64)
    right = np.ones((len(items), columns), dtype=np.uint64)
    for k, (x, y) in enumerate(zip(items, stretches, strict=True)):
        left[k, : len(x)] = x | np.uint64(2)  # neither filling value
        right[k, : len(y)] = y | np.uint64(2)
    slope = np.arange(columns, dtype=np.int32) * GAP
    held = np.zeros((len(items), columns), dtype=np.int32)
    best = np.zeros(len(items), dtype=np.int64)
    ends = np.zeros(len(items), dtype=np.int64)
    each = np.arange(len(items))
    for r in range(rows):
        gained = np.where(right == left[:, r : r + 1], MATCH, MISMATCH).astype(np.int32)
        gained[:, 1:] += held[:, :-1]
        reached = np.maximum(np.maximum(gained, held - GAP), 0)
        held = np.maximum.accumulate(reached + slope, axis=1) - slope
        at = held.argmax(axis=1)
        better = held[each, at] > best
        best[better] = held[each, at][better]
        ends[better] = at[better] + 1
    return best, ends


def _stretches(items: Items, sequence: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, begin, end) of the parts of a document that could hold an item."""
    places, found = _lookup(items.seeds, ngrams(sequence, SEED_WORDS))
    if not len(places):
        return
    sizes = items.begins[found + 1] - items.begins[found]
    first = np.repeat(items.begins[found] - (np.cumsum(sizes) - sizes), sizes)
    owners = items.owners[first + np.arange(int(sizes.sum()))]
    places = np.repeat(places, sizes)
    order = np.lexsort((places, owners))
    owners, places = owners[order], places[order]
    lengths = np.array([len(items.words[i]) for i in owners])
    new = np.append(True, (owners[1:] != owners[:-1]) | (places[1:] - places[:-1] > lengths[1:]))
    begins = np.flatnonzero(new)
    for a, b in zip(begins, np.append(begins[1:], len(places)), strict=True):
        item, length = int(owners[a]), int(lengths[a])
        begin = max(0, int(places[a]) - length)
        end = min(len(sequence), int(places[b - 1]) + SEED_WORDS + length)
        # No alignment scores more than a match for each item word that occurs here at all.
        if np.isin(items.words[item], sequence[begin:end]).sum() >= THRESHOLD * length:
            yield item, begin, end


def _matches(items: Items, texts: list[str | None]) -> list[tuple[int, int, float, int, int]]:
    """(number of the text, number of the item, score, first word, last word), best ones only."""
    sequences = [words(lowered(x)).hashes for x in texts]
    todo = [(k, *x) for k, s in enumerate(sequences) for x in _stretches(items, s)]
    todo.sort(key=lambda x: (x[3] - x[2], len(items.words[x[1]])))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    at = 0
    while at < len(todo):
        stop = at + 1
        # Sorted by length, so the next stretch sets the width of all.
        while stop < min(len(todo), at + ALIGNED_AT_ONCE) and (
            (stop + 1 - at) * (todo[stop][3] - todo[stop][2]) <= ALIGNED_CELLS
        ):
            stop += 1
        part, at = todo[at:stop], stop
        own = [items.words[i] for _, i, _, _ in part]
        where = [sequences[k][b:e] for k, _, b, e in part]
        scores, ends = align(own, where)
        high = [j for j in range(len(part)) if scores[j] >= THRESHOLD * MATCH * len(own[j])]
        _, backs = align(
            [own[j][::-1] for j in high], [where[j][: ends[j]][::-1] for j in high]
        )
        for j, back in zip(high, backs, strict=True):
            k, i, begin, _ = part[j]
            end = begin + int(ends[j])
            score = float(scores[j]) / (MATCH * len(own[j]))
            held = best.get((k, i), (0.0, 0, 0))
            best[k, i] = max(held, (score, end - int(back), end - 1), key=lambda x: x[0])
    return [(k, i, *x) for (k, i), x in sorted(best.items())]


def _found(batches: Iterator[pa.RecordBatch], items) -> Iterator[pa.RecordBatch]:
    known = Items(*items.value)
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        rows = _matches(known, texts)
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array([r[0] for r in rows], pa.int64())),
                pa.array([known.ids[r[1]] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.float64()),
                pa.array([r[3] for r in rows], pa.int64()),
                pa.array([r[4] for r in rows], pa.int64()),
            ],
            ["doc_id", "item_id", "score", "first_word", "last_word"],
        )


def _clean(batches: Iterator[pa.RecordBatch], items, column: int) -> Iterator[pa.RecordBatch]:
    known = Items(*items.value)
    for batch in batches:
        keep = np.ones(batch.num_rows, dtype=bool)
        keep[[r[0] for r in _matches(known, batch.column(column).to_pylist())]] = False
        yield batch.filter(pa.array(keep))


def item_blocks(benchmark: DataFrame) -> list:
    """Broadcast blocks of items with all their n-grams as seeds."""
    spark = benchmark.sparkSession
    listed = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    size = listed.agg(F.sum(F.length("text"))).first()[0] or 0
    # An n-gram takes two characters at least, so this many blocks keep to the bound.
    n_blocks = max(1, -(-size // (2 * BLOCK_SEEDS)))
    out = []
    for block in range(n_blocks):
        part = listed.filter(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block
        ).distinct()
        rows = sorted(map(tuple, part.collect()), key=str)
        out.append(spark.sparkContext.broadcast(tuple(_items(rows))))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, score, first_word, last_word) for each document and item it holds.

    The score is that of the item's best alignment with any part of the document, from the
    threshold to 1; first_word and last_word count the document's words from 0. Null or empty
    texts hold nothing, and items with fewer than three words take no part. Equal items are
    found together, repeated rows of the benchmark count once, and repeated documents give a
    row each. A null doc_id or item_id stays null. Other columns are not read.
    """
    texts = bounded(docs).select("doc_id", "text")
    parts = [
        texts.mapInArrow(lambda it, b=block: _found(it, b), FOUND)
        for block in item_blocks(benchmark)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns. See ``contaminated``."""
    column = bounded(docs).columns.index("text")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
    for block in item_blocks(benchmark):
        docs = docs.mapInArrow(lambda it, b=block: _clean(it, b, column), schema)
    return docs


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document of ``documents`` and item of ``benchmark`` that it holds."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
