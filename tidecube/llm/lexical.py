"""Ranked lexical search in reverse: a small set of queries, a corpus streamed past them.

The items' terms make an inverted index (term to items), which is sent to the workers in blocks
of bounded size. The corpus is read once for each block: a document is cut into terms, those
that the index holds are counted, and the counts are kept. From them come the corpus statistics.
Then every task streams its counts through the postings and updates one bounded heap for each
item; the heaps of all tasks are merged, first within salted groups and then for each item.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import bounded, table, written
from .words import Words, words

TOP = 20
# Most items and postings of a block of the index (some 40 MB), if no single item has more.
BLOCK_ITEMS = 20_000
BLOCK_POSTINGS = 1_000_000
# Cells of the table of documents by items that a task holds at once, and pairs added up at once.
CELLS = 2_000_000
PAIRS = 1_000_000
SALTS = 64
GATHERED = 1 << 20
# The weighting.
SCALE, SATURATION, LENGTH, LEAST = 1_000_000_000, 1000, 12, 75

HITS = "doc_id long, n long, terms array<int>, times array<int>"
BEST = "item_id long, doc_id long, score long"


def folded(text: str | None) -> bytes:
    """UTF-8 bytes with A to Z, and no other letters, in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


class Index(NamedTuple):
    """Postings of one block: items of term t are ``items[first[t] : first[t + 1]]``."""

    hashes: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    items: np.ndarray
    times: np.ndarray
    ids: list[int | None]


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, hashes, lengths = [], [], []
        for item, text in zip(batch.column(0), batch.column(1), strict=True):
            found: Words = words(folded(text.as_py()))
            ids += [item.as_py()] * len(found.hashes)
            hashes.append(found.hashes.view(np.int64))
            lengths.append(found.ends - found.starts)
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.concatenate(hashes)),
                 pa.array(np.concatenate(lengths).astype(np.int64))],
                ["item_id", "hash", "length"],
            )


def postings(items: DataFrame) -> DataFrame:
    """Rows (item_id, hash, length, times) of the items' terms.

    A term is told by a 64-bit hash and its length in bytes.
    """
    distinct = items.select(F.col("item_id").cast("long"), "text").distinct()
    terms = bounded(distinct).mapInArrow(_item_terms, "item_id long, hash long, length long")
    return terms.groupBy("item_id", "hash", "length").agg(F.count(F.lit(1)).alias("times"))


def blocks(rows: DataFrame) -> Iterator[Index]:
    """The index in blocks of items, from ``postings``."""
    size = rows.agg(F.count(F.lit(1)), F.count_distinct(F.coalesce("item_id", F.lit(-1)))).first()
    count = max(-(-size[0] // BLOCK_POSTINGS), -(-size[1] // BLOCK_ITEMS))
    for block in range(count):
        part = rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(count)) == block)
        found = part.collect()  # no more than a block
        if not found:
            continue
        ids = list(dict.fromkeys(r.item_id for r in found))
        number = {item: k for k, item in enumerate(ids)}
        columns = np.array([(r.hash, r.length, number[r.item_id], r.times) for r in found], dtype=np.int64)
        hashes = columns[:, 0].copy().view(np.uint64)
        order = np.lexsort((columns[:, 2], columns[:, 1], hashes))
        hashes, columns = hashes[order], columns[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = hashes[1:] != hashes[:-1]
        first = np.flatnonzero(new)
        # Terms that share a hash but not a length would need a look-up of their own.
        if (columns[1:, 1] != columns[:-1, 1])[~new[1:]].any():
            raise ValueError("two terms of the index have the same 64-bit hash")
        yield Index(
            hashes[first], columns[first, 1], np.append(first, len(order)), columns[:, 2].copy(),
            columns[:, 3].copy(), ids,
        )


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts of about a megabyte together, with the number of the first."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        held.append(folded(text.as_py()))
        size += len(held[-1])
        if size >= GATHERED:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held


def counter(index: Index):
    """A function for ``mapInArrow``: rows (doc_id, text) to the counts of the index's terms."""
    hashes, lengths = index.hashes, index.lengths

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in _groups(batch.column(1)):
                found = words(b"\n".join(held))
                sizes = np.array([len(x) + 1 for x in held], dtype=np.int64)
                starts = np.cumsum(sizes) - sizes
                doc = np.searchsorted(starts, found.starts, "right") - 1
                n = np.bincount(doc, minlength=len(held))
                at = np.minimum(np.searchsorted(hashes, found.hashes), len(hashes) - 1)
                hit = (hashes[at] == found.hashes) & (lengths[at] == found.ends - found.starts)
                pairs, times = np.unique(doc[hit] * len(hashes) + at[hit], return_counts=True)
                owner = pairs // len(hashes)
                some = np.flatnonzero(n)
                offsets = np.searchsorted(owner, np.append(some, len(held)))
                terms = pa.array((pairs % len(hashes)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(some + first)), pa.array(n[some].astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), terms),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(times.astype(np.int32)))],
                    ["doc_id", "n", "terms", "times"],
                )

    return count


def weights(index: Index, frequency: dict[int, int], documents: int) -> np.ndarray:
    return np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(t, 0) + 1)))
         for t in range(len(index.hashes))],
        dtype=np.int64,
    )


class Heaps:
    """The best ``top`` documents of each item; equal scores by ascending doc_id, null last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(items)]
        self.least = np.ones(items, dtype=np.int64)

    def update(self, scores: np.ndarray, documents: list[int | None]) -> None:
        """Offers a table of scores, documents by items."""
        for d, i in zip(*(x.tolist() for x in np.nonzero(scores >= self.least)), strict=True):
            heap = self.heaps[i]
            entry = (int(scores[d, i]), -(1 << 63) - 1 if documents[d] is None else -documents[d])
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.least[i] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        """(item, doc_id, score)"""
        for i, heap in enumerate(self.heaps):
            for score, negative in heap:
                yield i, None if negative < -(1 << 63) else -negative, score


def scorer(index: Index, weight: np.ndarray, documents: int, terms: int, top: int):
    """A function for ``mapInArrow``: counts of terms to the heaps of the task."""

    def scores(doc: np.ndarray, m: np.ndarray, term: np.ndarray, times: np.ndarray, count: int) -> np.ndarray:
        part = weight[term] * ((SCALE * times) // (SATURATION * times + LENGTH * m[doc]))
        out = np.zeros(count * len(index.ids), dtype=np.int64)
        spread = index.first[term + 1] - index.first[term]
        ends = np.cumsum(spread)
        begin = 0
        while begin < len(term):
            done = int(ends[begin - 1]) if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            s = spread[begin:stop]
            place = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
            place += np.repeat(index.first[term[begin:stop]], s)
            cell = np.repeat(doc[begin:stop] * len(index.ids), s) + index.items[place]
            np.add.at(out, cell, np.repeat(part[begin:stop], s) * index.times[place])
            begin = stop
        return out.reshape(count, len(index.ids))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(index.ids), top)
        step = max(1, CELLS // len(index.ids))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                n = batch.column(1).to_numpy()
                m = 100 - 25 + (25 * n * documents) // terms
                sizes = batch.column(2).value_lengths().to_numpy()
                doc = np.repeat(np.arange(batch.num_rows), sizes)
                term = batch.column(2).flatten().to_numpy().astype(np.int64)
                times = batch.column(3).flatten().to_numpy().astype(np.int64)
                heaps.update(scores(doc, m, term, times, batch.num_rows), batch.column(0).to_pylist())
        rows = list(heaps.rows())
        for at in range(0, len(rows), 10_000):
            item, doc_id, score = zip(*rows[at : at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([index.ids[i] for i in item], pa.int64()), pa.array(doc_id, pa.int64()),
                 pa.array(score, pa.int64())],
                ["item_id", "doc_id", "score"],
            )

    return best


def merged(heaps: DataFrame, top: int) -> DataFrame:
    """The best of all tasks' heaps, ranked.

    Salted groups are cut first, so that no task meets the heaps of all others at once.
    """
    best_first = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = Window.partitionBy("item_id", "_salt").orderBy(*best_first)
    ranked = Window.partitionBy("item_id").orderBy(*best_first)
    return (
        heaps.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        .withColumn("_within", F.row_number().over(salted)).filter(F.col("_within") <= top)
        .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): each item's best documents with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read. Terms,
    weights and the score are those of the module's contract: whole numbers but for one logarithm.
    A null or empty text has no terms: such a document is not counted, such an item finds nothing.
    Every row of ``docs`` is a document, also where doc_ids repeat; a null doc_id comes last among
    equal scores. Rows of ``items`` that share an item_id are one item with the terms of all its
    distinct texts. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rows = written(postings(items), "postings")
    for index in blocks(rows):
        texts = bounded(docs).select(F.col("doc_id").cast("long"), "text")
        hits = written(texts.mapInArrow(counter(index), HITS), "term-counts")
        totals = hits.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
        if not totals.documents:
            continue
        counted = hits.select(F.explode("terms").alias("term")).groupBy("term").count()
        frequency = dict(map(tuple, counted.collect()))  # a number for each term of the block
        weight = weights(index, frequency, totals.documents)
        heaps = hits.mapInArrow(scorer(index, weight, totals.documents, totals.terms, top), BEST)
        result = result.unionByName(merged(heaps, top))
    return result


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of ``documents`` for every item of ``benchmark``."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
sizes AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS documents, CAST(sum(n) AS BIGINT) AS total FROM sizes),
queries AS (SELECT item_id, term, count(*) AS times FROM (
  SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY ALL),
counts AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (
  SELECT r, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM queries) GROUP BY ALL),
weighted AS (SELECT term, CAST(floor(1000 * ln((2 * CAST(any_value(documents) AS DOUBLE) + 2)
  / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, corpus GROUP BY term),
scored AS (SELECT item_id, s.r, s.doc_id, CAST(sum(q.times * w
    * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * documents) // total)))) AS BIGINT) AS score
  FROM counts c JOIN sizes s ON s.r = c.r JOIN weighted g ON g.term = c.term
    JOIN queries q ON q.term = c.term, corpus GROUP BY ALL)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0) WHERE rank <= {TOP}
"""
