"""Join of near-duplicate texts: MinHash bands, Bayesian pruning, exact Jaccard similarity.

Texts with one set of word shingles form one class, found first, so exact copies cost nothing
later. Bands of MinHash values bring classes together. A pair is then compared a few hash values
at a time and dropped when the posterior probability of its similarity reaching the threshold,
given the matches so far and a uniform prior, is below a tolerance. The pairs that remain are
verified exactly on their shingle sets.

Pairs are never rows. A bucket is cut into blocks of bounded size; a task compares two blocks
with numpy and gives back, for each class in them, how many links it found and the smallest
class it is linked with through others. A pair counts in the first band that it shares only.
Shingle sets travel for the classes that still have a candidate after pruning, and are computed
anew from the text, which is cheaper than keeping them for all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .tables import bounded, table, written
from .words import lowered, mix, shingles, words

WORDS = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 4
TOLERANCE = 1e-6
STEP = 16
BLOCK = 512
PAIRS_AT_ONCE = 1 << 16
HASHES = BANDS * ROWS
_ids = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_FACTORS = (_ids[:HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (_ids[HASHES:] >> np.uint64(32)).astype(np.uint32)
SIGNED = "doc_id long, row_key string, class binary, signature binary"


def signature(sets: np.ndarray) -> np.ndarray:
    """MinHash values of a shingle set: the least of each of the hash functions."""
    base = (sets >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(base), 2048):
        hashed = base[at : at + 2048, None] * _FACTORS + _SHIFTS
        hashed ^= hashed >> np.uint32(15)
        np.minimum(least, hashed.min(axis=0), out=least)
    return least


def needed_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For each number of compared values, the fewest matches that keep a pair.

    With a uniform prior, m matches among n values leave the similarity a Beta(m+1, n-m+1)
    distribution, which exceeds the threshold t with the probability that at most m of n+1
    independent trials of chance t succeed.
    """
    out = np.zeros(HASHES + 1, dtype=np.int64)
    for n in range(1, HASHES + 1):
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def _signed(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        names, signatures = [], []
        for text in batch.column(2):
            found = shingles(words(lowered(text.as_py())).hashes, n_words)
            known = len(found) > 0
            names.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if known else None)
            signatures.append(signature(found).tobytes() if known else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(names, pa.binary()),
             pa.array(signatures, pa.binary())],
            ["doc_id", "row_key", "class", "signature"],
        )


def _shingled(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [
            shingles(words(lowered(x.as_py())).hashes, n_words).tobytes() for x in batch.column(1)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sets, pa.binary())], ["class", "shingles"]
        )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal (bucket, left, right), with the places where runs begin."""
    held: list[pa.RecordBatch] = []
    last = None

    def key(batch: pa.RecordBatch) -> np.ndarray:
        return np.stack([batch.column(i).to_numpy() for i in range(3)])

    def cut(piece: pa.Table) -> tuple[pa.Table, np.ndarray]:
        keys = np.stack([piece.column(i).to_numpy() for i in range(3)])
        return piece, np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = key(batch)
        changes = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        begins = 0
        if held and (keys[:, 0] != last).any():
            changes = np.append(0, changes)
        if len(changes):
            begins = int(changes[-1])
            ready = [*held, batch.slice(0, begins)]
            if table_ := [x for x in ready if x.num_rows]:
                yield cut(pa.Table.from_batches(table_))
            held = []
        held.append(batch.slice(begins))
        last = keys[:, -1]
    if held:
        yield cut(pa.Table.from_batches(held))


def _pairs(blocks: np.ndarray, begins: np.ndarray, crossing: np.ndarray) -> Iterator[tuple]:
    """Index pairs within the runs: across the two blocks, or within if there is one block."""
    ends = np.append(begins[1:], len(blocks))
    lefts, rights, size = [], [], 0
    for begin, end, cross in zip(begins, ends, crossing, strict=True):
        if cross:
            side = blocks[begin:end]
            one = begin + np.flatnonzero(side == side.min())
            two = begin + np.flatnonzero(side != side.min())
            a, b = np.repeat(one, len(two)), np.tile(two, len(one))
        else:
            a, b = np.triu_indices(end - begin, 1)
            a, b = a + begin, b + begin
        while len(a):
            room = PAIRS_AT_ONCE - size
            lefts.append(a[:room])
            rights.append(b[:room])
            size += len(lefts[-1])
            a, b = a[room:], b[room:]
            if size == PAIRS_AT_ONCE:
                yield np.concatenate(lefts), np.concatenate(rights)
                lefts, rights, size = [], [], 0
    if size:
        yield np.concatenate(lefts), np.concatenate(rights)


def _candidates(piece: pa.Table, begins: np.ndarray, needed: np.ndarray) -> Iterator[tuple]:
    """Pairs of the runs that no earlier band has brought together and that pruning keeps."""
    values = np.frombuffer(b"".join(piece.column("signature").to_pylist()), dtype=np.uint32)
    values = values.reshape(-1, HASHES)
    band = piece.column("band").to_numpy()
    block = piece.column("block").to_numpy()
    crossing = (piece.column("left").to_numpy() != piece.column("right").to_numpy())[begins]
    for a, b in _pairs(block, begins, crossing):
        matches = np.zeros(len(a), dtype=np.int64)
        for at in range(0, HASHES, STEP):
            same = values[a, at : at + STEP] == values[b, at : at + STEP]
            matches += same.sum(axis=1)
            banded = same.reshape(-1, STEP // ROWS, ROWS).all(axis=2)
            earlier = np.arange(at // ROWS, at // ROWS + STEP // ROWS)[None, :] < band[a][:, None]
            keep = (matches >= needed[at + STEP]) & ~(banded & earlier).any(axis=1)
            a, b, matches = a[keep], b[keep], matches[keep]
        if len(a):
            yield a, b


def _surviving(batches: Iterator[pa.RecordBatch], needed: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of members that have a candidate left."""
    for piece, begins in _runs(batches):
        alive = np.zeros(piece.num_rows, dtype=bool)
        for a, b in _candidates(piece, begins, needed):
            alive[a] = True
            alive[b] = True
        if alive.any():
            yield from piece.filter(pa.array(alive)).combine_chunks().to_batches()


def _verified(
    batches: Iterator[pa.RecordBatch], needed: np.ndarray, threshold: float
) -> Iterator[pa.RecordBatch]:
    """Rows (class, links, leader) for members with links: a star for each linked set of a run."""
    for piece, begins in _runs(batches):
        names = piece.column("class").to_pylist()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in piece.column("shingles").to_pylist()]
        links = np.zeros(len(names), dtype=np.int64)
        leader = np.arange(len(names))

        def root(x: int) -> int:
            while leader[x] != x:
                leader[x] = leader[leader[x]]
                x = leader[x]
            return x

        for a, b in _candidates(piece, begins, needed):
            for i, j, common in zip(a, b, _common(sets, a, b), strict=True):
                if common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                    links[i] += 1
                    links[j] += 1
                    x, y = root(i), root(j)
                    if x != y:
                        leader[max(x, y)] = min(x, y)
        found = np.flatnonzero(links)
        if len(found):
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in found], pa.binary()), pa.array(links[found]),
                 pa.array([names[root(i)] for i in found], pa.binary())],
                ["class", "links", "leader"],
            )


def _common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets.

    Few pairs are intersected one by one. Where the sets occur in many pairs, as in a group of
    near copies, they become the rows of a 0/1 matrix over the shingles that two of them share,
    and all intersections are one matrix product, taken over a thousand shingles at a time.
    """
    members = np.unique(np.concatenate([a, b]))
    if len(a) < 8 * len(members):
        return np.array(
            [np.intersect1d(sets[i], sets[j], assume_unique=True).size for i, j in zip(a, b)],
            dtype=np.int64,
        )
    out = np.zeros(len(a), dtype=np.int64)
    for at in range(0, len(members), 2 * BLOCK):  # tiles of a bounded number of sets
        for to in range(0, len(members), 2 * BLOCK):
            one, two = members[at : at + 2 * BLOCK], members[to : to + 2 * BLOCK]
            inside = np.flatnonzero(np.isin(a, one) & np.isin(b, two))
            if len(inside):
                product = _products([sets[i] for i in one], [sets[i] for i in two])
                out[inside] = product[np.searchsorted(one, a[inside]), np.searchsorted(two, b[inside])]
    return out


def _products(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    values = np.concatenate([np.concatenate(one), np.concatenate(two)])
    shared, place, count = np.unique(values, return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(one) + len(two)), [len(x) for x in [*one, *two]])
    numbers = np.cumsum(count > 1) - 1
    kept = count[place] > 1
    rows, columns = rows[kept], numbers[place[kept]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    total = np.zeros((len(one), len(two)), dtype=np.float32)
    width = 1024
    for at in range(0, int(columns[-1]) + 1 if len(columns) else 0, width):
        begin, end = np.searchsorted(columns, [at, at + width])
        dense = np.zeros((len(one) + len(two), width), dtype=np.float32)
        dense[rows[begin:end], columns[begin:end] - at] = 1
        total += dense[: len(one)] @ dense[len(one) :].T
    return total.astype(np.int64)


def grouped(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    n_words: int = WORDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Rows (doc_id, row_key, root, class_id, copy_id, n_copies, n_links), one per row of ``docs``.

    ``row_key`` is a digest of doc_id and text and ``root`` names the component, null for texts
    without words. The rest: see ``jaccard_join``.
    """
    texts = bounded(docs).select("doc_id", row_key().alias("row_key"), "text")
    signed = written(texts.mapInArrow(lambda it: _signed(it, n_words), SIGNED), "signatures")
    classes = written(
        signed.filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("copy_id"),
            F.min("row_key").alias("row_key"),
            F.count(F.lit(1)).alias("n_copies"),
            F.first("signature").alias("signature"),
        ),
        "classes",
    )
    needed = needed_matches(threshold, tolerance)
    signatures = classes.select("class", "signature")
    alive = written(
        _by_bucket(_members(classes).join(signatures, "class"))
        .mapInArrow(lambda it: _surviving(it, needed), _MEMBER + ", signature binary")
        .drop("signature"),
        "candidates",
    )
    # One text for each class that has a candidate; its shingles are those of the whole class.
    wanted = alive.select("class").distinct().join(classes.select("class", "row_key"), "class")
    sets = written(
        texts.join(wanted, "row_key")
        .select("class", "text")
        .mapInArrow(lambda it: _shingled(it, n_words), "class binary, shingles binary")
        .groupBy("class").agg(F.first("shingles").alias("shingles")),
        "shingles",
    )
    found = written(
        _by_bucket(alive.join(signatures, "class").join(sets, "class")).mapInArrow(
            lambda it: _verified(it, needed, threshold), "class binary, links long, leader binary"
        ),
        "links",
    )
    linked = found.groupBy("class").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("class").alias("a"), F.col("leader").alias("b")))
    placed = (
        classes.select("class", "copy_id", "n_copies")
        .join(linked, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    named = placed.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    placed = placed.join(named, "root")
    alone = F.col("root").isNull()
    return signed.select("doc_id", "row_key", "class").join(placed, "class", "left").select(
        "doc_id",
        "row_key",
        "root",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def row_key() -> Column:
    """A digest of doc_id and text that tells rows apart; null and empty texts are alike."""
    known = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text")]
    return F.md5(F.concat(known[0], F.lit(":"), known[1]))


def jaccard_join(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    n_words: int = WORDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Rows (doc_id, class_id, copy_id, n_copies, n_links), one per row of ``docs``.

    class_id is the smallest doc_id of the component of linked documents, copy_id that of the
    documents with the same set of shingles, n_copies their number, and n_links the number of
    other shingle sets with a similarity of at least ``threshold``. A text with fewer than
    ``n_words`` words is a single shingle. A text without words, or null, has no shingles and
    links with nothing: it is its own class under its own doc_id with one copy. A null doc_id
    counts among copies and links but names no class unless all are null. Rows that repeat a
    doc_id are documents of their own. Other columns are not read. Empty tables give no rows.
    """
    return grouped(docs, threshold, n_words, tolerance).drop("row_key", "root")


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD, n_words: int = WORDS) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all its columns.

    Texts without words are no copies of each other; of rows that repeat doc_id and text, one
    stays.
    """
    rows = grouped(docs, threshold, n_words)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
    kept = (
        rows.groupBy(F.coalesce(F.hex("root"), F.col("row_key")).alias("group"))
        .agg(first["row_key"].alias("_row_key"))
    )
    keyed = docs.withColumn("_row_key", row_key())
    return (
        keyed.join(kept.select("_row_key"), "_row_key", "left_semi")
        .dropDuplicates(["_row_key"])
        .select(docs.columns)
    )


_MEMBER = "bucket long, left int, right int, band int, block int, class binary"


def _members(classes: DataFrame) -> DataFrame:
    """Classes by the buckets they share with others; a large bucket by pairs of its blocks."""
    banded = classes.select(
        "class",
        F.posexplode(
            F.array(*[F.substring("signature", 4 * ROWS * b + 1, 4 * ROWS) for b in range(BANDS)])
        ).alias("band", "values"),
    ).select("class", "band", F.xxhash64("band", "values").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    dealt = (
        banded.join(sizes, "bucket")
        .withColumn("_blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    )
    return dealt.select(
        "bucket",
        F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
        "band", "block", "class",
    )


def _by_bucket(members: DataFrame) -> DataFrame:
    more = [c for c in ("signature", "shingles") if c in members.columns]
    return (
        members.select("bucket", "left", "right", "band", "block", "class", *more)
        .repartition("bucket", "left", "right")
        .sortWithinPartitions("bucket", "left", "right", "class")
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of ``documents``: doc_id, class_id, copy_id, n_copies, n_links."""
    return jaccard_join(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) BETWEEN 1 AND 4 THEN [array_to_string(words, ' ')]
    WHEN len(words) > 4 THEN list_sort(list_distinct(list_transform(
      range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))) END AS shingles
  FROM split),
classes AS (
  SELECT shingles, min(doc_id) AS copy_id, count(*) AS n_copies FROM sets
  WHERE shingles IS NOT NULL GROUP BY shingles),
each AS (SELECT copy_id, len(shingles) AS n, unnest(shingles) AS shingle FROM classes),
links AS (
  SELECT a.copy_id AS a, b.copy_id AS b FROM each a JOIN each b
    ON a.shingle = b.shingle AND a.copy_id <> b.copy_id
  GROUP BY a.copy_id, b.copy_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*))),
reached AS (
  SELECT copy_id AS a, copy_id AS b FROM classes
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
roots AS (SELECT a AS copy_id, min(b) AS class_id FROM reached GROUP BY a),
counts AS (SELECT a AS copy_id, count(*) AS n_links FROM links GROUP BY a)
SELECT s.doc_id, coalesce(r.class_id, s.doc_id) AS class_id, coalesce(c.copy_id, s.doc_id) AS copy_id,
  coalesce(c.n_copies, 1) AS n_copies, coalesce(n.n_links, 0) AS n_links
FROM sets s LEFT JOIN classes c ON c.shingles = s.shingles
LEFT JOIN roots r ON r.copy_id = c.copy_id LEFT JOIN counts n ON n.copy_id = c.copy_id"""
