"""Prefix trie of conversations by range minima over sorted common-prefix lengths.

Every sequence of turns is a string of fixed-width codes. Sequences are range-sorted into parts,
and in a part the common-prefix lengths of neighbours make a sparse table. The members of a node
are an interval of the sorted order: from any row in it, the left and the right end are found each
by its own binary search over the table, as the farthest row with no smaller length in between.
Candidates are the places where the trie branches or a sequence ends; a node in between has the
members of the next one below. Nothing is kept on a stack and no candidate waits for another.

What a node reports is a sum over its rows, given the true common-prefix lengths at the borders of
a part, so that a node whose members lie in several parts is put together by adding its pieces.
Only prefixes of a part's first and last sequence can be such nodes. The digest of a group's ids
has to be taken in one go; of a group that crosses parts, the ids come to it as a stream of runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import table, written

WIDTH = 16
# Codes and rows that a part holds on average at most; a part is sorted and searched in one task.
PART_CODES = 1_000_000
PART_ROWS = 100_000
BATCH = 20_000
# Conversations share the first turns of every fifth one, up to eight of them.
EVERY, SHARED = 5, 9

NO_ENDS = hashlib.sha256(b"").hexdigest()
WHOLE, PIECE, END = 0, 1, 2
FOUND = (
    "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, node binary, parent binary"
)


def coded(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turns): turns in order, each a struct of its code and its bytes.

    A turn's code is 128 bits of the SHA-256 of its role and text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * WIDTH)).alias("code"),
        F.octet_length(text).cast("long").alias("size"),
    )
    listed = F.sort_array(F.collect_list(F.struct("turn", "code", "size")))
    return turns.groupBy("conv_id").agg(listed.alias("listed")).select(
        "conv_id", F.transform("listed", lambda t: F.struct(t["code"].alias("code"), t["size"].alias("size"))).alias("turns")
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, codes, sizes): each conversation begun with turns of its group's first one."""
    own = written(coded(conversations), "conversations")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED)).cast("int")
    first = own.filter(F.col("conv_id") % EVERY == 0).select(
        F.col("conv_id").alias("_first"), F.slice("turns", 1, SHARED - 1).alias("_opening")
    )
    none = F.array().cast("array<struct<code: binary, size: bigint>>")
    joined = own.withColumn("_head", head).join(
        first, F.col("conv_id") - F.col("conv_id") % EVERY == F.col("_first"), "left"
    )
    opening = F.slice(F.coalesce("_opening", none), F.lit(1), F.col("_head"))
    rest = F.slice("turns", F.col("_head") + 1, F.size("turns"))
    turns = joined.select("conv_id", F.concat(opening, rest).alias("turns"))
    codes = F.concat_ws("", F.transform("turns", lambda t: F.hex(t["code"])))
    return turns.select("conv_id", F.unhex(codes).alias("codes"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


class RangeMinimum:
    """Sparse table: row k holds the minima of the stretches of 2**k values."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 * (step := 1 << (len(self.rows) - 1)) <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of each stretch, both ends included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), dtype=self.rows[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.rows[k]
            out[at] = np.minimum(row[first[at]], row[last[at] - (1 << int(k)) + 1])
        return out

    def left(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """For each start, the smallest l such that all values after l up to start are >= least."""
        at = start.copy()
        for k in reversed(range(len(self.rows))):
            row, step = self.rows[k], 1 << k
            begin = at - step + 1
            at = np.where((begin >= 1) & (row[np.maximum(begin, 0)] >= least), at - step, at)
        return at

    def right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """For each start, the largest r such that all values after start up to r are >= least."""
        at = start.copy()
        for k in reversed(range(len(self.rows))):
            row, step = self.rows[k], 1 << k
            fits = at + step < len(self.rows[0])
            place = np.minimum(at + 1, len(row) - 1)
            at = np.where(fits & (row[place] >= least), at + step, at)
        return at


def common(a: bytes, b: bytes) -> int:
    """Codes that two sequences share from their start."""
    n = min(len(a), len(b))
    x, y = (np.frombuffer(s, dtype=np.uint8, count=n) for s in (a, b))
    differ = np.flatnonzero(x != y)
    return (int(differ[0]) if len(differ) else n) // WIDTH


def _neighbours(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Common-prefix lengths of each row with the one before; -1 for the first."""
    lengths = np.diff(offsets)
    shared = np.minimum(lengths[1:], lengths[:-1])
    out = np.full(len(lengths), -1, dtype=np.int64)
    if not len(shared):
        return out
    out[1:] = shared
    place = np.arange(int(shared.sum())) - np.repeat(np.cumsum(shared) - shared, shared)
    row = np.repeat(np.arange(1, len(lengths)), shared)
    differ = np.flatnonzero((codes[offsets[row] + place] != codes[offsets[row - 1] + place]).any(axis=1))
    np.minimum.at(out, row[differ], place[differ])
    return out


def _hashes(codes: bytes, most: int) -> list[bytes]:
    """Names of a sequence's prefixes of 0 to ``most`` turns."""
    state, out = hashlib.sha256(), []
    for k in range(most + 1):
        out.append(state.digest()[:WIDTH])
        state.update(codes[k * WIDTH : (k + 1) * WIDTH])
    return out


def _part_nodes(
    ids: np.ndarray, codes: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, border: tuple
) -> Iterator[dict[str, np.ndarray | list]]:
    """The nodes of a part's sorted rows, and the pieces of those that reach beyond it.

    ``border`` has the common-prefix lengths with the row before and the one after the part (-1
    if there is none), and whether those rows are equal to the part's first and last one.
    """
    before, after, same_before, same_after = border
    n, lengths = len(ids), np.diff(offsets)
    shared = _neighbours(codes, offsets)
    true = shared.copy()
    true[0] = before
    following = np.append(true[1:], after)
    spans = RangeMinimum(shared)
    smallest = RangeMinimum(ids)
    summed = np.append(0, np.cumsum(sizes))

    def weight(row: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """Bytes of a row's first turns."""
        return summed[offsets[row] + np.maximum(turns, 0)] - summed[offsets[row]]

    rows = np.arange(n)
    repeated = weight(rows, true)
    repeats = np.append(0, np.cumsum(repeated))
    leaves = np.append(0, np.cumsum(following < lengths))

    # Where sequences end and where they part: each extent by its own two searches.
    place = np.concatenate([rows, rows[1:]])
    depth = np.concatenate([lengths, shared[1:]])
    left, right = spans.left(place, depth), spans.right(place, depth)
    order = np.lexsort((depth, left))
    left, right, depth = left[order], right[order], depth[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (left[1:] != left[:-1]) | (depth[1:] != depth[:-1])
    left, right, depth = left[new], right[new], depth[new]

    beyond = np.append(shared, -1)
    above = np.maximum(shared[left], beyond[right + 1])
    # Children of a place where rows part: one for each row that goes on from there.
    going = np.flatnonzero((lengths > shared) & (rows > 0))
    from_left = spans.left(going, shared[going])
    key = np.searchsorted(left * (int(lengths.max()) + 1) + depth, from_left * (int(lengths.max()) + 1) + shared[going])
    children = np.bincount(key, minlength=len(left)) + ((lengths[left] > depth) & (true[left] <= depth))

    parent_left, parent_right = spans.left(left, above), spans.right(left, above)
    parent_least = smallest.between(parent_left, parent_right)
    least = smallest.between(left, right)
    first_names = _hashes(codes[: offsets[1]].tobytes(), max(before, 0))
    last_names = _hashes(codes[offsets[-2] :].tobytes(), max(after, 0))

    def name(first: int, k: int) -> bytes:
        return first_names[k] if first == 0 and k <= max(before, 0) else last_names[k]

    ends = [NO_ENDS] * len(left)
    open_ends: list[tuple[bytes, int, str]] = []
    full = np.flatnonzero(lengths[left] == depth)
    equal = np.append(shared[1:], -1) == lengths  # the next row shares all of this one
    equal[:-1] &= lengths[1:] == lengths[:-1]
    stops = np.flatnonzero(~equal)
    last_equal = stops[np.searchsorted(stops, left[full])]
    for node, a, b in zip(full.tolist(), left[full].tolist(), last_equal.tolist(), strict=True):
        if (a == 0 and same_before) or (b == n - 1 and same_after):
            k = int(depth[node])
            named = (first_names if a == 0 and same_before else last_names)[k]
            for low in range(a, b + 1, BATCH):
                run = ids[low : min(low + BATCH, b + 1)].tolist()
                open_ends.append((named, run[0], ",".join(map(str, run))))
            ends[node] = ""
        else:
            ends[node] = hashlib.sha256(",".join(map(str, ids[a : b + 1].tolist())).encode()).hexdigest()

    counts = depth - above
    done = np.append(0, np.cumsum(counts))
    begin = 0
    while begin < len(left):
        stop = max(begin + 1, int(np.searchsorted(done, done[begin] + BATCH, "right")) - 1)
        for low in range(0, int(counts[begin:stop].sum()), BATCH):
            # A node with a very long path to its parent comes in several portions.
            index = np.arange(done[begin] + low, min(done[begin] + low + BATCH, done[stop]))
            node = np.searchsorted(done, index, "right") - 1
            k = depth[node] - (index - done[node])
            a, b = left[node], right[node]
            inside = (a == 0) & (before >= k)
            piece = inside | ((b == n - 1) & (after >= k)) | (k == 0)
            fixed = weight(a, k - 1)
            saved = repeats[b + 1] - repeats[a + 1] - (b - a) * fixed + np.where(inside, repeated[a] - fixed, 0)
            up_wide = k - 1 == above[node]
            up_a, up_b = np.where(up_wide, parent_left[node], a), np.where(up_wide, parent_right[node], b)
            up_piece = ((up_a == 0) & (before >= k - 1)) | ((up_b == n - 1) & (after >= k - 1)) | (k == 1)
            up_piece &= k > 0
            tops, bottoms = a.tolist(), k.tolist()
            yield {
                "kind": np.where(piece, PIECE, WHOLE).astype(np.int32),
                "conv_id": least[node], "depth": k,
                "parent_conv_id": [
                    None if p else x for p, x in
                    zip((up_piece | (k == 0)).tolist(), np.where(up_wide, parent_least[node], least[node]).tolist(), strict=True)
                ],
                "n_convs": b - a + 1,
                "n_children": np.where(k == depth[node], children[node], true[a] <= k).astype(np.int64),
                "n_leaves": leaves[b + 1] - leaves[a],
                "saved_tokens": saved,
                "ends_sha256": [ends[j] if x == y else NO_ENDS for j, x, y in
                                zip(node.tolist(), bottoms, depth[node].tolist(), strict=True)],
                "node": [name(t, x) if p else None for p, t, x in zip(piece.tolist(), tops, bottoms, strict=True)],
                "parent": [name(t, x - 1) if p else None for p, t, x in
                           zip(up_piece.tolist(), up_a.tolist(), bottoms, strict=True)],
            }
        begin = stop
    # At most two groups, in runs of ids; written out as what they add to the group's list.
    for named, first, run in open_ends:
        yield {c: [None] for c in _COLUMNS} | {"kind": [END], "conv_id": [first], "node": [named], "ends_sha256": [run]}


_TYPES = {"kind": pa.int32(), "ends_sha256": pa.string(), "node": pa.binary(), "parent": pa.binary()}
_COLUMNS = [x.split()[0] for x in FOUND.split(", ")]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, before, after, same_before, same_after, conv_id, codes, sizes), sorted by part."""

    def nodes(part: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(part).combine_chunks()
        border = tuple(rows.column(c)[0].as_py() for c in ("before", "after", "same_before", "same_after"))
        strings = rows.column("codes").combine_chunks().to_pylist()
        offsets = np.append(0, np.cumsum([len(s) // WIDTH for s in strings])).astype(np.int64)
        codes = np.frombuffer(b"".join(strings), dtype=np.uint64).reshape(-1, WIDTH // 8)
        sizes = rows.column("sizes").combine_chunks().flatten().to_numpy()
        for found in _part_nodes(rows.column("conv_id").to_numpy(), codes, offsets, sizes, border):
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[c], _TYPES.get(c, pa.int64())) for c in _COLUMNS], _COLUMNS
            )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        part = batch.column(0).to_numpy()
        edges = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(part)], strict=True):
            if a == b:
                continue
            if held and held[-1].column(0)[0].as_py() != int(part[a]):
                yield from nodes(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield from nodes(held)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's ids, from rows (node, run) in the order of ids; runs pass as a stream."""
    now, state = None, None
    for batch in batches:
        out = []
        for node, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if node != now:
                if state is not None:
                    out.append((now, state.hexdigest()))
                now, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(run.encode())
        yield _digest_rows(out)
    if state is not None:
        yield _digest_rows([(now, state.hexdigest())])


def _digest_rows(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in rows], pa.binary()), pa.array([x for _, x in rows], pa.string())],
        ["node", "digest"],
    )


def _bordered(spark: SparkSession, ordered: DataFrame) -> DataFrame:
    """For each part what it shares with its neighbours: a row per part, of two sequences each."""
    ends = ordered.groupBy("part").agg(
        F.min_by("codes", F.struct("codes", "conv_id")).alias("first"),
        F.max_by("codes", F.struct("codes", "conv_id")).alias("last"),
    )
    in_order = Window.orderBy("part")  # a row per part
    sides = ends.select(
        "part", "first", "last", F.lag("last").over(in_order).alias("previous"),
        F.lead("first").over(in_order).alias("next"),
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out = [
                [r["part"] for r in rows],
                [-1 if r["previous"] is None else common(r["previous"], r["first"]) for r in rows],
                [-1 if r["next"] is None else common(r["last"], r["next"]) for r in rows],
                [r["previous"] == r["first"] for r in rows], [r["next"] == r["last"] for r in rows],
            ]
            types = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, types, strict=True)],
                ["part", "before", "after", "same_before", "same_after"],
            )

    return sides.mapInArrow(
        compared, "part int, before long, after long, same_before boolean, same_after boolean"
    )


def prefix_trie(sequences: DataFrame, parts: int | None = None) -> DataFrame:
    """Every node of the trie, from rows (conv_id, codes, sizes); a conv_id comes once.

    ``codes`` is a string of codes of 16 bytes and ``sizes`` has the bytes of each turn. Rows are
    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    Copies of a sequence are spread over parts by their conv_id, so a group of any size is cut
    like any other rows. A sequence is one row: 16 bytes a turn. No rows give no nodes.
    """
    spark = sequences.sparkSession
    rows = written(sequences, "sequences")
    if parts is None:
        size = rows.agg(F.sum(F.length("codes")), F.count(F.lit(1))).first()
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = max(least, -(-(size[0] or 0) // (WIDTH * PART_CODES)), -(-size[1] // PART_ROWS))
    ordered = written(
        rows.repartitionByRange(parts, "codes", "conv_id").withColumn("part", F.spark_partition_id()), "ordered"
    )
    borders = written(_bordered(spark, ordered), "borders")
    sides = ordered.join(borders, "part").select(
        "part", "before", "after", "same_before", "same_after", "conv_id", "codes", "sizes"
    )
    found = written(
        sides.repartition(parts, "part").sortWithinPartitions("part", "codes", "conv_id").mapInArrow(_searched, FOUND),
        "nodes",
    )
    digests = (
        found.filter(F.col("kind") == END).repartition(parts, "node").sortWithinPartitions("node", "conv_id")
        .select("node", "ends_sha256").mapInArrow(_digests, "node binary, digest string")
    )
    measures = ("n_convs", "n_children", "n_leaves", "saved_tokens")

    def known(c: Column) -> Column:
        """A digest of ids that lie in one part; the others' are not made there."""
        return F.max(F.when(~c.isin(NO_ENDS, ""), c))

    pieces = found.filter(F.col("kind") == PIECE).groupBy("node", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in measures],
        known(F.col("ends_sha256")).alias("own"), F.max("parent").alias("parent"),
    ).join(digests, "node", "left").withColumn("ends_sha256", F.coalesce("own", "digest", F.lit(NO_ENDS)))
    pieces = written(pieces, "pieces")
    tops = pieces.select(F.col("node").alias("parent"), F.col("conv_id").alias("_top"))
    columns = ["conv_id", "depth", "parent_conv_id", *measures, "ends_sha256"]
    under = found.filter((F.col("kind") == WHOLE) & F.col("parent").isNotNull()).select(
        "parent", *[c for c in columns if c != "parent_conv_id"]
    ).unionByName(pieces.select("parent", *[c for c in columns if c != "parent_conv_id"]))
    joined = under.join(tops, "parent", "left").withColumn("parent_conv_id", F.col("_top"))
    return found.filter((F.col("kind") == WHOLE) & F.col("parent").isNull()).select(*columns).unionByName(
        joined.select(*columns)
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations.

    Turns are ordered by ``turn``, null first, and turns that tie by their code. A null role or
    text is empty; rows without a conv_id belong to no conversation. Repeated rows are turns of
    their own. Columns other than these four are not read. An empty table has no nodes.
    """
    return prefix_trie(rebuilt(conversations))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of ``conversations``."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


# The check sum takes one bit at a time: the lowest eight take in a new byte.
_CRC = """list_reduce(list_concat([4294967295::BIGINT], flatten([[ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]
  for x in string_split(c::VARCHAR, '')])), lambda crc, bit: xor(xor(crc, bit) >> 1,
    CASE WHEN xor(crc, bit) & 1 = 1 THEN 3988292384 ELSE 0 END))"""
SQL = f"""
WITH turns AS (SELECT conv_id AS c, concat(coalesce(role, ''), chr(1), coalesce(text, '')) AS name,
    strlen(coalesce(text, '')) AS size, row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
heads AS (SELECT c, c - c % {EVERY} AS first, xor({_CRC}, 4294967295) % {SHARED} AS h
  FROM (SELECT DISTINCT c FROM turns)),
steps AS (SELECT h.c, t.place, name, size FROM heads h JOIN turns t ON t.c = h.first AND t.place <= h
  UNION ALL SELECT h.c, t.place, name, size FROM heads h JOIN turns t ON t.c = h.c AND t.place > h),
numbered AS (SELECT c, name, size, row_number() OVER (PARTITION BY c ORDER BY place) AS depth FROM steps),
paths AS (SELECT c, depth, size, list(name) OVER (PARTITION BY c ORDER BY depth) AS path FROM numbered
  UNION ALL SELECT c, 0, 0, [] FROM heads),
ended AS (SELECT c, max(depth) AS last FROM paths GROUP BY c),
nodes AS (SELECT path, depth, min(c) AS conv_id, count(*) AS n, any_value(size) AS size,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = last), '')) AS ends
  FROM paths JOIN ended USING (c) GROUP BY path, depth),
childless AS (SELECT path FROM nodes WHERE path NOT IN (SELECT path[:depth - 1] FROM nodes WHERE depth > 0)),
below AS (SELECT path[:k] AS path, sum((n - 1) * size) AS saved,
    count(*) FILTER (path IN (SELECT path FROM childless)) AS leaves
  FROM (SELECT path, n, size, unnest(range(depth + 1)) AS k FROM nodes) GROUP BY 1),
kids AS (SELECT path[:depth - 1] AS path, count(*) AS children FROM nodes WHERE depth > 0 GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n AS BIGINT) AS n_convs,
  CAST(coalesce(children, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN below USING (path) LEFT JOIN kids USING (path)
  LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:n.depth - 1]
"""
