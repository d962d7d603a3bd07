"""Line deduplication over fuzzy copies, in DataFrame operations only.

Equal lines, lower-cased and without white space at their ends, are one node. A line's character
shingles are hashed once and sorted. A MinHash value is the first hash at or after a fixed point of
the ring of 64-bit numbers, so all values of a line come from one sorted array, where it is read.
Bands of values make buckets. Each distinct line is dealt to them without its text; texts are
fetched for lines that share a bucket with another line. In each bucket all lines are compared
exactly with the first one; what this links is joined by distributed union-find. Then lines of a
bucket that are still in different components are compared with each other, so that no candidate
pair is left out, without listing the pairs of a group of copies. Of each component the first line
stays.

Lines are nodes under a 128-bit hash: among n distinct lines, n * n / 2**129 pairs are expected to
share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .tables import table, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 14
ROWS = 5
STRIDE = 14  # points of the ring that are looked for together
MAP_BITS = 1 << 15  # of a bitmap, which Spark's functions fix
MOST_MAPS = 1 << 13  # 32 megabytes
WORDS = 32  # of 64 bits in a line's sketch
SKETCHED = 16  # places in buckets that a line's neighbours fill, from which on it gets a sketch
_UNITS = 2  # bytes of a UTF-16 code unit, the characters of shingles


def normalised(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(" \t\r")))


def _node(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _hashes(line: Column) -> Column:
    """Hashes of a line's shingles as an array, null if it has none.

    The coded line is bound to a variable, so that it is made once and not for every shingle.
    """
    width = _UNITS * SHINGLE

    def of(data: Column) -> Column:
        starts = F.sequence(F.lit(1), F.octet_length(data) - (width - 1), F.lit(_UNITS))
        each = F.transform(starts, lambda i: F.xxhash64(F.substring(data, i, F.lit(width))))
        return F.when(F.octet_length(data) >= width, each)

    return F.transform(F.array(F.encode(line, "UTF-16BE")), of)[0]


def _points() -> list[int]:
    """Fixed points of the ring in ascending order, at equal distances."""
    count = BANDS * ROWS
    return [(2 * i + 1 - count) * (2**63 // count) for i in range(count)]


def _keyed(lines: DataFrame) -> DataFrame:
    """The rows with a key for each band in place of ``line``; null for lines without a shingle."""
    others = [c for c in lines.columns if c != "line"]
    points = _points()
    ring = F.array(*[F.lit(p).cast("long") for p in points])
    hashed = lines.select(*others, F.sort_array(_hashes(F.col("line"))).alias("_set"))
    merged = hashed.select("*", F.sort_array(F.concat("_set", ring)).alias("_merged"))

    # Points are looked for from the last of every STRIDE points on, not from the first hash on.
    starts = range(0, len(points), STRIDE)
    found = [F.array_position("_merged", F.lit(points[k]).cast("long")).cast("int") for k in starts]
    found = merged.select("*", *[at.alias(f"_at{k}") for k, at in zip(starts, found)])
    ends = [F.col(f"_at{k}") for k in starts[1:]] + [F.size("_merged") + 1]
    parted = found.select(
        *others, "_set", *[f"_at{k}" for k in starts],
        *[
            F.slice("_merged", F.col(f"_at{k}"), end - F.col(f"_at{k}")).alias(f"_from{k}")
            for k, end in zip(starts, ends)
        ],
    )

    def value(k: int) -> Column:
        # The point's place among the hashes and k earlier points; after the last comes the first.
        first = k - k % STRIDE
        within = F.array_position(f"_from{first}", F.lit(points[k]).cast("long"))
        place = F.col(f"_at{first}") + within - F.lit(k + 2)
        return F.get("_set", F.pmod(place, F.size("_set")).cast("int"))

    # A band's points lie apart, so that they rarely fall on the same hash.
    bands = [
        F.xxhash64(F.lit(b), *[value(b + r * BANDS) for r in range(ROWS)]) for b in range(BANDS)
    ]
    # A lambda beside them lets the keys be compiled in small methods instead of a single huge one;
    # inside a lambda they would not be compiled at all.
    some = F.exists(F.array(F.size("_set")), lambda n: n > 0)
    return parted.select(*others, F.when(some, F.array(*bands)).alias("keys"))


def _reached(common: Column, sizes: Column, threshold: float) -> Column:
    """Whether sets with these sizes in all and this intersection are similar; exact at a tie."""
    return common * (1 + threshold) >= threshold * sizes - 1e-9


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Of rows (a, b), those whose shingle sets have at least this Jaccard similarity."""
    one = texts.select(F.col("node").alias("a"), F.col("line").alias("_x"), F.col("n").alias("_m"))
    two = texts.select(F.col("node").alias("b"), F.col("line").alias("_y"), F.col("n").alias("_n"))
    # A smaller set below the threshold's part of the larger cannot reach it.
    near = F.least("_m", "_n") >= F.lit(threshold) * F.greatest("_m", "_n") - 1e-9
    told = pairs.distinct().join(one, "a").join(two, "b").filter(near)
    common = F.size(F.array_intersect(_hashes(F.col("_x")), _hashes(F.col("_y"))))
    return told.filter(_reached(common, F.col("_m") + F.col("_n"), threshold)).select("a", "b")


def _sketched(texts: DataFrame) -> DataFrame:
    """The rows with ``sketch``, bits of the hashes of ``line``; null for lines of few neighbours.

    To make a sketch takes as long as a few comparisons.
    """
    # Dealt by node as texts, which are smaller than the words.
    many = texts.filter(F.col("neighbours") >= SKETCHED).select("node", "line").repartition("node")
    slots = many.select("node", F.explode(_hashes(F.col("line"))).alias("_h"))
    number = F.pmod(F.shiftright("_h", 6), F.lit(WORDS)).cast("int")
    bit = F.expr("shiftleft(1L, cast(_h & 63 AS int))")
    words = slots.groupBy("node", number.alias("_number")).agg(F.bit_or(bit).alias("_word"))
    each = [F.max(F.when(F.col("_number") == k, F.col("_word"))) for k in range(WORDS)]
    each = [F.coalesce(word, F.lit(0).cast("long")) for word in each]
    return texts.join(words.groupBy("node").agg(F.array(*each).alias("sketch")), "node", "left")


def _perhaps_alike(x: str, y: str, threshold: float) -> Column:
    """Whether sketches leave it open that two lines are similar.

    A bit that only one line has stands for a hash that only this line has, so that the bits that
    differ are no more than the hashes that do. Similar lines always pass.
    """
    each = F.zip_with(f"{x}.sketch", f"{y}.sketch", lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    differing = F.aggregate(each, F.lit(0), lambda total, bits: total + bits)
    sizes = F.col(f"{x}.n") + F.col(f"{y}.n")
    # A method for all words at once would be too large for the JVM to compile.
    return F.coalesce(_reached((sizes - differing) / 2, sizes, threshold), F.lit(True))


def linked_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (node, root) of the distinct lines that are linked with others."""
    return _linked(docs, written(_keyed(_numbered(docs)), "lines"), threshold)


def _numbered(docs: DataFrame) -> DataFrame:
    """A row for each line, at least one for each document, with the line and its node.

    Lines without a character other than white space have neither. ``told`` orders documents
    that share a doc_id.
    """
    parts = F.split("text", "\n", -1)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id",
        F.xxhash64("text").alias("told"),
        F.coalesce(F.size(parts), F.lit(0)).alias("n_lines"), parts.alias("_parts"),
    ).select("row_id", "doc_id", "told", "n_lines", F.posexplode_outer("_parts").alias("line_no", "_line"))
    line = F.when(normalised(F.col("_line")) != "", normalised(F.col("_line")))
    return rows.withColumn("line", line).drop("_line").withColumn("node", _node(F.col("line")))


def _linked(docs: DataFrame, keyed: DataFrame, threshold: float) -> DataFrame:
    # Repeated lines are one row before their buckets are dealt; both sides share that shuffle.
    once = keyed.filter(F.col("keys").isNotNull()).select("node", "keys").distinct()
    placed = once.select("node", F.explode("keys").alias("bucket")).repartition("bucket")
    half = F.xxhash64("node")
    several = (
        placed.groupBy("bucket").agg(F.min(half).alias("x"), F.max(half).alias("y"))
        .filter(F.col("x") < F.col("y")).select("bucket")
    )
    # Few buckets hold several lines: they fit a hash table, which spares sorting all keys.
    members = written(placed.join(several.hint("shuffle_hash"), "bucket"), "members")
    firsts = members.groupBy("bucket").agg(F.min("node").alias("first"))
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    lines = lines.select(normalised(F.col("line")).alias("line"))
    lines = lines.select(_node(F.col("line")).alias("node"), "line")
    # Written first, so that its size is known: below Spark's threshold no text is shuffled.
    wanted = written(members.select("node").distinct(), "wanted")
    texts = written(
        _fetched(lines, wanted).distinct()
        .withColumn("n", F.size(F.array_distinct(_hashes(F.col("line"))))),
        "texts",
    )
    told = members.join(firsts, "bucket")
    stars = told.filter(F.col("node") != F.col("first")).select(
        F.col("node").alias("a"), F.col("first").alias("b")
    )
    links = written(_verified(stars, texts, threshold), "links")
    more = written(_across(told, texts, components(links), threshold), "links")
    return components(links.union(more))


def _fetched(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """The lines whose ``node`` is one of ``wanted``, which holds each once, with its columns.

    Not a semi-join, as Spark would move that below the bitmaps and shuffle all lines for it.
    """
    return _perhaps(lines, wanted).join(wanted, "node")


def _perhaps(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``node`` is wanted and a few others, so that no more of them are shuffled.

    Bitmaps of the hashes of what is wanted are broadcast, 16 to 32 bits for a node up to a bound;
    beyond that more of the others stay.
    """
    maps, bits = 1, 16 * wanted.count()
    while maps < MOST_MAPS and maps * MAP_BITS < bits:
        maps *= 2
    spot = F.pmod(F.xxhash64("node"), F.lit(maps * MAP_BITS))
    in_map = F.pmod(spot, F.lit(MAP_BITS))
    number = F.shiftright(spot, MAP_BITS.bit_length() - 1)
    bitmaps = wanted.groupBy(number.alias("_map")).agg(F.bitmap_construct_agg(in_map).alias("_bits"))
    byte = F.substring("_bits", F.shiftright(in_map, 3).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(in_map, F.lit(8)).cast("int"))
    found = rows.withColumn("_map", number).join(F.broadcast(bitmaps), "_map").filter(bit == 1)
    return found.select(rows.columns)


def _across(
    members: DataFrame, texts: DataFrame, roots: DataFrame, threshold: float
) -> DataFrame:
    """Links (a, b) between lines of a bucket that are still in different components.

    The test is part of the join's condition, so that only links become rows. Sketches rule out
    most pairs, whose number grows with the square of a bucket's lines. Of the others it first
    asks whether an earlier bucket holds both lines, and only then compares their shingle sets.
    """
    placed = members.select("bucket", "node", "first").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    # Every line has been compared with the first one of its buckets.
    rest = placed.filter(F.col("node") != F.col("first")).select("bucket", "node", "root")
    several = (
        rest.groupBy("bucket").agg(
            F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("lines")
        )
        .filter(F.col("x") < F.col("y")).select("bucket", "lines")
    )
    rest = written(rest.join(several, "bucket"), "open")
    shared = written(
        rest.groupBy("node").agg(
            F.sort_array(F.collect_set("bucket")).alias("keys"),
            F.sum(F.col("lines") - 1).alias("neighbours"),
        ),
        "open",
    )
    opened = written(_fetched(texts, shared), "open")
    # Rows carry the line, a tenth of its set of hashes in size.
    every = rest.join(written(_sketched(opened), "open"), "node")
    first_shared = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.bucket")
    near = F.least("x.n", "y.n") >= F.lit(threshold) * F.greatest("x.n", "y.n") - 1e-9
    common = F.size(F.array_intersect(_hashes(F.col("x.line")), _hashes(F.col("y.line"))))
    alike = _reached(common, F.col("x.n") + F.col("y.n"), threshold)
    return every.alias("x").join(
        every.alias("y"),
        (F.col("x.bucket") == F.col("y.bucket"))
        & (F.col("x.root") < F.col("y.root"))
        & near
        & _perhaps_alike("x", "y", threshold)
        & first_shared
        & alike,
    ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def line_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (row_id, doc_id, n_lines, dropped), one per row of ``docs``.

    ``dropped`` lists the numbers (from 0) of the lines that go, ascending. Of equal or linked
    lines the one with the smallest doc_id (null last), then the least hash of the whole text, then
    the earliest line, stays, however the files lie.
    Lines without a character other than white space always stay. A line shorter than a shingle
    is one shingle as a whole, so a copy of equal lines only. A null text has no lines, an empty one has one. Rows that
    repeat are documents of their own, so the lines of the second go. Columns other than doc_id
    and text are not read; an empty table gives no rows.
    """
    keyed = written(_keyed(_numbered(docs)), "lines")
    rows = keyed.filter(F.coalesce("line_no", F.lit(0)) == 0)
    lines = keyed.filter(F.col("node").isNotNull()).drop("keys")
    roots = _linked(docs, keyed, threshold)
    classed = lines.join(roots, "node", "left").select(
        "row_id", "doc_id", "told", "line_no", F.coalesce("root", "node").alias("class")
    )
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "told", "row_id", "line_no")
    firsts = (
        classed.groupBy("class").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("class", F.col("first.row_id").alias("_row"), F.col("first.line_no").alias("_line"))
    )
    gone = (
        classed.join(firsts, "class")
        .filter((F.col("row_id") != F.col("_row")) | (F.col("line_no") != F.col("_line")))
        .groupBy("row_id").agg(F.sort_array(F.collect_list("line_no")).alias("dropped"))
    )
    return rows.select("row_id", "doc_id", "n_lines").join(
        gone, "row_id", "left"
    ).withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))


def deduplicated_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without the lines that go; a text that loses all its lines becomes empty.

    Other columns stay as they are, also n_chars. See ``line_classes``.
    """
    rows = written(docs.withColumn("_row_id", F.monotonically_increasing_id()), "texts")
    gone = line_classes(rows.select(F.col("_row_id").alias("doc_id"), "text"), threshold).filter(
        F.size("dropped") > 0
    ).select(F.col("doc_id").alias("_row_id"), "dropped")
    lines = F.split("text", "\n", -1)
    kept = F.filter(
        F.transform(lines, lambda x, i: F.struct(x.alias("line"), i.alias("i"))),
        lambda s: ~F.array_contains("dropped", s["i"]),
    )
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda s: s["line"]), "\n")
    )
    return rows.join(gone, "_row_id", "left").withColumn("text", text).select(docs.columns)


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_lines, n_dropped, and dropped line numbers."""
    docs = table(spark, sf_dir, "documents")
    return line_classes(docs).select(
        "doc_id", "n_lines", F.size("dropped").alias("n_dropped"),
        F.array_join("dropped", ",").alias("dropped"),
    )
