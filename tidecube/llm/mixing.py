"""Mixing sources to target weights by weighted fair queueing.

Every source offers its documents in a shuffled order, over again for further passes. A document
gets a virtual finish time: the words its source has offered up to and with it, divided by the
source's target. Sorted by that time, all sources advance at their weights. The words finished
by virtual time one are the targets, and these add up to the budget, so the mix is cut there: a
document in service at that moment, at most one per source, gives its first words only.

Sorted by finish time over ranges, the words before a document in the whole mix are the sums of the
earlier ranges and those before it in its own.

The cumulative sums never put a source into one task: documents are dealt to slices of the
shuffled order, slices are summed first, and each slice continues from the slices before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import table, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
PASSES = 2
SLICE_DIGITS = 3
ORDER = ("finish", "source", "pass", "first")


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size).

    Sources by code point, null last, take ``weights`` in turn and share ``budget`` times all
    sizes. No target exceeds ``passes`` times its source's size; what is over goes to the others
    by weight until none exceeds it. With sources sorted by size per weight, those up to some
    place are full and the rest share what remains, so the level, words per weight, is found
    without iterating. The table has a row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    listed = sizes.withColumn(
        "_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    ).withColumn("_most", F.col("source_size") * float(passes))
    whole = Window.partitionBy(F.lit(0))
    by_ratio = Window.orderBy(F.col("_most") / F.col("_weight"), F.col("source").isNull(), "source")
    fuller = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(whole) * float(budget)
        - F.coalesce(F.sum("_most").over(fuller), F.lit(0.0))
    ) / F.sum("_weight").over(rest)
    # The level rises while full sources leave the sum and falls after the first that is not full.
    share = F.max(level).over(whole)
    return (
        listed.withColumn("target", F.least(F.col("_most"), share * F.col("_weight")))
        .select("source", "source_size", "target")
    )


def served(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
    seed: str = "mix",
) -> DataFrame:
    """Adds size, source_size, target and ``first`` to the rows of ``docs``.

    ``first`` is the number of words that the source offers before this document in a pass. The
    order depends on doc_id and ``seed`` alone, so reruns agree. Rows with one doc_id in one
    source follow each other by size; equal ones are interchangeable. A null text has no words,
    a null source is a source of its own. Other columns are handed on, unless they bear one of
    the four names, which are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "first")
    return _served(docs.withColumn("size", size_of(F.col("text"))), weights, budget, passes, seed)


def _served(
    sized: DataFrame, weights: tuple[float, ...], budget: float, passes: int, seed: str
) -> DataFrame:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = sized.withColumn("_order", digest)
    rows = rows.withColumn("_slice", F.substring("_order", 1, SLICE_DIGITS))
    per_slice = rows.groupBy("source", "_slice").agg(F.sum("size").alias("_slice_size"))
    wanted = targets(
        per_slice.groupBy("source").agg(F.sum("_slice_size").alias("source_size")),
        weights, budget, passes,
    )
    before = Window.partitionBy("source").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_slice.select(
        "source", "_slice", F.coalesce(F.sum("_slice_size").over(before), F.lit(0)).alias("_base")
    )
    known = offsets.alias("o").join(wanted.alias("w"), F.expr("o.source <=> w.source")).select(
        F.col("o.source").alias("_of"), F.col("o._slice").alias("_in"), "o._base",
        "w.source_size", "w.target",
    )
    within = Window.partitionBy("source", "_slice").orderBy("_order", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ahead = F.coalesce(F.sum("size").over(within), F.lit(0))
    return (
        rows.withColumn("first", ahead)
        .join(known, F.expr("source <=> _of AND _slice = _in"))
        .withColumn("first", F.col("first") + F.col("_base"))
        .drop("_of", "_in", "_base", "_order", "_slice")
    )


def words_taken(passes: Column) -> Column:
    """Words that the mix takes of a document in one pass (from 0): those served by time one."""
    first = F.col("first") + passes * F.col("source_size")
    left = F.floor(F.col("target")).cast("long") - first
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))


def fair_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
    seed: str = "mix",
) -> DataFrame:
    """The mix: a row per document and pass of which words are taken.

    Adds size, source_size, target, first, pass, words (the number taken, from the document's
    beginning) and finish, the virtual finish time. Nothing is taken of documents without words,
    and without documents the result is empty. Null texts, sources and ids: see ``served``.
    """
    return _mixed(served(docs, weights, budget, passes, seed), passes)


def _mixed(offered: DataFrame, passes: int) -> DataFrame:
    every = offered.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    upto = F.col("first") + F.col("pass") * F.col("source_size") + F.col("size")
    return (
        every.withColumn("words", words_taken(F.col("pass")))
        .filter(F.col("words") > 0)
        .withColumn("finish", upto / F.col("target"))
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """Sorts a mix by virtual finish time, range-partitioned; ties go by source and its order."""
    return mixed.orderBy(*ORDER)


def positions(mixed: DataFrame) -> DataFrame:
    """Adds ``position``, the words of the mix before the row, to a mix that is sorted and written.

    Each range is one task of the sort, so its running sum is one too; a row per range is summed up
    over all of them. Texts should not be among the columns.
    """
    sorted_rows = written(in_order(mixed).withColumn("_range", F.spark_partition_id()), "mix")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sorted_rows.groupBy("_range").agg(F.sum("words").alias("_words")).select(
        "_range", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_base")
    )
    before = Window.partitionBy("_range").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sorted_rows.withColumn("position", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .join(bases, "_range")
        .withColumn("position", F.col("position") + F.col("_base"))
        .drop("_range", "_base")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents, in its order: a row per pass that takes any words, with those words.

    A document in service when the budget ends keeps its first words. n_chars, if there is such
    a column, follows the text.
    """
    cut = F.when(F.col("words") < F.col("size"), first_words(F.col("text"), F.col("words")))
    mixed = in_order(fair_mix(docs).withColumn("text", F.coalesce(cut, F.col("text"))))
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast("long"))
    return mixed.select(docs.columns)


def first_words(text: Column, count: Column) -> Column:
    """The text up to and with its ``count``-th word; all of it if there are no more."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), count.cast("int")), "")


def document_shares(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
    seed: str = "mix",
) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken, position), one per row of ``docs``.

    ``taken`` is the number of words that the mix takes over all passes, ``position`` the words of
    the mix before the document's first ones, null if it has none there. Texts are read once. Null
    texts, sources and ids, and repeated rows: see ``served``.
    """
    sizes = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"))
    sized = written(sizes, "sizes")
    offered = written(_served(sized, weights, budget, passes, seed), "offered")
    shares = positions(_mixed(offered, passes)).groupBy("source", "first").agg(
        F.sum("words").alias("taken"), F.min("position").alias("position")
    )
    # In a source, documents with words differ in the words before them.
    own = shares.select(F.col("source").alias("_of"), F.col("first").alias("_at"), "taken", "position")
    return offered.join(
        own, F.expr("size > 0 AND first = _at AND source <=> _of"), "left"
    ).select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "position",
    )


def op10_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of ``documents``: doc_id, size, source_size, target, taken, position."""
    return document_shares(table(spark, sf_dir, "documents"))


SQL = f"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
placed AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead,
    CAST(sum(size) OVER (PARTITION BY source) AS BIGINT) AS source_size FROM rows),
listed AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS most,
    CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3
      WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
  FROM (SELECT DISTINCT source, source_size FROM placed)),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER (
      ORDER BY most / weight, source IS NULL, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (
      ORDER BY most / weight, source IS NULL, source
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM listed),
aims AS (
  SELECT source, least(most, max(level) OVER () * weight) AS target FROM levels),
passes AS (
  SELECT doc_id, placed.source, size, ahead, p, (ahead + p * source_size + size) / target AS finish,
    greatest(0, least(size, CAST(floor(target) AS BIGINT) - ahead - p * source_size)) AS words
  FROM placed JOIN aims ON placed.source IS NOT DISTINCT FROM aims.source, (VALUES (0), (1)) v(p)),
mix AS (
  SELECT *, coalesce(sum(words) OVER (ORDER BY finish, source NULLS FIRST, p, ahead
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position FROM passes WHERE words > 0),
shares AS (
  SELECT source, ahead, sum(words) AS taken, min(position) AS position FROM mix GROUP BY source, ahead)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken,
  CAST(position AS BIGINT) AS position
FROM placed JOIN aims ON placed.source IS NOT DISTINCT FROM aims.source
LEFT JOIN shares ON size > 0 AND placed.ahead = shares.ahead
  AND placed.source IS NOT DISTINCT FROM shares.source"""
