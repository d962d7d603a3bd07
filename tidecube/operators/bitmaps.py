"""Exact sets of users as bitmaps, by cell and hour.

Customers get dense numbers once. The customers of a cell in an hour are then bits: 32,768
of them in each bucket. Of a bucket only the words of 64 bits that are not zero are kept, since most
hours of a cell have few customers and would otherwise take 4 kilobytes each wherever rows are
sorted. Sets merge by OR of their words, so the distinct users of any window of time, and of any two
windows together, are an OR and a count, and no customer key is read again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecube.functions.dates import date_hour, midnight
from tidecube.operators.dimensions import explode_levels
from tidecube.operators.enrich import with_company
from tidecube.operators.users import running_arrivals
from tidecube.plans.options import Options
from tidecube.plans.periods import PAIRS, Periods
from tidecube.sources.inputs import Inputs

#: A window of days, the last one not included.
Days = tuple[date, date]

# monotonically_increasing_id puts the partition above these bits.
_ROW_BITS = 33

_WORD = 64
_TASKS = 200


def unnumbered(customers: DataFrame, numbers: DataFrame | None) -> DataFrame:
    """Customers without a number, each with a place that is unique but not dense.

    The places hold only once they are written: they follow the partitions of one run.
    """
    keys = customers.select(F.col("Customer_Key").alias("CustomerKey")).filter("CustomerKey IS NOT NULL").distinct()
    if numbers is not None:
        keys = keys.join(numbers.select("CustomerKey"), "CustomerKey", "left_anti")
    return keys.withColumn("Place", F.monotonically_increasing_id())


def numbered(placed: DataFrame, after: int) -> DataFrame:
    """Rows (CustomerKey, Number): dense numbers that begin after ``after``, from written places."""
    part = F.shiftright("Place", _ROW_BITS)
    row = F.col("Place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # A row per partition of the run that made the places.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").select(
        "CustomerKey", (F.col("_start") + row + 1 + after).alias("Number")
    )


def _dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows shuffled by these columns into a number of tasks that stays as it is.

    Adaptive execution merges tasks up to a size in compressed bytes. These rows compress so well
    that a merged task would hold many times the memory it is meant to.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(tasks, _TASKS), *columns)


def hour_bitmaps(
    payments: DataFrame, inputs: Inputs, numbers: DataFrame, options: Options
) -> DataFrame:
    """Rows (cell, DateHour, Bucket, Users): who was active in each hour and cell.

    ``Users`` has the bucket's words that are not zero, in order. A customer's transactions of an
    hour with a company become one row before any join. Facts of unknown customers have no number
    and fall out.
    """
    extra = [d.name for d in options.extra_dimensions]
    hour = date_hour(F.col("CreatedAt"), options.hour_offset).alias("DateHour")
    seen = payments.select("CustomerKey", "CompanyId", *extra, hour).distinct()
    known = with_company(seen, inputs.companies).join(numbers, "CustomerKey")
    place = F.bitmap_bit_position("Number")
    placed = known.select(
        *options.dimension_names, "DateHour", F.bitmap_bucket_number("Number").alias("Bucket"),
        F.floor(place / _WORD).cast("int").alias("Word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(_WORD)).cast("int")).alias("Bits"),
    )
    bucket = [*options.dimension_names, "DateHour", "Bucket"]
    # One shuffle for both steps; before it, next to nothing would merge.
    words = (
        _dealt(explode_levels(placed, options.dimensions), *bucket)
        .groupBy(*bucket, "Word").agg(F.bit_or("Bits").alias("Bits"))
    )
    return words.groupBy(*bucket).agg(
        F.sort_array(F.collect_list(F.struct("Word", "Bits"))).alias("Users")
    )


def _words(bitmaps: DataFrame, cell: list[str]) -> DataFrame:
    """Rows (cell, Bucket, Word, DateHour, Bits), dealt by cell and bucket.

    They are dealt as bitmaps, so that a task holds the words of its own buckets only.
    """
    dealt = _dealt(bitmaps.select(*cell, "Bucket", "DateHour", "Users"), *cell, "Bucket")
    return dealt.select(*cell, "Bucket", "DateHour", F.inline("Users"))


def _within(days: Days) -> Column:
    hour = F.col("DateHour")
    return (hour >= midnight(days[0])) & (hour < midnight(days[1]))


def _merged(bits: Column) -> Column:
    return F.bit_or(F.coalesce(bits, F.lit(0).cast("long")))


def window_users(bitmaps: DataFrame, windows: dict[str, Days], options: Options) -> DataFrame:
    """Distinct users per cell in each window, in one pass over the bitmaps."""
    cell = options.dimension_names
    merged = [
        _merged(F.when(_within(days), F.col("Bits"))).alias(name) for name, days in windows.items()
    ]
    wanted = F.lit(False)
    for days in windows.values():
        wanted = wanted | _within(days)
    by_word = _words(bitmaps.filter(wanted), cell).groupBy(*cell, "Bucket", "Word").agg(*merged)
    return by_word.groupBy(*cell).agg(*[F.sum(F.bit_count(name)).alias(name) for name in windows])


def compared_users(bitmaps: DataFrame, one: Days, other: Days, options: Options) -> DataFrame:
    """Per cell: users of each window, of both, of either, and the share of the first that came
    in the second too (NULL where the first has none)."""
    cell = options.dimension_names
    words = _words(bitmaps.filter(_within(one) | _within(other)), cell)
    by_word = words.groupBy(*cell, "Bucket", "Word").agg(
        _merged(F.when(_within(one), F.col("Bits"))).alias("_one"),
        _merged(F.when(_within(other), F.col("Bits"))).alias("_other"),
        _merged(F.col("Bits")).alias("_either"),
    )
    counts = by_word.groupBy(*cell).agg(
        *[F.sum(F.bit_count(f"_{name}")).alias(name) for name in ("one", "other", "either")]
    )
    both = F.col("one") + F.col("other") - F.col("either")
    return counts.select(
        *cell, F.col("one").alias("UsersFirst"), F.col("other").alias("UsersSecond"),
        F.col("either").alias("UsersEither"), both.alias("UsersBoth"),
        F.try_divide(both.cast("double"), F.col("one").cast("double")).alias("ShareOfFirst"),
    )


def prior_users(bitmaps: DataFrame, periods: Periods, options: Options) -> DataFrame:
    """Per cell with a user this year, a long period's users before the short one began."""
    windows = {
        p.key: (periods.first_day(p.long), max(periods.first_day(p.short), periods.first_day(p.long)))
        for p in PAIRS
    }
    windows["_this_year"] = (periods.first_day("YTD"), periods.base_day)
    counted = window_users(bitmaps, windows, options).filter(F.col("_this_year") > 0)
    nothing = F.lit(0).cast("long")
    return counted.select(
        *options.dimension_names, *[F.nullif(F.col(p.key), nothing).alias(p.key) for p in PAIRS]
    )


def running_users(bitmaps: DataFrame, periods: Periods, options: Options) -> DataFrame:
    """Distinct users so far in every period, at the hours where a new one appears.

    Words are merged in the order of hours within a cell, which spreads even the overall cell; how
    far a word's count grew in an hour is what the hour brought.
    """
    cell = options.dimension_names
    so_far = Window.partitionBy(*cell, "Bucket", "Word").orderBy("DateHour")
    until_now = so_far.rowsBetween(Window.unboundedPreceding, 0)
    counts = _words(bitmaps, cell).select(
        *cell, "Bucket", "Word", "DateHour",
        *[
            F.bit_count(
                _merged(
                    F.when(F.col("DateHour") >= midnight(periods.first_day(p)), F.col("Bits"))
                ).over(until_now)
            ).alias(p)
            for p in periods.names
        ],
    )
    grown = counts.select(
        *cell, "DateHour",
        *[(F.col(p) - F.coalesce(F.lag(p).over(so_far), F.lit(0))).alias(p) for p in periods.names],
    )
    arrivals = (
        grown.unpivot([*cell, "DateHour"], list(periods.names), "_period", "_grown")
        .filter(F.col("_grown") > 0)
        .groupBy(*cell, "_period", "DateHour")
        .agg(F.sum("_grown").alias("_new"))
    )
    return running_arrivals(arrivals, periods, options)
