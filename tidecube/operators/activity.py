"""Kept activity: in which months each customer was active with each company.

A distinct count over years needs to know who was active when, not what the facts were. A kept
row has one bit per month for a customer and company (and further dimensions), so it stays one
row however many years go by. Rows merge by OR: a closed month is added once, from its facts, and
a day's cube then reads the facts of its own month only.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecube.functions.dates import midnight
from tidecube.plans.options import Options
from tidecube.plans.periods import Periods

# Months that have a bit of their own, counted back from the last one kept. One more bit says
# whether there was anything before them.
MONTHS = 60
BEFORE = 1 << MONTHS


def month_number(day: date) -> int:
    return day.year * 12 + day.month - 1


def first_of_month(number: int) -> date:
    return date(number // 12, number % 12 + 1, 1)


@dataclass(frozen=True)
class Activity:
    """Kept rows (CustomerKey, CompanyId, further dimensions, Months).

    They cover the facts from ``launch`` up to the first of the month ``until``. Bit k of
    ``Months`` is the month k before the last one covered.
    """

    rows: DataFrame
    launch: date
    until: date
    dimensions: tuple[str, ...] = ()

    def _bits(self, first: date, end: date) -> int:
        """Bits of the months from ``first``'s up to ``end``'s, ``end`` not included."""
        last = month_number(self.until) - 1
        newest, oldest = last - (month_number(end) - 1), last - month_number(first)
        if newest < 0:
            raise ValueError(f"months from {first} to {end} are not kept")
        bits = sum(1 << k for k in range(newest, min(oldest + 1, MONTHS)))
        if first == self.launch:
            bits |= BEFORE
        elif oldest >= MONTHS:
            raise ValueError(f"{first} is more than {MONTHS} months before {self.until}")
        if newest >= MONTHS:
            raise ValueError(f"{end} is more than {MONTHS} months before {self.until}")
        return bits

    def segments(self, periods: Periods, options: Options) -> DataFrame:
        """Rows (CustomerKey, CompanyId, further dimensions, Segments) of the months before the
        reported day's own one.

        Periods start with a month, but for the launch, before which there are no facts, so every
        month lies in one segment.
        """
        if self.launch != periods.launch or set(self.dimensions) != set(extra_names(options)):
            raise ValueError("the kept activity is of another launch or of other dimensions")
        month = periods.day.replace(day=1)
        if month > self.until:
            raise ValueError(f"activity is kept up to {self.until}, not up to {month}")
        starts = [d for d in periods.segments() if d < month]
        ends = [*starts[1:], month][: len(starts)]
        parts = [
            F.when(F.col("Months").bitwiseAND(F.lit(self._bits(first, end))) != 0, F.lit(1 << i))
            .otherwise(F.lit(0))
            for i, (first, end) in enumerate(zip(starts, ends, strict=True))
        ]
        segments = sum(parts, F.lit(0)).cast("int")
        keys = ["CustomerKey", "CompanyId", *extra_names(options)]
        return self.rows.select(*keys, segments.alias("Segments")).filter(F.col("Segments") != 0)


def extra_names(options: Options) -> list[str]:
    return [d.name for d in options.extra_dimensions]


def month_bits(payments: DataFrame, options: Options, until: date) -> DataFrame:
    """Kept rows of transactions before ``until``, the first of a month.

    One partial sum per customer and company leaves each task, however many facts they have.
    """
    created = F.col("CreatedAt")
    back = F.lit(month_number(until) - 1) - (F.year(created) * 12 + F.month(created) - 1)
    bit = F.when(
        back < MONTHS, F.call_function("shiftleft", F.lit(1).cast("long"), F.least(back, F.lit(MONTHS)))
    )
    return (
        payments.filter(created < midnight(until))
        .groupBy("CustomerKey", "CompanyId", *extra_names(options))
        .agg(F.bit_or(bit.otherwise(F.lit(BEFORE))).alias("Months"))
    )


def moved(months: Column, by: int) -> Column:
    """Bits counted from ``by`` months later; those that leave the range become one."""
    if by == 0:
        return months
    if by > MONTHS:
        return F.when(months != 0, F.lit(BEFORE)).otherwise(F.lit(0))
    staying = (1 << (MONTHS - by)) - 1
    leaving = (1 << (MONTHS + 1)) - 1 - staying
    gone = F.when(months.bitwiseAND(F.lit(leaving)) != 0, F.lit(BEFORE)).otherwise(F.lit(0))
    return F.shiftleft(months.bitwiseAND(F.lit(staying)), by).bitwiseOR(gone)


def advanced(activity: Activity, payments: DataFrame, options: Options, until: date) -> DataFrame:
    """Kept rows up to ``until``: those of ``activity`` and transactions since then."""
    by = month_number(until) - month_number(activity.until)
    keys = ["CustomerKey", "CompanyId", *extra_names(options)]
    old = activity.rows.select(*keys, moved(F.col("Months"), by).alias("Months"))
    new = month_bits(payments, options, until).select(*keys, "Months")
    return old.unionByName(new).groupBy(*keys).agg(F.bit_or("Months").alias("Months"))
