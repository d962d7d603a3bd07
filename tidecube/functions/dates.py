"""Date and time expressions over zone-free timestamps.

``date_trunc`` returns a zoned timestamp even for ``timestamp_ntz`` input, so the
truncations here are built from the date and the hour. The results are then the
same whatever the session time zone is.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def midnight(day: date) -> Column:
    """Literal ``day`` at 00:00 as ``timestamp_ntz``; folds, so filters push down."""
    return F.expr(f"timestamp_ntz'{day.isoformat()} 00:00:00'")


def day_of(ts: Column) -> Column:
    return ts.cast("date")


def hour_of(ts: Column, hour_offset: int = 0) -> Column:
    """Hour of day, optionally shifted; the date is not shifted with it."""
    if hour_offset:
        ts = ts + F.make_dt_interval(F.lit(0), F.lit(hour_offset))
    return F.hour(ts)


def date_hour(ts: Column, hour_offset: int = 0) -> Column:
    """``ts`` truncated to its hour."""
    return day_of(ts).cast(NTZ) + F.make_dt_interval(F.lit(0), hour_of(ts, hour_offset))


def plus_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours)


def minute_boundaries(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (seconds are ignored)."""

    def minute_of_day(ts: Column) -> Column:
        return (F.hour(ts) * 60 + F.minute(ts)).cast("bigint")

    days = F.datediff(day_of(end), day_of(start)).cast("bigint")
    return days * 1440 + minute_of_day(end) - minute_of_day(start)


def days_between(start: Column, end: Column) -> Column:
    """Day boundaries crossed from ``start`` to ``end``."""
    return F.datediff(day_of(end), day_of(start)).cast("bigint")


def _first_of(ts: Column, months: int) -> Column:
    first_month = ((F.month(ts) - 1) / months).cast("int") * months + 1
    return F.make_date(F.year(ts), first_month, F.lit(1))


def half_year_start(ts: Column) -> Column:
    return _first_of(ts, 6)


def period_start(period: str, ts: Column, launch: date | None = None) -> Column:
    """First day of ``period`` for the day ``ts`` falls on, as a date."""
    if period == "DTH":
        return day_of(ts)
    if period == "FeatureLaunchedTD":
        return F.lit(launch)
    months = {"MTD": 1, "2MTD": 2, "QTD": 3, "SemiYTD": 6}.get(period)
    if months:
        return _first_of(ts, months)
    years_back = {"YTD": 0, "2YTD": 1, "3YTD": 2}[period]
    return F.make_date(F.year(ts) - years_back, F.lit(1), F.lit(1))


def next_multiple_of_months(ts: str, months: str) -> str:
    """First day after ``ts`` that starts a stretch of ``months`` counted from January.

    Stretches longer than a year are counted from the January before ``ts``.
    """
    january = f"make_date(year({ts}), 1, 1)"
    elapsed = f"CAST((month({ts}) - 1) DIV {months} + 1 AS INT)"
    return f"add_months({january}, {elapsed} * {months})"
