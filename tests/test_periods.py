"""Period starts, against the offset arithmetic they were published with."""

from __future__ import annotations

import calendar
from datetime import date, timedelta

from pyspark.sql import functions as F

from tidecube.operators.users import pair_bits, period_bits
from tidecube.plans.periods import PAIRS, Periods
from tidecube.plans.staged import period_starts

LAUNCH = date(1996, 1, 20)
DAYS = [date(1995, 12, 25) + timedelta(days=i) for i in range(366 * 7)]


def published_starts(base: date) -> dict[str, date]:
    """Starts by month and year offsets that depend on the base day."""
    months_back = 2 if base.day == 1 else 1
    years_back = 1 if base.year != (base - timedelta(days=1)).year else 0
    month = base.month - 1 - months_back
    year, month = base.year + month // 12, month % 12 + 1
    back = date(year, month, min(base.day, calendar.monthrange(year, month)[1]))
    end_of_back = back.replace(day=calendar.monthrange(back.year, back.month)[1])
    moved = base - timedelta(days=months_back)
    of_year = (base - timedelta(days=years_back)).year
    return {
        "DTH": base - timedelta(days=1),
        "MTD": end_of_back + timedelta(days=1),
        "2MTD": date(moved.year, (moved.month - 1) // 2 * 2 + 1, 1),
        "QTD": date(moved.year, (moved.month - 1) // 3 * 3 + 1, 1),
        "SemiYTD": date(moved.year, (moved.month - 1) // 6 * 6 + 1, 1),
        "YTD": date(of_year, 1, 1),
        "2YTD": date(of_year - 1, 1, 1),
        "3YTD": date(of_year - 2, 1, 1),
        "FeatureLaunchedTD": LAUNCH,
    }


def test_every_day_of_seven_years():
    for base in DAYS:
        periods = Periods(base, LAUNCH, two_month=True)
        assert {p: periods.start(p) for p in periods.names} == published_starts(base), base


def test_spark_expressions_agree(spark):
    days = spark.createDataFrame([(d,) for d in DAYS], "BaseDay date")
    for row in period_starts(days, LAUNCH).collect():
        wanted = published_starts(row.BaseDay)
        assert {p: row[f"Start{p}"] for p in wanted} == wanted


def test_spark_expressions_ignore_the_session_time_zone(spark):
    """Hours that a zone skips or repeats must not move."""
    from tidecube.functions.dates import date_hour, minute_boundaries

    zone = spark.conf.get("spark.sql.session.timeZone")
    query = """SELECT timestamp_ntz'2021-03-28 01:59:59' AS a, timestamp_ntz'2021-03-28 02:30:10' AS b
               UNION ALL SELECT timestamp_ntz'2021-10-31 00:00:59', timestamp_ntz'2021-10-31 04:00:00'"""
    results = []
    try:
        for name in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            hours = spark.sql(query).select(
                date_hour(F.col("b")).cast("string").alias("hour"),
                minute_boundaries(F.col("a"), F.col("b")).alias("minutes"),
            )
            results.append([tuple(r) for r in hours.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert results[0] == [("2021-03-28 02:00:00", 31), ("2021-10-31 04:00:00", 240)]
    assert results.count(results[0]) == 3


def test_segments_tell_every_period_apart():
    for base in DAYS[::11]:
        periods = Periods(base, LAUNCH, two_month=True)
        segments = periods.segments()
        for day in (base - timedelta(days=n) for n in (2, 20, 45, 100, 200, 400, 800, 1200)):
            if day < LAUNCH:
                continue
            index = max(i for i, s in enumerate(segments) if s <= day)
            for period in periods.names:
                inside = day >= periods.first_day(period)
                assert bool(period_bits(periods, period) >> index & 1) == inside
            for pair in PAIRS:
                inside = periods.first_day(pair.long) <= day < periods.first_day(pair.short)
                assert bool(pair_bits(periods, pair.long, pair.short) >> index & 1) == inside
