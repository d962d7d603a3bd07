"""The target kept as change points: a row per cell and stretch of hours in which nothing happens.

What a cell reports stays as it is until its next active hour. So a row holds from one hour to
another, and a quiet day of a cell is one row instead of twenty-four. Readers choose days and
cells first and expand the hours of what is left.
"""

from __future__ import annotations

import json
from dataclasses import asdict
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecube.operators.activity import Activity
from tidecube.plans.backfill import range_rows
from tidecube.plans.columns import published_hours, slot_metrics
from tidecube.plans.daily import day_slots
from tidecube.plans.job import DEFAULT_LAUNCH
from tidecube.plans.options import Options
from tidecube.plans.periods import Periods
from tidecube.sources import commits
from tidecube.sources.inputs import Inputs

# The hour whose activity a row tells, and the hours that it holds, the last one not included.
OWN, FROM, TO = "OwnHour", "FromHour", "ToHour"


def day_changes(
    inputs: Inputs,
    base_day: date,
    launch: date,
    options: Options = Options(),
    activity: Activity | None = None,
) -> DataFrame:
    """The change points of the day before ``base_day``."""
    periods = Periods(base_day, launch, options.two_month)
    midnight = f"timestamp_ntz'{periods.day} 00:00:00'"

    def at(hour: str) -> str:
        return f"{midnight} + make_dt_interval(0, {hour})"

    return day_slots(inputs, periods, options, activity).filter("greatest(Slot, 0) < _next").selectExpr(
        *options.dimension_names, f"{at('Slot')} AS {OWN}", f"{at('greatest(Slot, 0)')} AS {FROM}",
        f"{at('_next')} AS {TO}", *slot_metrics(periods, options),
    )


def range_changes(
    inputs: Inputs, first: date, last: date, launch: date, options: Options = Options()
) -> DataFrame:
    """The change points of the days ``first`` to ``last``; every day begins with rows of its own."""
    periods = Periods(last + timedelta(days=1), launch, options.two_month)
    day_end = "CAST(date_add(CAST(DateHour AS DATE), 1) AS TIMESTAMP_NTZ)"
    return range_rows(inputs, first, last, launch, options).selectExpr(
        *options.dimension_names, f"DateHour AS {OWN}", f"DateHour AS {FROM}",
        f"least(coalesce(_next, {day_end}), {day_end}) AS {TO}", *slot_metrics(periods, options),
    )


def expanded(changes: DataFrame, options: Options = Options()) -> DataFrame:
    """The published columns for every hour that change points hold."""
    hours = changes.selectExpr(
        f"explode(sequence({FROM}, {TO} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS _hour",
        *[c for c in changes.columns if c not in (FROM, TO)],
    )
    return published_hours(hours, OWN, "_hour", options)


def _note(options: Options) -> str:
    return json.dumps(asdict(options), sort_keys=True)


def keep_changes(
    changes: DataFrame, store: str, first: date, last: date, options: Options = Options()
) -> dict[date, int]:
    """Replaces the days ``first`` to ``last`` of a store by their change points, in one step.

    Returns the rows per day.
    """
    cells = options.dimension_names
    dated = changes.withColumn(commits.DAY, F.to_date(FROM))
    rows = dated.hint("rebalance", commits.DAY).sortWithinPartitions(commits.DAY, *cells, FROM)
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    folder, counts = commits.stage(rows, store)
    commits.publish(changes.sparkSession, store, days, folder, counts, dated.schema, _note(options))
    return dict.fromkeys(days, 0) | counts


def run_changes(
    inputs: Inputs,
    first: date,
    last: date,
    store: str,
    launch: date = DEFAULT_LAUNCH,
    options: Options = Options(),
) -> dict[date, int]:
    """Computes the days ``first`` to ``last`` in one job and keeps their change points."""
    return keep_changes(range_changes(inputs, first, last, launch, options), store, first, last, options)


def read_changes(
    spark: SparkSession,
    store: str,
    first: date,
    last: date,
    options: Options = Options(),
    **members: int | str,
) -> DataFrame:
    """The published columns of the given days and dimension members, hour by hour.

    Days choose folders and members reach the scan, so only the rows wanted are expanded.
    """
    found = commits.entries(spark, store, first, last)
    if other := {e.note for e in found} - {_note(options)}:
        raise ValueError(f"days are kept with {sorted(other)}, not with {_note(options)}")
    rows = commits.read_days(spark, store, first, last, **members)
    return expanded(rows.drop(commits.DAY), options)
