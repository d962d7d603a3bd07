"""Keeping the activity of closed months beside the target, and days computed with it."""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidecube.operators.activity import Activity, advanced, extra_names, first_of_month, month_bits, month_number
from tidecube.operators.enrich import payments
from tidecube.plans.daily import daily_cube
from tidecube.plans.job import DEFAULT_LAUNCH, Writer, warn_of_uncompiled_methods
from tidecube.plans.options import Options
from tidecube.sources import commits
from tidecube.sources.inputs import Inputs
from tidecube.sources.target import write_days


def _note(launch: date, options: Options) -> str:
    return json.dumps({"launch": launch.isoformat(), "dimensions": sorted(extra_names(options))})


def kept_activity(
    spark: SparkSession, store: str, launch: date, options: Options, until: date
) -> Activity | None:
    """The newest kept activity that covers no more than the months before ``until``."""
    note = _note(launch, options)
    found = [e for e in commits.entries(spark, store, last=until) if e.note == note]
    if not found:
        return None
    rows = commits.read_entries(spark, found[-1:]).drop(commits.DAY)
    return Activity(rows, launch, found[-1].day, tuple(extra_names(options)))


def keep_activity(
    inputs: Inputs,
    base_day: date,
    store: str,
    launch: date = DEFAULT_LAUNCH,
    options: Options = Options(),
    afresh: bool = False,
) -> Activity:
    """Brings the kept activity up to the month that ``base_day`` reports on, and returns it.

    Facts are read from where the kept rows end, from the launch if there are none, and not at all
    if nothing is missing. The new rows are a snapshot of their own, committed in one step. With
    ``afresh`` they are made from all facts, as is needed after changes in closed months.
    """
    spark = inputs.transactions.sparkSession
    until = first_of_month(month_number(base_day - timedelta(days=1)))
    old = None if afresh else kept_activity(spark, store, launch, options, until)
    if old and old.until == until:
        return old
    start = max(old.until, launch) if old else launch
    facts = payments(inputs, min(start, until), until, options)
    if old:
        rows = advanced(old, facts, options, until)
    else:
        rows = month_bits(facts, options, until)
    dated = rows.withColumn(commits.DAY, F.lit(until))
    folder, counts = commits.stage(dated, store)
    commits.publish(spark, store, [until], folder, counts, dated.schema, _note(launch, options))
    return kept_activity(spark, store, launch, options, until)


def run_kept_day(
    inputs: Inputs,
    base_day: date,
    target: str,
    store: str,
    launch: date = DEFAULT_LAUNCH,
    options: Options = Options(),
    write: Writer = write_days,
) -> dict[date, int]:
    """As ``run_day``; users before the reported month come from the activity kept in ``store``."""
    warn_of_uncompiled_methods(inputs.transactions.sparkSession)
    activity = keep_activity(inputs, base_day, store, launch, options)
    day = base_day - timedelta(days=1)
    return write(daily_cube(inputs, base_day, launch, options, activity), target, day, day)
