"""The cube of one reported day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecube.functions.dates import midnight
from tidecube.operators.accounts import Accounts
from tidecube.operators.activity import Activity
from tidecube.operators.cube import customer_hour_cube
from tidecube.operators.dimensions import copied_levels, copy_levels
from tidecube.operators.enrich import payments
from tidecube.operators.totals import ADDITIVE, hourly_totals
from tidecube.operators.users import activity_patterns, pair_bits, period_bits
from tidecube.plans.columns import published_hours, slot_metrics
from tidecube.plans.options import Options
from tidecube.plans.periods import PAIRS, Periods
from tidecube.sources.inputs import Inputs

BEFORE_DAY = -1
HOURS = 24


def day_totals(
    inputs: Inputs, periods: Periods, options: Options, accounts: Accounts | None = None
) -> DataFrame:
    """Measures per cell, by hour of the day and by segment of the year before it.

    Only this year's transactions matter here. ``Segment`` counts up to the number of
    segments, which stands for the reported day itself.
    """
    rows = payments(
        inputs, periods.first_day("YTD"), periods.base_day, options, "Id", "Amount"
    )
    without = copied_levels(options.dimensions) if inputs.unique_companies else None
    cube = customer_hour_cube(rows, inputs, options, without, accounts)
    hour = F.col("DateHour")
    segments = periods.segments()
    in_day = hour >= midnight(periods.day)
    segment = F.when(in_day, F.lit(len(segments)))
    for i, day in reversed(list(enumerate(segments))):
        segment = segment.when(hour >= midnight(day), F.lit(i))
    placed = cube.withColumns(
        {
            "Segment": segment,
            "Slot": F.when(in_day, F.hour(hour)).otherwise(F.lit(BEFORE_DAY)),
        }
    )
    totals = hourly_totals(placed, options, "Segment", "Slot")
    return copy_levels(totals) if without else totals


def day_users(
    inputs: Inputs, periods: Periods, options: Options, activity: Activity | None = None
) -> DataFrame:
    """Activity patterns, listed before the day and at the hour of first activity.

    With kept activity only the facts of the reported month are read.
    """
    earlier, start = None, periods.launch
    if activity is not None:
        earlier, start = activity.segments(periods, options), periods.first_day("MTD")
    rows = payments(inputs, start, periods.base_day, options)
    patterns = activity_patterns(rows, inputs, periods, options, earlier)
    slots = F.explode(F.array(F.lit(BEFORE_DAY), F.col("FirstHour")))
    return patterns.withColumn("Slot", slots).filter(F.col("Slot").isNotNull())


def _combined(totals: DataFrame, users: DataFrame, periods: Periods, options: Options) -> DataFrame:
    """Increments per cell and slot, from totals and users in one pass."""
    cell = options.dimension_names
    segments = periods.segments()

    def in_period(period: str) -> str:
        """Rows of ``day_totals`` that fall into the period."""
        first = sum(1 for day in segments if day < periods.first_day(period))
        return f"Segment >= {first}"

    def had_activity(bits: int) -> str:
        return f"(Segments & {bits}) != 0"

    sums = {f"{m}Hourly": m for m in ("UU", *ADDITIVE)}
    sums |= {
        f"{m}{p}": f"CASE WHEN {in_period(p)} THEN {m} END"
        for p in periods.calendar
        for m in ADDITIVE
    }
    for p in periods.names:
        # Users from before the day enter at slot -1, the day's new ones at their hour.
        earlier = had_activity(period_bits(periods, p))
        sums[f"UU{p}"] = f"CASE WHEN {earlier} = (Slot = {BEFORE_DAY}) THEN Customers END"
    for p in PAIRS:
        before = had_activity(pair_bits(periods, p.long, p.short))
        sums[p.key] = f"CASE WHEN Slot = {BEFORE_DAY} AND {before} THEN Customers END"
    return (
        totals.unionByName(users, allowMissingColumns=True)
        .repartition(*cell)
        .groupBy(*cell, "Slot")
        .agg(
            *[F.expr(f"sum({value}) AS {name}") for name, value in sums.items()],
            F.max("Segment").alias("Segment"),
        )
    )


def day_slots(
    inputs: Inputs,
    periods: Periods,
    options: Options,
    activity: Activity | None = None,
    accounts: Accounts | None = None,
) -> DataFrame:
    """Every running metric and prior count for each cell and slot with activity.

    Totals and users are gathered by cell and slot, where slot -1 stands for all that
    came before the day. ``_next`` is the cell's next slot.
    """
    cell = ", ".join(options.dimension_names)
    rows = _combined(
        day_totals(inputs, periods, options, accounts),
        day_users(inputs, periods, options, activity),
        periods,
        options,
    )
    ordered = f"PARTITION BY {cell} ORDER BY Slot"
    so_far = f"OVER ({ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    whole = f"OVER ({ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    running = [f"{m}{p}" for p in periods.calendar for m in ADDITIVE]
    running += [f"UU{p}" for p in periods.names]
    return rows.selectExpr(
        *options.dimension_names,
        "Slot",
        *[c for c in rows.columns if c.endswith("Hourly")],
        *[f"coalesce(sum({c}) {so_far}, 0) AS {c}" for c in running],
        *[f"nullif(sum({p.key}) {so_far}, 0) AS {p.key}" for p in PAIRS],
        f"max(Segment) {whole} AS _this_year",
        f"coalesce(lead(Slot) OVER ({ordered}), {HOURS}) AS _next",
    ).filter("_this_year IS NOT NULL")


def daily_cube(
    inputs: Inputs,
    base_day: date,
    launch: date,
    options: Options = Options(),
    activity: Activity | None = None,
    accounts: Accounts | None = None,
) -> DataFrame:
    """The published columns for every hour and cell of the day before ``base_day``.

    With kept ``activity`` the users of closed months come from it and not from facts. ``accounts``
    counts what the joins of the totals do.

    Each slot is repeated for the hours up to the cell's next slot, which fills the
    hours without activity, with no grid to join against.
    """
    periods = Periods(base_day, launch, options.two_month)
    day = f"timestamp_ntz'{periods.day} 00:00:00'"
    hours = (
        day_slots(inputs, periods, options, activity, accounts)
        .selectExpr(
            *options.dimension_names,
            *slot_metrics(periods, options),
            f"{day} + make_dt_interval(0, Slot) AS _own",
            "explode(sequence(greatest(Slot, 0), greatest(Slot, 0, _next - 1))) AS _slot",
            "_next",
        )
        .filter("_slot < _next")
        .withColumn("_hour", F.expr(f"{day} + make_dt_interval(0, _slot)"))
        .drop("_slot", "_next")
    )
    return published_hours(hours, "_own", "_hour", options)
