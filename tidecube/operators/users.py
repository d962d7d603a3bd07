"""Running distinct users per cell.

A customer counts once in a period, at the first hour of activity, so the distinct
users so far are a running sum of first appearances. First appearances are minima, and
minima combine: they are taken per customer and company first, which shrinks each
customer's history map-side, and only then lifted to the cube levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecube.functions.dates import date_hour, hour_of, midnight
from tidecube.operators.dimensions import copied_levels, copy_levels, explode_levels
from tidecube.operators.enrich import of_known_customers, with_company
from tidecube.plans.options import Options
from tidecube.plans.periods import Periods
from tidecube.sources.inputs import Inputs


def customer_cells(
    payments: DataFrame,
    inputs: Inputs,
    options: Options,
    states: dict[str, tuple[Column, object]],
    keys: tuple[str, ...] = (),
    earlier: DataFrame | None = None,
    without: list[int] | None = None,
) -> DataFrame:
    """Per customer and cell (and ``keys``), the given combinable aggregates.

    ``states`` maps a column to an expression over transactions and the aggregate,
    such as ``F.min``, that both reduces it and merges two results. ``earlier`` has rows per
    customer and company that were reduced before; columns it lacks are NULL. Cube
    levels in ``without`` are left out.
    """
    extra = [d.name for d in options.extra_dimensions]
    finest = payments.groupBy("CustomerKey", "CompanyId", *extra, *keys).agg(
        *[merge(value).alias(name) for name, (value, merge) in states.items()]
    )
    if earlier is not None:
        finest = finest.unionByName(earlier, allowMissingColumns=True)
    known = of_known_customers(with_company(finest, inputs.companies), inputs.customers)
    return (
        explode_levels(known, options.dimensions, without)
        .groupBy("CustomerKey", *options.dimension_names, *keys)
        .agg(*[merge(F.col(name)).alias(name) for name, (_, merge) in states.items()])
    )


def first_hours(
    payments: DataFrame, inputs: Inputs, periods: Periods, options: Options
) -> DataFrame:
    """Per customer and cell, the first hour of activity in every period."""
    hour = date_hour(F.col("CreatedAt"), options.hour_offset)
    states = {
        p: (F.when(F.col("CreatedAt") >= midnight(periods.first_day(p)), hour), F.min)
        for p in periods.names
    }
    return customer_cells(payments, inputs, options, states)


def running_users(firsts: DataFrame, periods: Periods, options: Options) -> DataFrame:
    """Distinct users so far, at the hours where a new one appears.

    A period's column is NULL at hours that bring no new user to that period.
    """
    cell = options.dimension_names
    arrivals = (
        firsts.unpivot(cell, list(periods.names), "_period", "DateHour")
        .filter(F.col("DateHour").isNotNull())
        .groupBy(*cell, "_period", "DateHour")
        .agg(F.count(F.lit(1)).alias("_new"))
    )
    return running_arrivals(arrivals, periods, options)


def running_arrivals(arrivals: DataFrame, periods: Periods, options: Options) -> DataFrame:
    """Running sums of the new users of each cell, period and hour, a column per period."""
    cell = options.dimension_names
    window = (
        Window.partitionBy(*cell, "_period")
        .orderBy("DateHour")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = arrivals.repartition(*cell).withColumn("_users", F.sum("_new").over(window))
    return running.groupBy("DateHour", *cell).agg(
        *[
            F.max(F.when(F.col("_period") == p, F.col("_users"))).alias(f"UU{p}")
            for p in periods.names
        ]
    )


def _segment_bits(periods: Periods, first, before=None) -> int:
    """Bits of the segments from day ``first`` on, up to day ``before``."""
    return sum(
        1 << i
        for i, day in enumerate(periods.segments())
        if day >= first and (before is None or day < before)
    )


def period_bits(periods: Periods, period: str) -> int:
    """Segments before the reported day that belong to ``period``."""
    return _segment_bits(periods, periods.first_day(period))


def pair_bits(periods: Periods, long: str, short: str) -> int:
    """Segments of ``long`` that lie before ``short`` begins."""
    return _segment_bits(periods, periods.first_day(long), periods.first_day(short))


def activity_patterns(
    payments: DataFrame,
    inputs: Inputs,
    periods: Periods,
    options: Options,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Customers per cell, grouped by when they were active.

    For one reported day, all running user counts and all prior-period counts follow
    from two facts about each customer and cell: which segments of history had any
    activity (a bit each) and the first active hour of the day. Bits and the hour
    merge by OR and minimum, so no period needs a pass of its own. ``earlier`` has the segments
    of customers and companies before ``payments`` begin, where these are kept.
    """
    created = F.col("CreatedAt")
    in_day = created >= midnight(periods.day)
    segment = F.when(in_day, F.lit(0))
    for i, day in reversed(list(enumerate(periods.segments()))):
        segment = segment.when(created >= midnight(day), F.lit(1 << i))
    states = {
        "Segments": (segment, F.bit_or),
        "FirstHour": (F.when(in_day, hour_of(created, options.hour_offset)), F.min),
    }
    without = copied_levels(options.dimensions) if inputs.unique_companies else None
    cells = customer_cells(payments, inputs, options, states, (), earlier, without)
    counted = cells.groupBy(*options.dimension_names, "Segments", "FirstHour").agg(
        F.count(F.lit(1)).alias("Customers")
    )
    return copy_levels(counted) if without else counted
