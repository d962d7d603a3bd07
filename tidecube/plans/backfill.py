"""The cubes of a range of reported days in one job.

The result equals that of ``daily_cube`` run once per day, but the facts are read and
shuffled once for the whole range.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecube.functions.dates import (
    NTZ,
    date_hour,
    midnight,
    next_multiple_of_months,
    period_start,
)
from tidecube.operators.cube import customer_hour_cube
from tidecube.operators.dimensions import explode_levels
from tidecube.operators.enrich import of_known_customers, payments, with_company
from tidecube.operators.totals import ADDITIVE, hourly_totals
from tidecube.plans.columns import published_hours, slot_metrics
from tidecube.plans.options import Options
from tidecube.plans.periods import LAUNCH, PAIRS, Periods, end_of
from tidecube.sources.inputs import Inputs

# Years before the reporting one that the long periods reach back to.
REACH = {"2YTD": 1, "3YTD": 2}
# Months from one start of a period to the next start that leaves it behind.
MONTHS = {"MTD": 1, "2MTD": 2, "QTD": 3, "SemiYTD": 6, "YTD": 12, "2YTD": 24, "3YTD": 36}

PATTERN = -1


@dataclass(frozen=True)
class OpenScope:
    """A period already running when the range begins."""

    period: int
    scope: date
    segments: tuple[int, ...]
    until: date | None


class Range:
    """Reported days ``first`` to ``last``, both included.

    A *scope* is one run of a period. Calendar periods are scoped by their start. The
    two- and three-year periods of different years overlap, so they are scoped by the
    first day of the year that reports them.
    """

    def __init__(self, first: date, last: date, launch: date, options: Options):
        if last < first:
            raise ValueError(f"{last} is before {first}")
        self.first, self.last, self.launch = first, last, launch
        self.end = last + timedelta(days=1)
        self.periods = Periods(first + timedelta(days=1), launch, options.two_month)
        self.names = self.periods.names
        self.metrics = [f"UU{p}" for p in self.names] + [p.key for p in PAIRS]
        self.years = range(first.year, last.year + 1)

    def bucket(self, ts: Column, hour: Column) -> Column:
        """``hour`` inside the range; before it, the start of the stretch ``ts`` is in.

        No period of any reported day begins inside such a stretch, so all of it is in
        a period or none of it, and its start stands for the whole.
        """
        value = F.when(ts >= midnight(self.first), hour)
        for day in reversed(self.periods.segments()):
            value = value.when(ts >= midnight(day), midnight(day))
        return value

    def segment_bit(self, bucket: Column) -> Column:
        """The bit of a stretch of history; 0 inside the range."""
        value = F.when(bucket >= midnight(self.first), F.lit(0))
        for i, day in enumerate(self.periods.segments()):
            value = value.when(bucket == midnight(day), F.lit(1 << i))
        return value

    def new_scopes(self, day: Column) -> Column:
        """Scopes that begin inside the range and that ``day`` counts towards.

        Every row also belongs to its customer's pattern, which stands for the scopes
        that began earlier.
        """
        pattern = F.struct(F.lit(PATTERN).alias("Period"), F.lit(None).cast("date").alias("Scope"))
        tags = [pattern]
        for i, period in enumerate(self.names):
            tag, since = F.lit(i).alias("Period"), F.lit(self.first)
            if period == LAUNCH:
                scope = F.lit(self.launch)
                tags.append(
                    F.when(
                        (day >= since) & (scope >= since), F.struct(tag, scope.alias("Scope"))
                    )
                )
            elif period in REACH:
                for year in self.years:
                    if date(year - REACH[period], 1, 1) < self.first:
                        continue
                    counts = F.year(day).between(year - REACH[period], year)
                    scope = F.lit(date(year, 1, 1)).alias("Scope")
                    tags.append(F.when(counts, F.struct(tag, scope)))
            else:
                start = period_start(period, day)
                tags.append(F.when(start >= since, F.struct(tag, start.alias("Scope"))))
        return F.when(day >= F.lit(self.first), F.array(*tags)).otherwise(F.array(pattern))

    def open_scopes(self) -> list[OpenScope]:
        """Scopes that began before the range and reach into it."""
        segments = self.periods.segments()
        scopes = []

        def add(period: str, scope: date, start: date, until: date | None) -> None:
            inside = tuple(i for i, day in enumerate(segments) if day >= start)
            scopes.append(OpenScope(self.names.index(period), scope, inside, until))

        for period in self.names:
            if period == LAUNCH:
                if self.launch < self.first:
                    add(period, self.launch, self.launch, None)
            elif period in REACH:
                for year in self.years:
                    start = date(year - REACH[period], 1, 1)
                    if start < self.first:
                        add(period, date(year, 1, 1), start, date(year + 1, 1, 1))
            else:
                start = self.periods.start(period)
                if start < self.first:
                    add(period, start, start, end_of(period, start))
        return scopes

    def arrivals(self, counted: DataFrame) -> DataFrame:
        """Turns patterns into first hours in every scope that was open.

        The first appearance is in the earliest stretch of the scope that had activity,
        or else at the first active hour of the range, if the scope lasts until then.
        Rows are multiplied by scope number first and worked out after.
        """
        scopes = self.open_scopes()
        number = F.col("_number")

        def of_scope(value, otherwise: Column) -> Column:
            for i, scope in enumerate(scopes):
                otherwise = F.when(number == i, value(scope)).otherwise(otherwise)
            return otherwise

        def until(scope: OpenScope) -> Column:
            return midnight(scope.until) if scope.until else F.lit(None).cast(NTZ)

        def bits(scope: OpenScope) -> Column:
            return F.lit(sum(1 << i for i in scope.segments))

        own = F.array(F.lit(-1))
        numbers = F.array(*[F.lit(i) for i in range(len(scopes))]).cast("array<int>")
        others = [c for c in counted.columns if c not in ("Period", "Scope", "Segments")]
        opened = counted.withColumn(
            "_number", F.explode(F.when(F.col("Period") == PATTERN, numbers).otherwise(own))
        ).select(
            *others,
            of_scope(lambda s: F.lit(s.period), F.col("Period")).alias("Period"),
            of_scope(lambda s: F.lit(s.scope), F.col("Scope")).alias("Scope"),
            of_scope(bits, F.lit(0)).bitwiseAND(F.col("Segments")).alias("_active"),
            of_scope(until, F.lit(None).cast(NTZ)).alias("_until"),
        )
        in_range = F.col("_until").isNull() | (F.col("FirstHour") < F.col("_until"))
        hour = F.when(in_range, F.col("FirstHour"))
        for i, day in reversed(list(enumerate(self.periods.segments()))):
            active = F.col("_active").bitwiseAND(F.lit(1 << i)) != 0
            hour = F.when(active, midnight(day)).otherwise(hour)
        return opened.withColumn("FirstHour", hour).drop("_active", "_until")

    def metrics_of(self, period: Column) -> Column:
        """The metrics a first appearance in ``period`` adds to.

        ``Months`` is the length of the short period that must begin anew before it
        counts, or NULL for the period's own users, which count at once. ``Length`` is
        the length of the scope.
        """

        def metric(name: str, months: int | None, length: int | None) -> Column:
            return F.struct(
                F.lit(self.metrics.index(name)).alias("Metric"),
                F.lit(months).cast("int").alias("Months"),
                F.lit(length).cast("int").alias("Length"),
            )

        value = F.lit(None)
        for i, name in enumerate(self.names):
            length = None if name == LAUNCH else MONTHS.get(name, 0)  # NULL: it never ends
            if name in REACH:
                length = 12
            entries = [metric(f"UU{name}", None, length)]
            entries += [metric(p.key, MONTHS[p.short], length) for p in PAIRS if p.long == name]
            value = F.when(period == i, F.array(*entries)).otherwise(value)
        return value

    def place(self) -> Column:
        """The hour at which a first appearance adds to a metric; NULL if it never does.

        Users are added at the hour itself, prior counts on the day the short period
        next begins, if that is within the scope. A scope named after its reporting year
        collects what came before that year at its start.
        """
        yearly = ", ".join(str(self.names.index(p)) for p in REACH)
        restart = next_multiple_of_months("FirstHour", "Months")
        return F.expr(
            f"""CASE WHEN Period IN ({yearly}) AND Months IS NULL
                     THEN greatest(FirstHour, CAST(Scope AS TIMESTAMP_NTZ))
                     WHEN Months IS NULL THEN FirstHour
                     WHEN Length IS NULL OR {restart} < add_months(Scope, Length)
                     THEN CAST(CASE WHEN Period IN ({yearly}) THEN greatest({restart}, Scope)
                                    ELSE {restart} END AS TIMESTAMP_NTZ) END"""
        )


def range_totals(inputs: Inputs, span: Range, options: Options) -> DataFrame:
    """Measures per cell and hour; before the range, per cell and stretch of history."""
    start = span.periods.first_day("YTD")
    rows = payments(inputs, start, span.end, options, "Id", "Amount")
    cube = customer_hour_cube(rows, inputs, options)
    hour = F.col("DateHour")
    bucketed = cube.withColumn("DateHour", span.bucket(hour, hour))
    return hourly_totals(bucketed, options, "DateHour")


def range_arrivals(inputs: Inputs, span: Range, options: Options) -> DataFrame:
    """New users per cell, period, scope and hour of first appearance.

    History before the range leaves one row per customer and cell: which stretches had
    activity, as bits. Only days of the range are listed one by one.
    """
    created = F.col("CreatedAt")
    cell = options.dimension_names
    hour = span.bucket(created, date_hour(created, options.hour_offset))
    extra = [d.name for d in options.extra_dimensions]
    finest = (
        payments(inputs, span.launch, span.end, options)
        .withColumn("_hour", hour)
        .groupBy("CustomerKey", "CompanyId", *extra, F.to_date("_hour").alias("_day"))
        .agg(F.min("_hour").alias("_hour"))
    )
    known = of_known_customers(with_company(finest, inputs.companies), inputs.customers)
    merged = (F.bit_or("Segments").alias("Segments"), F.min("FirstHour").alias("FirstHour"))
    scoped = (
        known.select(
            "CustomerKey",
            *cell,
            F.explode(span.new_scopes(F.col("_day"))).alias("_tag"),
            span.segment_bit(F.col("_hour")).alias("Segments"),
            F.when(F.col("_hour") >= midnight(span.first), F.col("_hour")).alias("FirstHour"),
        )
        .filter(F.col("_tag").isNotNull())
        .select("CustomerKey", *cell, "_tag.*", "Segments", "FirstHour")
        .groupBy("CustomerKey", *cell, "Period", "Scope")
        .agg(*merged)
    )
    customers = (
        explode_levels(scoped, options.dimensions)
        .groupBy("CustomerKey", *cell, "Period", "Scope")
        .agg(*merged)
    )
    counted = customers.groupBy(*cell, "Period", "Scope", "Segments", "FirstHour").agg(
        F.count(F.lit(1)).alias("Customers")
    )
    return span.arrivals(counted).filter(F.col("FirstHour").isNotNull())


def range_users(inputs: Inputs, span: Range, options: Options) -> DataFrame:
    """Increments of every user and prior count per cell and hour.

    Rows are multiplied first and placed after, in plain columns: both stay in generated
    code, which array functions inside the generator would not.
    """
    placed = (
        range_arrivals(inputs, span, options)
        .withColumn("_metric", F.explode(span.metrics_of(F.col("Period"))))
        .select(*options.dimension_names, "_metric.*", "Period", "Scope", "FirstHour", "Customers")
        .withColumn("DateHour", span.place())
        .filter(F.col("DateHour") < midnight(span.end))
    )
    return placed.groupBy(*options.dimension_names, "DateHour").agg(
        *[
            F.expr(f"sum(CASE WHEN Metric = {i} THEN Customers END) AS {m}")
            for i, m in enumerate(span.metrics)
        ]
    )


def _anchored(increments: DataFrame, span: Range, options: Options) -> DataFrame:
    """Adds an empty row at the start of each day that a cell reports.

    A cell reports from its first active day of the year on. The first row of a cell and
    year brings the year's empty rows along; merging them with the rows that carry
    values keeps the partitioning by cell. ``_from`` is when the cell's reports begin.
    """
    cell = options.dimension_names
    values = [c for c in increments.columns if c not in (*cell, "DateHour")]
    hour = F.col("DateHour")
    of_year = Window.partitionBy(*cell, F.year("DateHour"))
    active_from = F.min(F.when(F.col("UU") > 0, hour)).over(of_year)
    marked = increments.withColumns(
        {
            "_from": F.greatest(F.to_date(active_from), F.lit(span.first)),
            "_active": active_from.isNotNull(),
            "_is_first": F.row_number().over(of_year.orderBy("DateHour")) == 1,
        }
    )
    until = F.least(F.make_date(F.year(hour), F.lit(12), F.lit(31)), F.lit(span.last))
    brings = F.col("_is_first") & F.col("_active") & (F.col("_from") <= until)
    anchors = F.transform(
        F.when(brings, F.sequence(F.col("_from"), until)).otherwise(F.array().cast("array<date>")),
        lambda day: F.struct(day.cast(NTZ).alias("DateHour"), F.lit(False).alias("_own")),
    )
    own = F.array(F.struct(hour.alias("DateHour"), F.lit(True).alias("_own")))
    starts = F.when(F.col("_active"), F.col("_from").cast(NTZ)).alias("_from")
    rows = marked.select(
        *cell, F.explode(F.concat(own, anchors)).alias("_row"), starts, *values
    ).select(*cell, "_row.*", "_from", *values)
    return rows.groupBy(*cell, "DateHour").agg(
        *[F.expr(f"coalesce(sum(CASE WHEN _own THEN {v} END), 0) AS {v}") for v in values],
        F.max("_from").alias("_from"),
    )


def _running(anchored: DataFrame, span: Range, options: Options) -> DataFrame:
    """Runs all increments up over the periods they belong to.

    Everything is summed from a cell's first row on, and what had been reached when a
    period began is taken off. So all periods share one window order and one sort.
    ``_next`` is the hour of the cell's next row.
    """
    cell = options.dimension_names
    ordered = f"PARTITION BY {', '.join(cell)} ORDER BY DateHour"
    so_far = f"OVER ({ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    increments = [*ADDITIVE, *span.metrics]
    summed = anchored.selectExpr(
        *anchored.columns,
        *[f"sum({c}) {so_far} AS _sum{c}" for c in increments],
        f"lag(DateHour) OVER ({ordered}) AS _previous",
        f"lead(DateHour) OVER ({ordered}) AS _next",
    )
    hour, previous = F.col("DateHour"), F.col("_previous")
    begins = {
        f"_begins{p}": previous.isNull() | (period_start(p, hour) != period_start(p, previous))
        for p in span.periods.calendar
    }
    running = {}
    for period in span.periods.calendar:
        running |= {f"{m}{period}": (m, period) for m in ADDITIVE}
    for period in span.names:
        # The long periods are scoped by the year that reports them.
        scope = "YTD" if period in REACH else period
        running[f"UU{period}"] = (f"UU{period}", scope)
        running |= {p.key: (p.key, scope) for p in PAIRS if p.long == period}
    reached = {
        f"_before{name}": f"last(CASE WHEN _begins{period} THEN _sum{c} - {c} END, true) {so_far}"
        for name, (c, period) in running.items()
        if period != LAUNCH
    }
    kept = [*cell, "DateHour", "_from", "_next", "UU", *ADDITIVE]
    opened = summed.withColumns(begins).selectExpr(
        *kept,
        *[f"_sum{c}" for c in increments],
        *[f"{value} AS {name}" for name, value in reached.items()],
    )
    priors = {p.key for p in PAIRS}

    def so_far_in_period(name: str, c: str) -> str:
        value = f"_sum{c} - _before{name}" if f"_before{name}" in reached else f"_sum{c}"
        return f"nullif({value}, 0) AS {name}" if name in priors else f"{value} AS {name}"

    # Measures of the hour itself get names of their own next to the running ones.
    return opened.filter("DateHour >= _from").selectExpr(
        *[c for c in kept if c not in ("UU", *ADDITIVE)],
        *[f"{m} AS {m}Hourly" for m in ("UU", *ADDITIVE)],
        *[so_far_in_period(name, c) for name, (c, _) in running.items()],
    )


def range_rows(
    inputs: Inputs, first: date, last: date, launch: date, options: Options = Options()
) -> DataFrame:
    """Running sums per cell at every hour with activity and the start of every reported day."""
    span = Range(first, last, launch, options)
    totals = range_totals(inputs, span, options)
    users = range_users(inputs, span, options)
    cell = options.dimension_names
    both = totals.unionByName(users, allowMissingColumns=True)
    values = [c for c in both.columns if c not in (*cell, "DateHour")]
    increments = (
        both.repartition(*cell)
        .groupBy(*cell, "DateHour")
        .agg(*[F.expr(f"sum({v}) AS {v}") for v in values])
    )
    return _running(_anchored(increments, span, options), span, options)


def backfill_cube(
    inputs: Inputs, first: date, last: date, launch: date, options: Options = Options()
) -> DataFrame:
    """The published columns for every reported day from ``first`` to ``last``."""
    span = Range(first, last, launch, options)
    running = range_rows(inputs, first, last, launch, options)
    # Every row holds until the next one; days begin with a row of their own.
    day_end = "CAST(date_add(CAST(DateHour AS DATE), 1) AS TIMESTAMP_NTZ)"
    until = f"least(coalesce(_next, {day_end}), {day_end}) - INTERVAL 1 HOUR"
    hours = running.selectExpr(
        f"explode(sequence(DateHour, {until}, INTERVAL 1 HOUR)) AS _hour",
        "DateHour",
        *options.dimension_names,
        *slot_metrics(span.periods, options),
    )
    return published_hours(hours, "DateHour", "_hour", options)
