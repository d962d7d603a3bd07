"""Dense hourly frames and filling values forward in them."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecube.functions.dates import midnight, plus_hours
from tidecube.plans.options import Options
from tidecube.plans.periods import LONG_PERIODS, Periods


def hour_spine(bounds: DataFrame) -> DataFrame:
    """Every hour from ``start`` to ``end``, both included, for each row of ``bounds``."""
    hours = F.sequence("start", "end", F.expr("INTERVAL 1 HOUR"))
    return bounds.select(F.explode(hours).alias("DateHour"))


def recursive_spine(bounds: DataFrame) -> DataFrame:
    """Every hour from ``start`` to before ``end`` for each row of ``bounds``, by recursion.

    A stretch of hours is halved until single hours are left, so the recursion is as deep as the
    logarithm of the hours, and each of its steps is spread over all tasks. Spark bounds the rows of
    a recursion by ``spark.sql.cteRecursionRowLimit``, to be set to twice the hours where it is less.
    """
    spark, view = bounds.sparkSession, f"bounds_{uuid.uuid4().hex}"
    bounds.createOrReplaceTempView(view)
    try:
        hours = spark.sql(f"""
            WITH RECURSIVE halves(start, n) AS (
              SELECT start, CAST(timestampdiff(HOUR, start, end) AS INT) FROM {view} WHERE start < end
              UNION ALL
              SELECT start + make_dt_interval(0, CAST(half * (n DIV 2) AS INT)),
                CAST(CASE WHEN half = 1 THEN n - n DIV 2 ELSE n DIV 2 END AS INT)
              FROM (SELECT start, n, explode(array(0, 1)) AS half FROM halves WHERE n > 1))
            SELECT start AS DateHour FROM halves WHERE n = 1""")
        return hours.select("DateHour")
    finally:
        spark.catalog.dropTempView(view)


def day_grid(keys: DataFrame, day: date) -> DataFrame:
    """The 24 hours of ``day`` for each key; each key makes its own hours, so no join."""
    hours = F.explode(F.sequence(F.lit(0), F.lit(23)))
    return keys.withColumn("_hour", hours).select(
        plus_hours(midnight(day), F.col("_hour")).alias("DateHour"), *keys.columns
    )


def active_keys(users: DataFrame, options: Options) -> DataFrame:
    """Cells with a user this year."""
    this_year = users.filter(F.col("UUYTD").isNotNull())
    return this_year.select(*options.dimension_names).distinct()


def dense_frame(
    users: DataFrame, totals: DataFrame, periods: Periods, options: Options
) -> DataFrame:
    """Hourly and running values on every hour of the day for every active cell.

    Running values stay NULL at hours that change nothing; hourly counts become 0.
    """
    keys = ["DateHour", *options.dimension_names]
    in_day = F.col("DateHour") >= midnight(periods.day)
    grid = day_grid(active_keys(users, options), periods.day)
    frame = grid.join(totals.filter(in_day), keys, "left").join(
        users.filter(in_day), keys, "left"
    )
    return frame.fillna(0, ["UUHourly", "TxCountHourly"]).withColumn(
        "TxVolumeHourly", F.coalesce("TxVolumeHourly", F.lit(0))
    )


def running_metrics(periods: Periods) -> dict[str, str]:
    """Metric name to period, for every metric that is carried forward."""
    own = ("UU", "TxCount", "TxVolume", "AvgAge", "AvgTenureByYear")
    metrics = {f"{m}{p}": p for p in periods.calendar for m in own}
    return metrics | {f"UU{p}": p for p in LONG_PERIODS}


def midnight_seeds(
    history: DataFrame, metrics: dict[str, str], periods: Periods, options: Options
) -> DataFrame:
    """Per cell, each metric's latest value in its period before the day."""
    hour = F.col("DateHour")
    picks = []
    for metric, period in metrics.items():
        seen = (hour >= midnight(periods.start(period))) & F.col(metric).isNotNull()
        picks.append(F.max_by(metric, F.when(seen, hour)).alias(f"_{metric}"))
    before = history.filter(hour < midnight(periods.day))
    return before.groupBy(*options.dimension_names).agg(*picks)


def carry_forward(
    frame: DataFrame, users: DataFrame, totals: DataFrame, periods: Periods, options: Options
) -> DataFrame:
    """Fills every hour of the dense frame with the last value known at that hour.

    Before the day's first value that is the latest one of the same period before the
    day, or 0.
    """
    cell = options.dimension_names
    metrics = running_metrics(periods)
    of_users = {m: p for m, p in metrics.items() if m in users.columns}
    of_totals = {m: p for m, p in metrics.items() if m in totals.columns}
    so_far = (
        Window.partitionBy(*cell)
        .orderBy("DateHour")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    seeded = frame.join(midnight_seeds(users, of_users, periods, options), cell, "left").join(
        midnight_seeds(totals, of_totals, periods, options), cell, "left"
    )
    filled = {
        m: F.coalesce(F.last(m, ignorenulls=True).over(so_far), F.col(f"_{m}"), F.lit(0))
        for m in metrics
    }
    return seeded.withColumns(filled).select(*frame.columns)
