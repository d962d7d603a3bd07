"""Counts, volumes and averages per cell, by hour and running."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecube.functions.dates import period_start
from tidecube.operators.enrich import DAYS_PER_YEAR, MINUTES_PER_YEAR
from tidecube.plans.options import Options

# Additive measures of an hour; averages are divided out of them last.
ADDITIVE = ("TxCount", "TxVolume", "AgeDays", "AgeCount", "TenureMinutes", "TenureCount")


def hourly_totals(cube: DataFrame, options: Options, *by: str) -> DataFrame:
    """Measures per cell and ``by``, from the customer-hour cube.

    The cube has one row per customer in an hour and cell, so users are its row count.
    Volume adds up what each customer's hour came to, without its sign.
    """
    return cube.groupBy(*by, *options.dimension_names).agg(
        F.count(F.lit(1)).alias("UU"),
        F.sum("TxCount").alias("TxCount"),
        F.sum(F.abs("TotalVolume")).alias("TxVolume"),
        F.sum("AgeDays").alias("AgeDays"),
        F.count("AgeDays").alias("AgeCount"),
        F.sum("TenureMinutes").alias("TenureMinutes"),
        F.count("TenureMinutes").alias("TenureCount"),
    )


def average_age(days: str, count: str) -> str:
    return f"try_divide(CAST({days} AS DOUBLE), {count} * {DAYS_PER_YEAR}D)"


def average_tenure(minutes: str, count: str) -> str:
    return f"try_divide(CAST({minutes} AS DOUBLE), {count} * {MINUTES_PER_YEAR}D)"


HOURLY_METRICS = (
    "UU AS UUHourly",
    "TxCount AS TxCountHourly",
    "TxVolume AS TxVolumeHourly",
    f"{average_age('AgeDays', 'AgeCount')} AS AvgAgeHourly",
    f"{average_tenure('TenureMinutes', 'TenureCount')} AS AvgTenureByYearHourly",
)


def hourly_metrics(totals: DataFrame, options: Options) -> DataFrame:
    """Hourly columns per cell; ``totals`` is by DateHour."""
    return totals.selectExpr("DateHour", *options.dimension_names, *HOURLY_METRICS)


def running_totals(totals: DataFrame, periods: tuple[str, ...], options: Options) -> DataFrame:
    """Running sum of every additive measure over each calendar period.

    Hashing by cell once serves the windows of all periods.
    """
    cell = options.dimension_names
    out = totals.repartition(*cell)
    for period in periods:
        window = (
            Window.partitionBy(*cell, period_start(period, F.col("DateHour")))
            .orderBy("DateHour")
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        out = out.withColumns({f"{m}{period}": F.sum(m).over(window) for m in ADDITIVE})
    return out


def running_count_columns(periods: tuple[str, ...]) -> list[str]:
    return [f"{m}{p}" for p in periods for m in ("TxCount", "TxVolume")]


def running_counts(running: DataFrame, periods: tuple[str, ...], options: Options) -> DataFrame:
    """TxCount and TxVolume columns of ``running_totals``."""
    return running.select("DateHour", *options.dimension_names, *running_count_columns(periods))


def average_source(period: str, options: Options) -> str:
    """The period whose running sums give the averages of ``period``."""
    if period == "DTH" and options.dth_average == "as_written":
        return "MTD"
    return period


def running_average_columns(periods: tuple[str, ...], options: Options) -> list[str]:
    columns = []
    for period in periods:
        of = average_source(period, options)
        age = average_age(f"AgeDays{of}", f"AgeCount{of}")
        tenure = average_tenure(f"TenureMinutes{of}", f"TenureCount{of}")
        columns += [f"{age} AS AvgAge{period}", f"{tenure} AS AvgTenureByYear{period}"]
    return columns


def running_averages(
    running: DataFrame, periods: tuple[str, ...], options: Options
) -> DataFrame:
    """AvgAge and AvgTenureByYear columns of ``running_totals``."""
    return running.selectExpr(
        "DateHour", *options.dimension_names, *running_average_columns(periods, options)
    )
