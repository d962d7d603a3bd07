"""The published column list."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidecube.operators.retention import pair_columns
from tidecube.operators.totals import average_age, average_tenure, running_count_columns
from tidecube.plans.options import Options
from tidecube.plans.periods import CALENDAR_PAIRS, LONG_PAIRS, PAIRS, TWO_MONTH, Periods

# Metrics in published order, without the period-pair columns.
HOUR_AND_CALENDAR_METRICS = (
    "UUHourly", "TxCountHourly", "TxVolumeHourly",
    "UUDTH", "TxCountDTH", "TxVolumeDTH",
    "AvgAgeHourly", "AvgTenureByYearHourly",
    "UUMTD", "TxCountMTD", "TxVolumeMTD",
    "TxCountQTD", "TxVolumeQTD",
    "TxCountSemiYTD", "TxVolumeSemiYTD",
    "TxCountYTD", "TxVolumeYTD",
    "UUYTD", "UUSemiYTD", "UUQTD",
    "AvgAgeDTH", "AvgAgeMTD", "AvgAgeQTD", "AvgAgeSemiYTD", "AvgAgeYTD",
    "AvgTenureByYearDTH", "AvgTenureByYearMTD", "AvgTenureByYearQTD",
    "AvgTenureByYearSemiYTD", "AvgTenureByYearYTD",
)
LONG_METRICS = ("UU2YTD", "UU3YTD", "UUFeatureLaunchedTD")
TWO_MONTH_METRICS = ("UU", "TxCount", "TxVolume", "AvgAge", "AvgTenureByYear")


def published(cells: DataFrame, options: Options) -> DataFrame:
    """Puts the columns in published order.

    The two-month metrics, when asked for, follow after the published columns.
    """
    extra = [f"{m}{TWO_MONTH}" for m in TWO_MONTH_METRICS] if options.two_month else []
    return cells.select(
        "DateHour",
        *options.dimension_names,
        *HOUR_AND_CALENDAR_METRICS,
        *[p.contribution for p in CALENDAR_PAIRS],
        *LONG_METRICS,
        *[p.contribution for p in LONG_PAIRS],
        *[p.retained for p in CALENDAR_PAIRS],
        *[p.rate for p in CALENDAR_PAIRS],
        *[p.retained for p in LONG_PAIRS],
        *[p.rate for p in LONG_PAIRS],
        *extra,
    )


def filled_averages(period: str) -> list[str]:
    """Averages of one period from its running sums; 0 before anything was seen."""
    age = average_age(f"AgeDays{period}", f"AgeCount{period}")
    tenure = average_tenure(f"TenureMinutes{period}", f"TenureCount{period}")
    return [
        f"coalesce({age}, 0.0D) AS AvgAge{period}",
        f"coalesce({tenure}, 0.0D) AS AvgTenureByYear{period}",
    ]


def day_averages_as_written() -> list[str]:
    """The day's averages: the month's, from the day's first activity on."""
    return [
        f"CASE WHEN UUDTH > 0 THEN {m}MTD ELSE 0.0D END AS {m}DTH"
        for m in ("AvgAge", "AvgTenureByYear")
    ]


# Some pair columns are derived before rows are repeated hour by hour and some after,
# which keeps both generated methods small enough to be compiled.
SOONER, LATER = PAIRS[: len(PAIRS) * 3 // 4], PAIRS[len(PAIRS) * 3 // 4 :]


def slot_metrics(periods: Periods, options: Options) -> list[str]:
    """What holds from one row of a cell to its next, from running sums.

    Metrics of the hour itself come along for the row's own hour.
    """
    metrics = ["UUHourly", "TxCountHourly", "TxVolumeHourly"]
    metrics.append(f"{average_age('AgeDaysHourly', 'AgeCountHourly')} AS AvgAgeHourly")
    tenure = average_tenure("TenureMinutesHourly", "TenureCountHourly")
    metrics.append(f"{tenure} AS AvgTenureByYearHourly")
    metrics += [f"UU{p}" for p in periods.names] + running_count_columns(periods.calendar)
    for period in periods.calendar:
        if period != "DTH" or options.dth_average == "day":
            metrics += filled_averages(period)
    metrics += [column for p in SOONER for column in pair_columns(p, options)]
    return metrics + [p.key for p in LATER]


def published_hours(hours: DataFrame, own: str, hour: str, options: Options) -> DataFrame:
    """Published columns from rows of ``slot_metrics`` repeated for every hour they hold.

    ``own`` is the row's own hour and ``hour`` the repeated one. In the hours between,
    counts are 0 and averages NULL.
    """
    here = f"CASE WHEN {hour} = {own} THEN {{0}} END"
    hourly = {m: f"coalesce({here.format(m)}, 0)" for m in HOUR_AND_CALENDAR_METRICS[:3]}
    hourly |= {m: here.format(m) for m in ("AvgAgeHourly", "AvgTenureByYearHourly")}
    cells = hours.selectExpr(
        f"{hour} AS DateHour",
        *[f"{value} AS {name}" for name, value in hourly.items()],
        *[c for c in hours.columns if c not in (own, hour, *hourly)],
        *[column for p in LATER for column in pair_columns(p, options)],
        *(day_averages_as_written() if options.dth_average == "as_written" else []),
    )
    return published(cells, options)
