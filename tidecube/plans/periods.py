"""The calendar of one reported day and the period pairs compared in it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

# Period names and the labels used in output column names.
CALENDAR_PERIODS = ("DTH", "MTD", "QTD", "SemiYTD", "YTD")
TWO_MONTH = "2MTD"
LONG_PERIODS = ("2YTD", "3YTD", "FeatureLaunchedTD")
LAUNCH = "FeatureLaunchedTD"
SHORT_LABELS = {
    "MTD": "Month",
    "QTD": "Quarter",
    "SemiYTD": "SemiYTD",
    "YTD": "YTD",
    "2YTD": "2YTD",
    "3YTD": "3YTD",
}
LONG_LABELS = {
    "QTD": "Quarter",
    "SemiYTD": "SemiYear",
    "YTD": "Year",
    "2YTD": "2YTD",
    "3YTD": "3YTD",
    "FeatureLaunchedTD": "UUFeatureLaunchedTD",
}


@dataclass(frozen=True)
class Pair:
    """A short period compared with a long one that contains it."""

    long: str
    short: str

    @property
    def calendar(self) -> bool:
        return self.long not in LONG_PERIODS

    @property
    def key(self) -> str:
        return f"Previous{self.long}Before{self.short}"

    @property
    def contribution(self) -> str:
        return f"HourlyContributerUUThis{SHORT_LABELS[self.short]}ToThe{LONG_LABELS[self.long]}"

    @property
    def retained(self) -> str:
        if not self.calendar:
            return f"HourlyRetainUUThis{SHORT_LABELS[self.short]}ToThe{LONG_LABELS[self.long]}"
        short = "SemiYear" if self.short == "SemiYTD" else SHORT_LABELS[self.short]
        return f"HourlyRetainedUUThis{short}WithinThe{LONG_LABELS[self.long]}"

    @property
    def rate(self) -> str:
        link = "Within" if self.calendar else "To"
        return (
            f"HourlyRetentionRateThis{SHORT_LABELS[self.short]}"
            f"{link}The{LONG_LABELS[self.long]}"
        )


# The compared periods, long and short, in the order of the published columns.
CALENDAR_PAIRS = (
    Pair("QTD", "MTD"),
    Pair("SemiYTD", "MTD"),
    Pair("YTD", "MTD"),
    Pair("SemiYTD", "QTD"),
    Pair("YTD", "QTD"),
    Pair("YTD", "SemiYTD"),
)
LONG_PAIRS = (
    Pair("2YTD", "MTD"),
    Pair("2YTD", "QTD"),
    Pair("2YTD", "SemiYTD"),
    Pair("2YTD", "YTD"),
    Pair("3YTD", "MTD"),
    Pair("3YTD", "QTD"),
    Pair("3YTD", "SemiYTD"),
    Pair("3YTD", "YTD"),
    Pair("3YTD", "2YTD"),
    Pair("FeatureLaunchedTD", "MTD"),
    Pair("FeatureLaunchedTD", "QTD"),
    Pair("FeatureLaunchedTD", "SemiYTD"),
    Pair("FeatureLaunchedTD", "YTD"),
    Pair("FeatureLaunchedTD", "2YTD"),
    Pair("FeatureLaunchedTD", "3YTD"),
)
PAIRS = CALENDAR_PAIRS + LONG_PAIRS


def start_of(period: str, day: date, launch: date) -> date:
    """First day of ``period`` as seen from ``day``."""

    def first_of(months: int) -> date:
        return date(day.year, (day.month - 1) // months * months + 1, 1)

    return {
        "DTH": day,
        "MTD": first_of(1),
        "2MTD": first_of(2),
        "QTD": first_of(3),
        "SemiYTD": first_of(6),
        "YTD": first_of(12),
        "2YTD": date(day.year - 1, 1, 1),
        "3YTD": date(day.year - 2, 1, 1),
        "FeatureLaunchedTD": launch,
    }[period]


def end_of(period: str, start: date) -> date:
    """First day after the calendar period that starts at ``start``."""
    months = {"MTD": 1, "2MTD": 2, "QTD": 3, "SemiYTD": 6, "YTD": 12}[period]
    month = start.month - 1 + months
    return date(start.year + month // 12, month % 12 + 1, 1)


@dataclass(frozen=True)
class Periods:
    """Period starts of the day before ``base_day``.

    Every period runs from its start, or from the launch if that is later, to the
    end of the reported day, so the periods are nested suffixes of the history.
    """

    base_day: date
    launch: date
    two_month: bool = False

    @property
    def day(self) -> date:
        return self.base_day - timedelta(days=1)

    @property
    def calendar(self) -> tuple[str, ...]:
        if not self.two_month:
            return CALENDAR_PERIODS
        return CALENDAR_PERIODS[:2] + (TWO_MONTH,) + CALENDAR_PERIODS[2:]

    @property
    def names(self) -> tuple[str, ...]:
        return self.calendar + LONG_PERIODS

    def start(self, period: str) -> date:
        return start_of(period, self.day, self.launch)

    def first_day(self, period: str) -> date:
        """Start of the period's data: no fact is older than the launch."""
        return max(self.start(period), self.launch)

    def segments(self) -> list[date]:
        """Distinct period first days before the reported day, oldest first.

        They cut the history into stretches inside which no period begins, so a
        stretch is either wholly in a period or wholly outside it.
        """
        firsts = {self.first_day(p) for p in self.names}
        return sorted(d for d in firsts if d < self.day)
