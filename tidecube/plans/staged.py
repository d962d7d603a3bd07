"""The cube of one day, stage by stage, with every intermediate table in reach.

``daily_cube`` gives the same result with less work. This form is for looking at a
stage on its own: totals and users at every hour of history, the dense frame before
and after filling, and the prior-period counts. Later stages use the totals and the
users several times. With ``keep`` these two are persisted, which computes them from the
facts once for all stages looked at; ``release`` gives their storage back.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecube.functions.dates import midnight, period_start
from tidecube.operators import cube, frame, retention, totals, users
from tidecube.operators.enrich import base_transactions, payments
from tidecube.plans.columns import published
from tidecube.plans.options import Options
from tidecube.plans.periods import PAIRS, Periods
from tidecube.sources.inputs import Inputs


@dataclass(frozen=True)
class Stages:
    """Intermediate tables of the cube of the day before ``base_day``."""

    inputs: Inputs
    base_day: date
    launch: date
    options: Options = Options()
    keep: bool = False

    def _kept(self, stage: DataFrame) -> DataFrame:
        return stage.persist() if self.keep else stage

    @cached_property
    def periods(self) -> Periods:
        return Periods(self.base_day, self.launch, self.options.two_month)

    @cached_property
    def base_transactions(self) -> DataFrame:
        return base_transactions(self.inputs, self.base_day, self.launch, self.options)

    def _cube_since(self, start: date) -> DataFrame:
        rows = payments(self.inputs, start, self.base_day, self.options, "Id", "Amount")
        return cube.customer_hour_cube(rows, self.inputs, self.options)

    @cached_property
    def customer_hour_cube(self) -> DataFrame:
        return self._cube_since(self.launch)

    @cached_property
    def hourly_totals(self) -> DataFrame:
        this_year = self._cube_since(self.periods.first_day("YTD"))
        return totals.hourly_totals(this_year, self.options, "DateHour")

    @cached_property
    def hourly_metrics(self) -> DataFrame:
        return totals.hourly_metrics(self.hourly_totals, self.options)

    @cached_property
    def _running(self) -> DataFrame:
        return totals.running_totals(self.hourly_totals, self.periods.calendar, self.options)

    @cached_property
    def running_tx(self) -> DataFrame:
        return totals.running_counts(self._running, self.periods.calendar, self.options)

    @cached_property
    def running_averages(self) -> DataFrame:
        return totals.running_averages(self._running, self.periods.calendar, self.options)

    @cached_property
    def totals(self) -> DataFrame:
        """Hourly metrics with running counts, volumes and averages."""
        keys = ["DateHour", *self.options.dimension_names]
        running, periods = self._running, self.periods.calendar
        return self._kept(
            running.selectExpr(
                *keys,
                *totals.HOURLY_METRICS,
                *totals.running_count_columns(periods),
                *totals.running_average_columns(periods, self.options),
            )
        )

    @cached_property
    def running_users(self) -> DataFrame:
        rows = payments(self.inputs, self.launch, self.base_day, self.options)
        firsts = users.first_hours(rows, self.inputs, self.periods, self.options)
        return self._kept(users.running_users(firsts, self.periods, self.options))

    def release(self) -> None:
        """Unpersists the stages that were persisted."""
        for stage in ("totals", "running_users"):
            if stage in self.__dict__:
                self.__dict__[stage].unpersist()

    @cached_property
    def dense_frame(self) -> DataFrame:
        return frame.dense_frame(self.running_users, self.totals, self.periods, self.options)

    @cached_property
    def carry_forward(self) -> DataFrame:
        return frame.carry_forward(
            self.dense_frame, self.running_users, self.totals, self.periods, self.options
        )

    @cached_property
    def prior_users(self) -> DataFrame:
        """Per cell, a long period's users when the short period began, for every pair."""
        hour = F.col("DateHour")
        counts = []
        for pair in PAIRS:
            before = hour < midnight(self.periods.start(pair.short))
            within = hour >= midnight(self.periods.start(pair.long))
            counts.append(F.max(F.when(before & within, F.col(f"UU{pair.long}"))).alias(pair.key))
        keys = self.options.dimension_names
        active = frame.active_keys(self.running_users, self.options)
        return self.running_users.groupBy(*keys).agg(*counts).join(active, keys, "left_semi")

    @cached_property
    def compared(self) -> DataFrame:
        return self.carry_forward.join(self.prior_users, self.options.dimension_names, "left")

    @cached_property
    def published(self) -> DataFrame:
        columns = [c for p in PAIRS for c in retention.pair_columns(p, self.options)]
        return published(self.compared.selectExpr("*", *columns), self.options)


def period_starts(days: DataFrame, launch: date) -> DataFrame:
    """Start of every period for each base day in ``BaseDay``."""
    reported = F.date_sub(F.col("BaseDay"), 1)
    names = ("DTH", "MTD", "2MTD", "QTD", "SemiYTD", "YTD", "2YTD", "3YTD", "FeatureLaunchedTD")
    return days.select(
        "BaseDay", *[period_start(p, reported, launch).alias(f"Start{p}") for p in names]
    )
