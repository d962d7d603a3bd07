"""Hourly period-to-date KPI cubes on Spark DataFrames."""

from tidecube.operators.accounts import Accounts
from tidecube.plans.backfill import backfill_cube
from tidecube.plans.changes import read_changes, run_changes
from tidecube.plans.daily import daily_cube
from tidecube.plans.job import run_day, run_range
from tidecube.plans.kept import keep_activity, run_kept_day
from tidecube.plans.late import refresh
from tidecube.plans.options import Options
from tidecube.plans.periods import Periods
from tidecube.sources.commits import read_days, replace_days
from tidecube.sources.inputs import Inputs, read_inputs, with_known_keys
from tidecube.sources.target import read_slice, write_days

__all__ = [
    "Accounts",
    "Inputs",
    "Options",
    "Periods",
    "backfill_cube",
    "daily_cube",
    "keep_activity",
    "read_changes",
    "read_days",
    "read_inputs",
    "read_slice",
    "refresh",
    "replace_days",
    "run_changes",
    "run_day",
    "run_kept_day",
    "run_range",
    "with_known_keys",
    "write_days",
]
