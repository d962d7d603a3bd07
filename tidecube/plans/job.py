"""Jobs that compute days and write them to the target."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidecube.operators.accounts import Accounts
from tidecube.plans.backfill import backfill_cube
from tidecube.plans.daily import daily_cube
from tidecube.plans.options import Options
from tidecube.sources.inputs import Inputs
from tidecube.sources.target import write_days

#: Puts a cube of some days into a target: ``write_days``, or ``replace_days`` for one step.
Writer = Callable[[DataFrame, str, date, date], dict[date, int]]

# Fixed value: first day with transactions, unless another is given.
DEFAULT_LAUNCH = date(2020, 1, 20)


# Fixed value: bytes of a generated method beyond which the JVM does not compile it.
COMPILED_METHOD = 8000


def warn_of_uncompiled_methods(spark: SparkSession) -> None:
    """The published projections are wide; with Spark's default limit they may run uncompiled."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > COMPILED_METHOD:
        warnings.warn(f"set {key} to {COMPILED_METHOD} for wide cubes", stacklevel=3)


def run_day(
    inputs: Inputs,
    base_day: date,
    target: str,
    launch: date = DEFAULT_LAUNCH,
    options: Options = Options(),
    write: Writer = write_days,
    accounts: Accounts | None = None,
) -> dict[date, int]:
    """Computes the day before ``base_day`` and replaces it in the target.

    ``accounts``, if given, then reports what the joins dropped and repeated.
    """
    warn_of_uncompiled_methods(inputs.transactions.sparkSession)
    day = base_day - timedelta(days=1)
    cube = daily_cube(inputs, base_day, launch, options, accounts=accounts)
    return write(cube, target, day, day)


def run_range(
    inputs: Inputs,
    first: date,
    last: date,
    target: str,
    launch: date = DEFAULT_LAUNCH,
    options: Options = Options(),
    write: Writer = write_days,
) -> dict[date, int]:
    """Computes the days ``first`` to ``last`` in one job and replaces them."""
    warn_of_uncompiled_methods(inputs.transactions.sparkSession)
    cube = backfill_cube(inputs, first, last, launch, options)
    return write(cube, target, first, last)
