"""User bitmaps kept by day, and the customers' numbers they rest on."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecube.operators.bitmaps import hour_bitmaps, numbered, unnumbered
from tidecube.operators.enrich import payments
from tidecube.plans.options import Options
from tidecube.sources import commits
from tidecube.sources.inputs import Inputs

# The numbers are one snapshot that is replaced as a whole.
_NUMBERS_DAY = date(1970, 1, 1)
_NUMBERS = "CustomerKey long, Number long"


def customer_numbers(spark: SparkSession, store: str) -> DataFrame | None:
    """Rows (CustomerKey, Number) of a store."""
    found = commits.entries(spark, f"{store}/numbers")
    return commits.read_entries(spark, found).drop(commits.DAY) if found else None


def number_customers(inputs: Inputs, store: str) -> DataFrame:
    """Gives customers without a number the next ones; numbers once given never change."""
    spark = inputs.transactions.sparkSession
    numbers = customer_numbers(spark, store)
    new = unnumbered(inputs.customers, numbers).withColumn(commits.DAY, F.lit(_NUMBERS_DAY))
    folder, counts = commits.stage(new, f"{store}/places")  # written, so the places hold
    if not counts:
        return numbers if numbers is not None else spark.createDataFrame([], _NUMBERS)
    placed = spark.read.schema(new.schema).parquet(folder)
    if numbers is None:
        rows = numbered(placed, 0)
    else:
        after = numbers.agg(F.coalesce(F.max("Number"), F.lit(0))).first()[0]
        rows = numbers.unionByName(numbered(placed, after))
    dated = rows.withColumn(commits.DAY, F.lit(_NUMBERS_DAY))
    folder, counts = commits.stage(dated, f"{store}/numbers")
    commits.publish(spark, f"{store}/numbers", [_NUMBERS_DAY], folder, counts, dated.schema)
    return customer_numbers(spark, store)


def keep_user_sets(
    inputs: Inputs, store: str, first: date, last: date, launch: date, options: Options = Options()
) -> dict[date, int]:
    """Computes the bitmaps of the days ``first`` to ``last`` and replaces them in one step.

    Returns the number of bitmaps per day. Days are independent of each other, so late facts are
    taken in by keeping their days again.
    """
    numbers = number_customers(inputs, store)
    rows = payments(inputs, max(first, launch), last + timedelta(days=1), options)
    run = uuid.uuid4().hex
    sets = hour_bitmaps(rows, inputs, numbers, options).withColumns(
        {commits.DAY: F.to_date("DateHour"), "Run": F.lit(run)}
    )
    # Folders by month: days alone would make very many small files of a range of years.
    laid = (
        sets.withColumn("_month", F.trunc(commits.DAY, "month")).hint("rebalance", "_month")
        .sortWithinPartitions(commits.DAY, *options.dimension_names, "Bucket", "DateHour").drop("_month")
    )
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    folder, counts = commits.stage(laid, f"{store}/sets", monthly=True)
    commits.publish(sets.sparkSession, f"{store}/sets", days, folder, counts, sets.schema, run, monthly=True)
    return dict.fromkeys(days, 0) | counts


def user_sets(spark: SparkSession, store: str, first: date, end: date) -> DataFrame:
    """The kept bitmaps of the days from ``first`` to before ``end``.

    A day's rows are those of the run that kept it last; others lie in the same folders.
    """
    last = end - timedelta(days=1)
    found = commits.entries(spark, f"{store}/sets", first, last)
    if not found:
        raise ValueError(f"no days from {first} to {last} are kept in {store}")
    runs = spark.createDataFrame([(e.day, e.note) for e in found], f"{commits.DAY} date, Run string")
    rows = commits.read_entries(spark, found).filter(F.col(commits.DAY).between(F.lit(first), F.lit(last)))
    # A row per day asked for.
    return rows.join(F.broadcast(runs), [commits.DAY, "Run"], "left_semi").drop(commits.DAY, "Run")
