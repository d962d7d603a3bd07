"""Customer type as of each transaction."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecube.functions.dates import midnight
from tidecube.operators.dimensions import MISSING, reject_reserved


def type_intervals(history: DataFrame, start: date, end: date) -> DataFrame:
    """Rows (CustomerKey, month, from, to, type) of what held when, cut at month boundaries.

    The history is small against the transactions: one row per change. Of several types with
    the same time the greatest wins, and NULL only if there is no other. A NULL type is a value
    like any other: it ends the type before it, and is labelled as missing (-80).
    """
    changes = history.groupBy("CustomerKey", F.col("CreatedAt").alias("_from")).agg(
        F.max(reject_reserved(F.col("CustomerType"), "CustomerType")).alias("_type")
    )
    following = Window.partitionBy("CustomerKey").orderBy("_from")
    held = changes.withColumn(
        "_to", F.coalesce(F.lead("_from").over(following), midnight(end))
    ).filter((F.col("_to") > midnight(start)) & (F.col("_from") < midnight(end)))
    first = F.trunc(F.greatest(F.col("_from"), midnight(start)), "MM")
    last = F.trunc(F.least(F.col("_to"), midnight(end)), "MM")
    return held.select(
        F.col("CustomerKey").alias("_customer"),
        "_from",
        "_to",
        F.coalesce("_type", F.lit(MISSING)).alias("CustomerType"),
        F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("_month"),
    )


def latest_customer_type(
    rows: DataFrame, history: DataFrame, start: date, end: date
) -> DataFrame:
    """Adds the customer's latest type at or before CreatedAt; drops rows without one.

    ``rows`` lie in ``start`` <= CreatedAt < ``end``. They are read once and equi-joined with
    the intervals on customer and month, so a customer with many transactions is an ordinary
    skewed join, which adaptive execution can split.
    """
    intervals = type_intervals(history, start, end)
    joined = rows.withColumn("_in", F.trunc("CreatedAt", "MM")).join(
        intervals,
        (F.col("CustomerKey") == F.col("_customer"))
        & (F.col("_in") == F.col("_month"))
        & (F.col("CreatedAt") >= F.col("_from"))
        & (F.col("CreatedAt") < F.col("_to")),
    )
    return joined.select(*rows.columns, "CustomerType")
