"""The target table: published columns, partitioned by reported day.

A target is a folder, given by a path, or a table of the session's catalog, given by its name.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DAY = "day"
_MODE = "spark.sql.sources.partitionOverwriteMode"


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _read(spark: SparkSession, target: str, format: str) -> DataFrame:
    return spark.read.format(format).load(target) if is_path(target) else spark.read.table(target)


def write_days(
    cube: DataFrame, target: str, first: date, last: date, format: str = "parquet"
) -> dict[date, int]:
    """Replaces the days ``first`` to ``last`` in the target; other days are untouched.

    ``cube`` holds exactly those days. It is computed in full before anything is
    replaced, and columns go by name. A day that came out empty replaces what was there
    too. A table that does not exist is created. Returns the rows per day, counted in
    the target.
    """
    spark = cube.sparkSession
    seen = Observation()
    # The set of days stays right if a task runs twice; it has one entry per reported day.
    dated = cube.withColumn(DAY, F.to_date("DateHour")).observe(
        seen, F.collect_set(DAY).alias("days")
    )
    # Rebalancing sizes the files whatever the number of days; the sort lets readers
    # that want one cell skip most row groups.
    rows = dated.hint("rebalance", DAY).sortWithinPartitions(DAY, *cube.columns[1:3], "DateHour")
    if is_path(target):
        rows.write.format(format).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(DAY).save(target)
    elif spark.catalog.tableExists(target):
        before = spark.conf.get(_MODE)
        spark.conf.set(_MODE, "dynamic")
        try:
            rows.select(spark.read.table(target).columns).write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set(_MODE, before)
    else:
        rows.write.format(format).partitionBy(DAY).saveAsTable(target)
    filled = set(seen.get["days"])
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    _clear(spark, target, [d for d in days if d not in filled])
    counted = read_slice(spark, target, first, last, format).groupBy(DAY).count().collect()
    return dict.fromkeys(days, 0) | {r[DAY]: r["count"] for r in counted}


def _clear(spark: SparkSession, target: str, days: list[date]) -> None:
    """Removes the partitions of days without rows: a change of files, not a job per day."""
    if not days:
        return
    if is_path(target):
        folder = spark._jvm.org.apache.hadoop.fs.Path(target)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for d in days:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{DAY}={d}"), True)
    else:
        parts = ", ".join(f"PARTITION ({DAY} = DATE '{d}')" for d in days)
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {parts}")


def read_slice(
    spark: SparkSession,
    target: str,
    first: date,
    last: date,
    format: str = "parquet",
    **members: int | str,
) -> DataFrame:
    """Target rows of the given days and dimension members.

    ``read_slice(spark, target, d, d, PaymentType=10000, CompanyId=7)`` is one company over
    all payment types. Days prune partitions; members reach the scan as filters.
    """
    rows = _read(spark, target, format)
    rows = rows.filter(F.col(DAY).between(F.lit(first), F.lit(last)))
    for name, value in members.items():
        rows = rows.filter(F.col(name) == value)
    return rows
