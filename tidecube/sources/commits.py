"""Days kept in folders that readers find through commits, so that a range is replaced at once.

A store is a folder with two parts. ``data/<id>/part=<day>`` holds rows that were written once
and are never changed. ``commits`` has one small file per commit, which says for every day of a
range where its rows lie, or that it has none. Rows are written first. The commit's file then
appears by a single rename, and with it the whole range, emptied days included. A job that dies
before leaves files that nobody reads. Readers that have planned on an earlier version keep
reading its files, and ``version`` goes back to one.

Of commits made at the same time the later identifier counts for a day that both replace.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DAY = "day"
_PART = "part"
_LOG = "version long, commit string, day date, folder string, rows long, schema string, note string"


@dataclass(frozen=True)
class Entry:
    """Where the rows of a day lie; ``folder`` is None for a day that has none."""

    day: date
    folder: str | None
    rows: int
    schema: StructType
    note: str
    version: int


def _log(spark: SparkSession, store: str) -> DataFrame:
    try:
        return spark.read.schema(_LOG).parquet(f"{store}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG)


def entries(
    spark: SparkSession,
    store: str,
    first: date | None = None,
    last: date | None = None,
    version: int | None = None,
) -> list[Entry]:
    """The latest entry of each day of a range, as of a version. One per day, in order."""
    log = _log(spark, store)
    if first is not None:
        log = log.filter(F.col(DAY) >= F.lit(first))
    if last is not None:
        log = log.filter(F.col(DAY) <= F.lit(last))
    if version is not None:
        log = log.filter(F.col("version") <= version)
    columns = [c for c in log.columns if c != DAY]
    order = F.struct("version", "commit")
    found = log.groupBy(DAY).agg(F.max_by(F.struct(*columns), order).alias("entry")).collect()
    return [
        Entry(r.day, r.entry.folder, r.entry.rows, StructType.fromJson(json.loads(r.entry.schema)),
              r.entry.note, r.entry.version)
        for r in sorted(found, key=lambda r: r.day)
    ]


def latest_version(spark: SparkSession, store: str) -> int:
    """The number of the last commit, 0 where there is none."""
    return _log(spark, store).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def month_of(day: date) -> date:
    return day.replace(day=1)


def stage(rows: DataFrame, store: str, monthly: bool = False) -> tuple[str, dict[date, int]]:
    """Writes rows by their ``day``, or by its month, seen by nobody yet.

    Returns the folder and the rows per day.
    """
    spark, folder = rows.sparkSession, f"{store}/data/{uuid.uuid4().hex}"
    part = F.trunc(DAY, "month") if monthly else F.col(DAY)
    rows.withColumn(_PART, part).write.partitionBy(_PART).parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    return folder, {r[DAY]: r["count"] for r in written.groupBy(DAY).count().collect()}


def publish(
    spark: SparkSession,
    store: str,
    days: list[date],
    folder: str,
    counts: dict[date, int],
    schema: StructType,
    note: str = "",
    monthly: bool = False,
) -> int:
    """Makes staged rows the content of ``days``, in one step; returns the version.

    Of rows staged by month, a folder also holds days that other commits have replaced: readers
    have to tell them by something in the rows.
    """
    if outside := sorted(set(counts) - set(days)):
        raise ValueError(f"rows of days that are not replaced: {outside}")
    version, commit = latest_version(spark, store) + 1, uuid.uuid4().hex
    parts = {d: f"{folder}/{_PART}={month_of(d) if monthly else d}" for d in days if counts.get(d)}
    log = [
        (version, commit, d, parts.get(d), counts.get(d, 0), schema.json(), note) for d in days
    ]
    spark.createDataFrame(log, _LOG).coalesce(1).write.mode("append").parquet(f"{store}/commits")
    return version


def read_entries(spark: SparkSession, found: list[Entry]) -> DataFrame:
    """The rows of entries; columns are those of the newest, NULL where an older one lacks them."""
    newest = max(found, key=lambda e: e.version)
    folders = list(dict.fromkeys(e.folder for e in found if e.folder))
    if not folders:
        return spark.createDataFrame([], newest.schema)
    return spark.read.schema(newest.schema).parquet(*folders)


def replace_days(
    cube: DataFrame, store: str, first: date, last: date, note: str = ""
) -> dict[date, int]:
    """Replaces the days ``first`` to ``last`` of a store by the rows of ``cube``, all at once.

    ``cube`` holds exactly those days. Days without rows are emptied by the same commit. Returns
    the rows per day.
    """
    dated = cube.withColumn(DAY, F.to_date("DateHour"))
    rows = dated.hint("rebalance", DAY).sortWithinPartitions(DAY, *cube.columns[1:3], "DateHour")
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    folder, counts = stage(rows, store)
    publish(cube.sparkSession, store, days, folder, counts, dated.schema, note)
    return dict.fromkeys(days, 0) | counts


def read_days(
    spark: SparkSession,
    store: str,
    first: date,
    last: date,
    version: int | None = None,
    **members: int | str,
) -> DataFrame:
    """Rows of a store for the given days and dimension members, as of a version.

    Only the folders of those days are read; members reach the scan as filters.
    """
    found = entries(spark, store, first, last, version)
    if not found:
        any_day = entries(spark, store, version=version)
        if not any_day:
            raise ValueError(f"nothing is committed in {store}")
        return spark.createDataFrame([], any_day[-1].schema)
    rows = read_entries(spark, found)
    for name, value in members.items():
        rows = rows.filter(F.col(name) == value)
    return rows


def unused_folders(spark: SparkSession, store: str, keep_from: int | None = None) -> list[str]:
    """Folders of days that no version from ``keep_from`` on (by default the last) reads.

    They can be deleted once no reader uses an older version.
    """
    log = _log(spark, store)
    keep_from = latest_version(spark, store) if keep_from is None else keep_from
    replaced = F.lead("version").over(Window.partitionBy(DAY).orderBy("version", "commit"))
    named = log.filter(F.col("folder").isNotNull()).select("folder").distinct()
    live = log.withColumn("_until", replaced).filter(
        F.col("folder").isNotNull() & (F.col("_until").isNull() | (F.col("_until") > keep_from))
    )
    return sorted(r.folder for r in named.join(live.select("folder").distinct(), "folder", "left_anti").collect())
