"""Facts that change after the days they count in were reported.

Beside the target lie marks of the facts it was computed from: for every fact day a count and a
sum of row hashes, and for every year the same of the customers and companies active in it and
of those first seen in it. New marks that differ tell which reported days are wrong:

- a changed fact day: itself and the later days of its year, whose totals and users hold it;
- a changed set of pairs of a year: the two years after it, which reach back to it as a whole;
- a changed set of pairs known by the end of a year: the years from the third one after it, where
  only whether a pair was ever seen before still counts.

A late fact of a pair that the year had anyway so touches its own year only. Marks are taken
before the days are computed and kept after, so facts that come in between are found next time,
and a run that dies is repeated. Changes in companies and customers are not watched.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date, timedelta
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecube.operators.activity import extra_names
from tidecube.operators.enrich import payments
from tidecube.plans.job import DEFAULT_LAUNCH, run_range
from tidecube.plans.options import Options
from tidecube.sources import commits
from tidecube.sources.inputs import Inputs

FACTS, ACTIVE, NEW = "facts", "active", "new"
# The marks are one snapshot that is replaced as a whole.
_SNAPSHOT = date(1970, 1, 1)


def _mark(*columns: str) -> list[Column]:
    """A count and a sum of hashes, which do not depend on the order of rows."""
    return [
        F.count(F.lit(1)).alias("Count"),
        F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).cast("decimal(38,0)").alias("Mark"),
    ]


def fact_marks(inputs: Inputs, launch: date, end: date, options: Options = Options()) -> DataFrame:
    """Rows (Kind, Start, Count, Mark) of the eligible facts before ``end``.

    Sums are partial per day in each task. Pairs are made distinct per year there, too, so that no
    customer or company is gathered anywhere.
    """
    pair = ["CustomerKey", "CompanyId", *extra_names(options)]
    facts = payments(inputs, launch, end, options, "Id", "Amount")
    year = F.trunc("CreatedAt", "year")
    by_day = facts.groupBy(F.to_date("CreatedAt").alias("Start")).agg(*_mark("Id", "Amount", "CreatedAt", *pair))
    active = facts.groupBy(*pair, year.alias("Start")).agg(F.lit(1).alias("_seen"))
    by_year = active.groupBy("Start").agg(*_mark(*pair))
    first = active.groupBy(*pair).agg(F.min("Start").alias("Start"))
    by_first = first.groupBy("Start").agg(*_mark(*pair))
    marked = [d.select(F.lit(kind).alias("Kind"), "*") for kind, d in ((FACTS, by_day), (ACTIVE, by_year), (NEW, by_first))]
    return marked[0].unionByName(marked[1]).unionByName(marked[2])


def _changed(old: DataFrame, new: DataFrame) -> dict[str, list]:
    """Per kind what has changed; of the sets first seen, all years. A row per day or year."""
    both = old.select("Kind", "Start", F.struct("Count", "Mark").alias("old")).join(
        new.select("Kind", "Start", F.struct("Count", "Mark").alias("new")), ["Kind", "Start"], "full"
    )
    out: dict[str, list] = {FACTS: [], ACTIVE: [], NEW: []}
    for r in both.filter((F.col("Kind") == NEW) | ~F.col("old").eqNullSafe(F.col("new"))).collect():
        out[r.Kind].append(r)
    return out


def touched_days(old: DataFrame, new: DataFrame, reported: Iterable[date]) -> list[date]:
    """The reported days that changed marks make wrong, in order."""
    changed = _changed(old, new)
    first_of_year: dict[int, date] = {}
    for r in changed[FACTS]:
        first_of_year[r.Start.year] = min(r.Start, first_of_year.get(r.Start.year, r.Start))
    active = {r.Start.year for r in changed[ACTIVE]}
    seen = {r.Start.year: [0, 0, 0, 0] for r in changed[NEW]}
    for r in changed[NEW]:
        seen[r.Start.year] = [
            x for side in (r.old, r.new) for x in ((side.Count, side.Mark) if side else (0, 0))
        ]
    years = range(min(seen, default=0), max(seen, default=-1) + 1)
    known = accumulate((seen.get(y, [0, 0, 0, 0]) for y in years), lambda a, b: [x + z for x, z in zip(a, b, strict=True)])
    # Years by whose end other pairs are known than before; the last one holds for all after it.
    differ = {y: total[:2] != total[2:] for y, total in zip(years, known, strict=True)}

    def wrong(day: date) -> bool:
        in_year = first_of_year.get(day.year)
        if in_year and in_year <= day or active & {day.year - 1, day.year - 2}:
            return True
        return bool(differ) and differ.get(min(day.year - 3, years[-1]), False)

    return sorted(d for d in set(reported) if wrong(d))


def day_ranges(days: Iterable[date]) -> list[tuple[date, date]]:
    """Sorted days as ranges of consecutive ones, first and last included."""
    out: list[tuple[date, date]] = []
    for d in sorted(days):
        if out and d - out[-1][1] == timedelta(days=1):
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def kept_marks(spark: SparkSession, target: str) -> tuple[DataFrame, str] | None:
    """The marks kept beside a target, and what they were taken with."""
    found = commits.entries(spark, f"{target}/facts")
    return (commits.read_entries(spark, found).drop(commits.DAY), found[-1].note) if found else None


def refresh(
    inputs: Inputs,
    target: str,
    first: date,
    last: date,
    launch: date = DEFAULT_LAUNCH,
    options: Options = Options(),
) -> dict[date, int]:
    """Reports the days ``first`` to ``last`` that the target lacks, and again all its days that
    facts have made wrong since they were reported.

    Each range of consecutive days is one job and replaced in one step. Returns the rows of the
    days that were computed.
    """
    spark = inputs.transactions.sparkSession
    note = json.dumps({"launch": launch.isoformat(), "dimensions": sorted(extra_names(options))})
    before = kept_marks(spark, target)
    if before and before[1] != note:
        raise ValueError(f"the target was computed with {before[1]}, not with {note}")
    reported = [e.day for e in commits.entries(spark, target)]
    end = max([last, *reported]) + timedelta(days=1)
    marks = fact_marks(inputs, launch, end, options).withColumn(commits.DAY, F.lit(_SNAPSHOT))
    folder, counts = commits.stage(marks, f"{target}/facts")
    new = spark.read.schema(marks.schema).parquet(folder)
    missing = {first + timedelta(days=i) for i in range((last - first).days + 1)} - set(reported)
    # Days reported without marks cannot be told from wrong ones.
    wrong = touched_days(before[0], new, reported) if before else reported
    rows: dict[date, int] = {}
    for a, b in day_ranges(missing | set(wrong)):
        rows |= run_range(inputs, a, b, target, launch, options, commits.replace_days)
    commits.publish(spark, f"{target}/facts", [_SNAPSHOT], folder, counts, marks.schema, note)
    return rows
