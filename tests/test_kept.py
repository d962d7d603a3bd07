"""Kept activity of closed months."""

from __future__ import annotations

import random
import re
from datetime import date

import pytest
from conftest import SF, at, customer, rows_of, tx
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidecube import Options, daily_cube, keep_activity, read_slice, run_day, run_kept_day
from tidecube.operators.activity import (
    BEFORE,
    MONTHS,
    Activity,
    first_of_month,
    month_bits,
    month_number,
    moved,
)
from tidecube.operators.dimensions import COMPANY, CUSTOMER_TYPE, PAYMENT_TYPE
from tidecube.operators.enrich import payments
from tidecube.plans.kept import kept_activity
from tidecube.sources import commits
from tidecube.sources.testdata import ORDERS_LAUNCH, orders_inputs

LAUNCH = date(2014, 1, 20)


@given(st.dates(date(1990, 1, 1), date(2100, 1, 1)))
def test_month_numbers(day):
    assert first_of_month(month_number(day)) == day.replace(day=1)


@pytest.fixture(scope="module")
def history(make_inputs):
    """Seven years of facts, some customers and companies seldom seen."""
    r = random.Random(4)
    facts = []
    for i in range(600):
        year = r.choice([2014, 2015, 2017, 2019, 2020, 2020, 2021])
        day = f"{year}-{r.randrange(1, 13):02d}-{r.randrange(1, 29):02d}"
        if year > 2014 or day >= "2014-01-20":
            facts.append(tx(i, r.randrange(40), r.randrange(-20, 90), f"{day} {r.randrange(24):02d}:10:00",
                            r.choice([0, 1, 2, None, 9]), cancelled=int(r.random() < 0.1)))
    facts += [tx(1000 + i, i, 5, f"2021-01-01 {i:02d}:30:00", i % 3) for i in range(4)]
    types = [(k, at("2013-01-01"), k % 3) for k in range(0, 40, 2)]
    return make_inputs(facts, [(0, 1), (1, 1), (2, None)], [customer(k) for k in range(35)], types)


def plain_bits(facts, until):
    out = {}
    for r in facts:
        back = month_number(until) - 1 - month_number(r.CreatedAt)
        if back >= 0:
            key = (r.CustomerKey, r.CompanyId)
            out[key] = out.get(key, 0) | (1 << back if back < MONTHS else BEFORE)
    return out


def test_bits_and_their_movement(spark, history):
    facts = payments(history, LAUNCH, date(2022, 1, 1), Options())
    rows = facts.collect()
    early, late = date(2015, 6, 1), date(2021, 3, 1)
    for until in (early, late):
        got = {(r.CustomerKey, r.CompanyId): r.Months for r in month_bits(facts, Options(), until).collect()}
        assert got == plain_bits(rows, until)
    for by in (0, 1, 7, MONTHS - 1, MONTHS, MONTHS + 1, 200):
        values = [0, 1, 2, 1 << (MONTHS - 1), BEFORE, BEFORE | 5, (1 << (MONTHS + 1)) - 1, 1 << (MONTHS - 8)]
        frame = spark.createDataFrame([(v,) for v in values], "v long")
        for v, got in frame.select("v", moved(F.col("v"), by)).collect():
            bits = [k + by for k in range(MONTHS) if v >> k & 1]
            want = sum(1 << k for k in bits if k < MONTHS)
            assert got == want | (BEFORE if v & BEFORE or any(k >= MONTHS for k in bits) else 0), (v, by)


@pytest.mark.parametrize("base", [
    date(2021, 3, 6), date(2021, 3, 1), date(2021, 1, 1), date(2021, 1, 2), date(2021, 2, 1), date(2020, 7, 2)])
def test_the_cube_is_the_same(history, tmp_path, base):
    store = str(tmp_path / "activity")
    want = rows_of(daily_cube(history, base, LAUNCH))
    keep_activity(history, date(2016, 5, 3), store, LAUNCH)  # brought up in two steps
    activity = keep_activity(history, base, store, LAUNCH)
    assert rows_of(daily_cube(history, base, LAUNCH, activity=activity)) == want and want
    # Activity kept for later days serves earlier ones.
    later = keep_activity(history, date(2021, 12, 5), store, LAUNCH)
    assert later.until == date(2021, 12, 1)
    assert rows_of(daily_cube(history, base, LAUNCH, activity=later)) == want


def test_further_dimensions(history, tmp_path):
    options = Options(dimensions=(PAYMENT_TYPE, COMPANY, CUSTOMER_TYPE), two_month=True)
    base, store = date(2021, 3, 6), str(tmp_path / "activity")
    activity = keep_activity(history, base, store, LAUNCH, options)
    assert rows_of(daily_cube(history, base, LAUNCH, options, activity)) == rows_of(
        daily_cube(history, base, LAUNCH, options))
    with pytest.raises(ValueError, match="other dimensions"):
        daily_cube(history, base, LAUNCH, Options(), activity)
    with pytest.raises(ValueError, match="another launch"):
        daily_cube(history, base, date(2014, 1, 21), options, activity)


def test_nothing_is_read_twice(spark, history, tmp_path):
    store = str(tmp_path / "activity")
    first = keep_activity(history, date(2020, 5, 3), store, LAUNCH)
    assert commits.latest_version(spark, store) == 1
    again = keep_activity(history, date(2020, 5, 31), store, LAUNCH)
    assert commits.latest_version(spark, store) == 1 and again.until == first.until == date(2020, 5, 1)
    keep_activity(history, date(2020, 6, 1), store, LAUNCH)  # reports on the last of May
    assert commits.latest_version(spark, store) == 1
    keep_activity(history, date(2020, 6, 2), store, LAUNCH)
    assert commits.latest_version(spark, store) == 2
    keep_activity(history, date(2020, 6, 2), store, LAUNCH, afresh=True)
    assert commits.latest_version(spark, store) == 3
    assert kept_activity(spark, store, LAUNCH, Options(), date(2020, 5, 20)).until == date(2020, 5, 1)


def test_launch_in_the_reported_month_and_no_facts(history, make_inputs, tmp_path):
    base = date(2014, 1, 25)
    activity = keep_activity(history, base, str(tmp_path / "a"), LAUNCH)
    assert activity.rows.count() == 0
    assert rows_of(daily_cube(history, base, LAUNCH, activity=activity)) == rows_of(daily_cube(history, base, LAUNCH))
    nobody = make_inputs([], [], [])
    none = keep_activity(nobody, date(2021, 3, 6), str(tmp_path / "b"), LAUNCH)
    assert daily_cube(nobody, date(2021, 3, 6), LAUNCH, activity=none).count() == 0


def test_activity_that_does_not_reach_is_refused(spark, history, tmp_path):
    activity = keep_activity(history, date(2020, 5, 3), str(tmp_path / "a"), LAUNCH)
    with pytest.raises(ValueError, match="kept up to"):
        daily_cube(history, date(2020, 7, 3), LAUNCH, activity=activity)
    far = Activity(activity.rows, LAUNCH, date(2026, 1, 1))
    with pytest.raises(ValueError, match="months before"):
        daily_cube(history, date(2020, 7, 3), LAUNCH, activity=far)


def test_run_kept_day(spark, history, tmp_path):
    base = date(2021, 3, 6)
    one, other = str(tmp_path / "one"), str(tmp_path / "other")
    kept = run_kept_day(history, base, one, str(tmp_path / "activity"), LAUNCH)
    assert kept == run_day(history, base, other, LAUNCH) and sum(kept.values())
    day = date(2021, 3, 5)
    assert rows_of(read_slice(spark, one, day, day)) == rows_of(read_slice(spark, other, day, day))


def test_users_read_the_facts_of_the_reported_month_only(spark, tmp_path, capsys):
    inputs = orders_inputs(spark, SF)
    paths = {n: str(tmp_path / n) for n in ("transactions", "companies", "customers")}
    for name, path in paths.items():
        getattr(inputs, name).write.parquet(path)
    from tidecube import read_inputs

    files, base = read_inputs(spark, **paths), date(2000, 11, 16)
    activity = keep_activity(files, base, str(tmp_path / "activity"), ORDERS_LAUNCH)
    cube = daily_cube(files, base, ORDERS_LAUNCH, activity=activity)
    cube.explain("formatted")
    plan = capsys.readouterr().out
    facts = [f for f, schema in re.findall(r"PushedFilters: (\[.*?\])\nReadSchema: (.*)", plan) if "EntryType" in schema]
    starts = sorted(re.search(r"GreaterThanOrEqual\(CreatedAt,([^)]*)\)", f)[1][:10] for f in facts)
    # Totals read the year, users the month.
    assert starts == ["2000-01-01", "2000-11-01"]
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition", "Expand"):
        assert word not in plan
    assert rows_of(cube) == rows_of(daily_cube(files, base, ORDERS_LAUNCH))
