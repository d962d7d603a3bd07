"""Cube levels that are copied, and the spine by recursion."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from conftest import customer, rows_of, tx

from tidecube import Options, daily_cube, with_known_keys
from tidecube.operators.dimensions import COMPANY, CUSTOMER_TYPE, PAYMENT_TYPE, copied_levels
from tidecube.operators.frame import hour_spine, recursive_spine

LAUNCH, BASE = date(2018, 1, 20), date(2021, 3, 6)
TYPED = Options(dimensions=(PAYMENT_TYPE, COMPANY, CUSTOMER_TYPE))


@pytest.fixture
def inputs(make_inputs):
    r = random.Random(3)
    facts = [tx(i, r.randrange(9), r.randrange(-5, 20), f"{r.randrange(2018, 2021)}-12-{r.randrange(1, 29):02d} 10:00:00",
                r.choice([0, 1, 2, 3, None, 77])) for i in range(60)]
    facts += [tx(100 + i, r.randrange(9), 4, f"2021-03-0{1 + i % 5} {i:02d}:00:00", r.choice([0, 1, None, 77])) for i in range(20)]
    types = [(k, datetime(2017, 1, 1), k % 2) for k in range(9)]

    def made(companies):
        return make_inputs(facts, companies, [customer(k) for k in range(8)], types)

    return made


def test_copied_levels_give_the_same_cube(inputs, capsys):
    unique = with_known_keys(inputs([(0, 1), (1, 1), (2, None), (3, 2), (None, 4), (None, 5)]))
    assert unique.unique_companies
    assert copied_levels(Options().dimensions) == [1] and len(copied_levels(TYPED.dimensions)) == 2
    for options in (Options(), TYPED):
        cube = daily_cube(unique, BASE, LAUNCH, options)
        full = daily_cube(inputs([(0, 1), (1, 1), (2, None), (3, 2)]), BASE, LAUNCH, options)
        assert rows_of(cube) == rows_of(full)
    daily_cube(unique, BASE, LAUNCH).explain("formatted")
    plan = capsys.readouterr().out
    # One level fewer is multiplied out below the sums over customers.
    assert plan.count("explode([0,2,3])") == 2 and "explode([0,1,2,3])" not in plan


def test_companies_that_repeat_get_all_levels(inputs):
    repeated = with_known_keys(inputs([(0, 1), (0, 2), (1, 1)]))
    assert not repeated.unique_companies


@pytest.mark.parametrize("hours", [0, 1, 2, 7, 100, 1500])
def test_recursive_spine(spark, hours):
    rows = [(datetime(2020, 2, 28, 5), datetime(2020, 2, 28, 5), hours)]
    bounds = spark.createDataFrame(rows, "start timestamp_ntz, end timestamp_ntz, n int").selectExpr(
        "start", "end + make_dt_interval(0, n) AS end")
    got = sorted(r.DateHour for r in recursive_spine(bounds).collect())
    assert got == sorted(r.DateHour for r in hour_spine(bounds).collect())[:-1] and len(got) == hours
