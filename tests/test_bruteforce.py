"""The cube of random data against set arithmetic in plain Python."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from conftest import SF, customer, rows_of, tx
from pyspark.sql import functions as F

from tidecube import Options, backfill_cube, daily_cube
from tidecube.plans.periods import PAIRS, Periods
from tidecube.plans.staged import Stages
from tidecube.sources.testdata import orders_inputs

LAUNCH = date(2018, 5, 10)
COMPANIES = [(1, 1), (2, 1), (3, 2), (4, None)]


def random_facts(seed: int, days: list[date], hot: bool = False):
    rng = random.Random(seed)
    facts = []
    for i in range(260):
        day = rng.choice(days)
        facts.append(
            tx(
                i,
                1 if hot and i % 3 == 0 else rng.randint(1, 12),
                rng.randint(-50, 100),
                f"{day} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:00",
                1 if hot and i % 3 == 1 else rng.choice([1, 2, 3, 4, 5, None]),
            )
        )
    return facts


def brute_force(facts, base: date):
    """Users, counts, volumes and pair columns per cell and hour, from their definitions."""
    periods = Periods(base, LAUNCH)
    types = dict(COMPANIES)
    net = defaultdict(int)
    counts = defaultdict(int)
    active = defaultdict(set)  # cell -> {(hour, customer)}
    for _, who, amount, created, company, *_ in facts:
        if not datetime.combine(LAUNCH, datetime.min.time()) <= created < datetime.combine(
            base, datetime.min.time()
        ):
            continue
        hour = created.replace(minute=0, second=0)
        kind = types.get(company)
        kind = -80 if kind is None else kind
        member = -80 if company is None else company
        for cell in {(a, b) for a in (kind, 10000) for b in (member, 10000)}:
            net[cell, hour, who] += amount
            counts[cell, hour, who] += 1
            active[cell].add((hour, who))
    out = {}
    midnight = {p: datetime.combine(periods.start(p), datetime.min.time()) for p in periods.names}
    for cell, seen in active.items():
        if not any(h >= midnight["YTD"] for h, _ in seen):
            continue
        for i in range(24):
            hour = datetime.combine(periods.day, datetime.min.time()) + timedelta(hours=i)
            row = {}

            def users(period, until, before=None):
                return {
                    w for h, w in seen
                    if h >= midnight[period] and h <= until and (before is None or h < before)
                }

            for p in periods.names:
                row[f"UU{p}"] = len(users(p, hour))
                if p in periods.calendar:
                    inside = [(h, w) for h, w in seen if midnight[p] <= h <= hour]
                    row[f"TxCount{p}"] = sum(counts[cell, h, w] for h, w in inside)
                    row[f"TxVolume{p}"] = sum(abs(net[cell, h, w]) for h, w in inside)
            for pair in PAIRS:
                old = users(pair.long, hour, midnight[pair.short])
                now = users(pair.short, hour)
                row[pair.contribution] = row[f"UU{pair.long}"] - len(old) if old else None
                row[pair.retained] = len(now & old) if old else None
                row[pair.rate] = len(now & old) / len(old) if old else 0.0
            out[(hour, *cell)] = row
    return out


def as_dict(df):
    return {(r.DateHour, r.PaymentType, r.CompanyId): r.asDict() for r in df.collect()}


def check(got, wanted):
    assert set(got) == set(wanted)
    for key, row in wanted.items():
        assert {c: got[key][c] for c in row} == row, key


# "fixed" retained columns are the ones that equal the set intersection for all pairs.
FIXED = Options(retained_2ytd="fixed")


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("base", [date(2021, 8, 20), date(2021, 1, 1), date(2021, 7, 2)])
def test_daily_cube(make_inputs, base, hot):
    days = [base - timedelta(days=n) for n in (1, 1, 2, 9, 40, 80, 150, 300, 500, 900, 1150, 1400)]
    facts = random_facts(base.toordinal(), days, hot)
    inputs = make_inputs(facts, COMPANIES, [customer(k) for k in range(1, 13)])
    check(as_dict(daily_cube(inputs, base, LAUNCH, FIXED)), brute_force(facts, base))


def test_range_equals_single_days(make_inputs):
    """A range over a year's end, with quiet days and cells that come and go."""
    first, last = date(2020, 12, 29), date(2021, 1, 4)
    days = [first + timedelta(days=n) for n in (-1200, -700, -370, -200, -100, -30, -1, 0, 1, 5)]
    facts = random_facts(7, days)
    inputs = make_inputs(facts, COMPANIES, [customer(k) for k in range(1, 13)])
    for options in (FIXED, Options(two_month=True, dth_average="day")):
        backfilled = backfill_cube(inputs, first, last, LAUNCH, options).persist()
        got = as_dict(backfilled)
        single = {}
        for n in range((last - first).days + 1):
            base = first + timedelta(days=n + 1)
            single |= as_dict(daily_cube(inputs, base, LAUNCH, options))
            if options is FIXED and n in (0, 2, 3, 6):
                day = base - timedelta(days=1)
                check({k: v for k, v in got.items() if k[0].date() == day},
                      brute_force(facts, base))
        assert got == single


def test_range_before_and_across_the_launch(make_inputs):
    first, last = LAUNCH - timedelta(days=2), LAUNCH + timedelta(days=2)
    facts = random_facts(3, [first, LAUNCH, LAUNCH + timedelta(days=1)])
    inputs = make_inputs(facts, COMPANIES, [customer(k) for k in range(1, 13)])
    got = as_dict(backfill_cube(inputs, first, last, LAUNCH))
    single = {}
    for n in range(5):
        single |= as_dict(daily_cube(inputs, first + timedelta(days=n + 1), LAUNCH))
    assert got == single and len(single) > 0


def test_staged_equals_daily(make_inputs):
    base = date(2021, 8, 20)
    facts = random_facts(11, [base - timedelta(days=n) for n in (1, 2, 30, 200, 400, 1000)])
    inputs = make_inputs(facts, COMPANIES, [customer(k) for k in range(1, 13)])
    staged = Stages(inputs, base, LAUNCH).published
    assert as_dict(staged) == as_dict(daily_cube(inputs, base, LAUNCH))


def test_range_with_more_dimensions_equals_single_days(spark):
    """Product and customer type as dimensions, and a shifted hour, on the test tables."""
    from conftest import SF, rows_of

    from tidecube.operators.dimensions import COMPANY, CUSTOMER_TYPE, PAYMENT_TYPE, PRODUCT
    from tidecube.sources.testdata import ORDERS_LAUNCH, orders_inputs

    inputs = orders_inputs(spark, SF)
    first = date(2000, 9, 30)
    dimensions = (PAYMENT_TYPE, COMPANY, CUSTOMER_TYPE, PRODUCT)
    options = Options(dimensions=dimensions, hour_offset=5)
    got = backfill_cube(inputs, first, first + timedelta(days=1), ORDERS_LAUNCH, options)
    single = [
        row
        for n in (1, 2)
        for row in rows_of(
            daily_cube(inputs, first + timedelta(days=n), ORDERS_LAUNCH, options)
        )
    ]
    assert rows_of(got) == sorted(single, key=str)
    products = {r[0] for r in got.select("StandardizedProductName").distinct().collect()}
    assert products == {"Fatura Payment", "bill Payment", "Top-up", "NULL", "(Overall)"}


def test_a_range_over_three_years_equals_single_days(spark):
    """With the launch inside its first month and days at the edges of periods."""
    inputs = orders_inputs(spark, SF)
    launch, last = date(1997, 12, 10), date(2001, 1, 31)
    cube = backfill_cube(inputs, date(1997, 12, 1), last, launch).persist()
    days = [date(1998, 1, 1), date(1998, 7, 1), date(1999, 12, 31), date(2000, 1, 1),
            date(2000, 3, 15), last]
    filled = 0
    for day in days:
        own = cube.filter(F.to_date("DateHour") == F.lit(day))
        single = daily_cube(inputs, day + timedelta(days=1), launch)
        got = rows_of(own)
        assert got == rows_of(single), day
        filled += bool(got)
    assert filled >= 4  # nobody has been active on the first of January
    cube.unpersist()
