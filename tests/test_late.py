"""Late facts and the reported days they touch."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import customer, rows_of, tx
from hypothesis import given
from hypothesis import strategies as st

from tidecube import Options, backfill_cube, daily_cube, read_days, refresh
from tidecube.operators.dimensions import COMPANY, PAYMENT_TYPE, PRODUCT
from tidecube.plans import late
from tidecube.plans.late import day_ranges, fact_marks, touched_days

LAUNCH = date(2015, 1, 20)
COMPANIES = [(0, 1), (1, 1), (2, 2)]
PEOPLE = [customer(k) for k in range(12)]
END = date(2021, 12, 31)


@pytest.fixture(scope="module")
def facts():
    r = random.Random(5)
    days = [LAUNCH + timedelta(days=r.randrange((END - LAUNCH).days)) for _ in range(150)]
    return [tx(i, r.randrange(8), 10, f"{d} {r.randrange(24):02d}:20:00", r.randrange(2)) for i, d in enumerate(days)]


@pytest.fixture(scope="module")
def inputs(make_inputs, facts):
    def made(more=(), without=()):
        rows = [f for f in facts if f[0] not in without]
        return make_inputs([*rows, *more], COMPANIES, PEOPLE)

    return made


@given(st.sets(st.dates(date(2020, 1, 1), date(2020, 3, 1))))
def test_day_ranges(days):
    ranges = day_ranges(days)
    assert {a + timedelta(days=i) for a, b in ranges for i in range((b - a).days + 1)} == days
    assert all(y[0] - x[1] > timedelta(days=1) for x, y in zip(ranges, ranges[1:], strict=False))


def all_days(first=date(2016, 1, 1), last=END):
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def touched(inputs, changed, days=None):
    end = END + timedelta(days=1)
    return set(touched_days(fact_marks(inputs(), LAUNCH, end), fact_marks(changed, LAUNCH, end), days or all_days()))


def test_reach_of_a_late_fact(facts, inputs):
    whole = all_days()
    seen = next(f for f in facts if f[3].year == 2017 and f[3].month < 6)
    # A pair that the year has anyway: the rest of its year.
    again = tx(900, seen[1], 5, "2017-06-10 08:00:00", seen[4])
    assert touched(inputs, inputs([again])) == {d for d in whole if date(2017, 6, 10) <= d <= date(2017, 12, 31)}
    # A pair never seen: all days from then on.
    new = tx(901, 11, 5, "2017-06-10 08:00:00", 2)
    assert touched(inputs, inputs([new])) == {d for d in whole if d >= date(2017, 6, 10)}
    # A pair known from before and not of this year: two more years.
    old = [tx(902, 10, 5, "2015-05-01 08:00:00", 2)]
    before = lambda more=(), without=(): inputs([*old, *more], without)
    got = touched(before, before([tx(903, 10, 5, "2017-06-10 08:00:00", 2)]))
    assert got == {d for d in whole if date(2017, 6, 10) <= d <= date(2019, 12, 31)}
    # Seen later, and now earlier: until the later one would have been known as well.
    got = touched(before, before([tx(904, 10, 5, "2015-03-01 08:00:00", 2)]), all_days(date(2015, 1, 21)))
    assert got == {d for d in all_days(date(2015, 1, 21)) if date(2015, 3, 1) <= d <= date(2015, 12, 31)}
    # What is not eligible, or comes after the last reported day, touches nothing.
    assert touched(inputs, inputs([tx(905, 3, 5, "2017-06-10 08:00:00", 1, cancelled=1)])) == set()
    assert touched(inputs, inputs([new]), [date(2016, 5, 5)]) == set()


@pytest.mark.parametrize("when,days", [
    (date(2016, 3, 1), [date(2016, 2, 29), date(2018, 12, 31), date(2019, 6, 1)]),
    (date(2018, 11, 11), [date(2018, 11, 11), date(2020, 1, 1)]),
])
def test_every_day_that_differs_is_touched(facts, inputs, when, days):
    r = random.Random(when.toordinal())
    changed = inputs([tx(950, r.randrange(12), 7, f"{when} 11:00:00", r.randrange(3))], [facts[when.year % 9][0]])
    got = touched(inputs, changed, days)
    for d in days:
        if rows_of(daily_cube(inputs(), d + timedelta(days=1), LAUNCH)) != rows_of(
            daily_cube(changed, d + timedelta(days=1), LAUNCH)
        ):
            assert d in got, d


def test_refresh_equals_a_full_rerun(spark, inputs, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    first, last = date(2020, 12, 28), date(2021, 1, 3)
    assert set(refresh(inputs(), target, first, last, LAUNCH)) == set(all_days(first, last))
    assert refresh(inputs(), target, first, last, LAUNCH) == {}
    more = [tx(960, 3, 5, "2021-01-02 08:00:00", 1), tx(961, 11, 5, "2021-01-03 08:00:00", 1)]
    runs = []
    real = late.run_range
    monkeypatch.setattr(late, "run_range", lambda *a: runs.append(a[1:3]) or real(*a))
    done = refresh(inputs(more), target, first, last, LAUNCH)
    assert runs == [(date(2021, 1, 2), date(2021, 1, 3))] and set(done) == {date(2021, 1, 2), date(2021, 1, 3)}
    got = rows_of(read_days(spark, target, first, last).drop("day"))
    assert got == rows_of(backfill_cube(inputs(more), first, last, LAUNCH))
    # Facts taken away again, and a day more to report.
    done = refresh(inputs(), target, first, date(2021, 1, 4), LAUNCH)
    assert set(done) == set(all_days(date(2021, 1, 2), date(2021, 1, 4)))
    got = rows_of(read_days(spark, target, first, date(2021, 1, 4)).drop("day"))
    assert got == rows_of(backfill_cube(inputs(), first, date(2021, 1, 4), LAUNCH))


def test_a_refresh_that_dies_is_repeated(spark, inputs, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    first, last = date(2020, 6, 1), date(2020, 6, 2)
    refresh(inputs(), target, first, last, LAUNCH)
    changed = inputs([tx(970, 2, 5, "2020-05-02 08:00:00", 1)])
    real = late.run_range

    def dies(*args):
        real(*args)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(late, "run_range", dies)
        refresh(changed, target, first, last, LAUNCH)
    assert set(refresh(changed, target, first, last, LAUNCH)) == {first, last}
    assert rows_of(read_days(spark, target, first, last).drop("day")) == rows_of(
        backfill_cube(changed, first, last, LAUNCH))
    with pytest.raises(ValueError, match="computed with"):
        refresh(changed, target, first, last, LAUNCH, Options(dimensions=(PAYMENT_TYPE, COMPANY, PRODUCT)))


def test_no_facts_at_all(make_inputs, tmp_path):
    nobody = make_inputs([], [], [])
    day = date(2020, 6, 1)
    assert refresh(nobody, str(tmp_path), day, day, LAUNCH) == {day: 0}
    assert refresh(nobody, str(tmp_path), day, day, LAUNCH) == {}
