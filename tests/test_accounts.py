"""Counts of what the joins do."""

from __future__ import annotations

from datetime import date

from conftest import customer, rows_of, tx

from tidecube import Accounts, daily_cube, read_slice, replace_days, run_day

LAUNCH, BASE = date(2020, 1, 20), date(2021, 3, 6)


def test_joins_are_accounted(spark, make_inputs, tmp_path):
    facts = [
        tx(1, 1, 5, "2021-03-01 10:00:00", 0), tx(2, 1, 5, "2021-03-01 10:30:00", 0),  # company 0 is there twice
        tx(3, 2, 5, "2021-03-05 10:00:00", 1), tx(4, 2, 5, "2021-03-05 11:00:00", None),
        tx(5, 3, 5, "2021-03-05 10:00:00", 1), tx(6, 3, 5, "2021-02-05 10:00:00", 9),  # customer 3 is there twice
        tx(7, 8, 5, "2021-03-05 10:00:00", 1), tx(8, 8, 5, "2021-03-05 10:00:00", 2),  # nobody knows customer 8
        tx(9, 1, 5, "2020-03-05 10:00:00", 1), tx(10, 1, 5, "2021-03-05 10:00:00", 1, cancelled=1),
    ]
    inputs = make_inputs(facts, [(0, 1), (0, 2), (1, 1), (2, None)], [customer(k) for k in (1, 2, 3, 3)])
    accounts, target = Accounts(), str(tmp_path / "target")
    written = run_day(inputs, BASE, target, LAUNCH, accounts=accounts)
    assert accounts.report == {
        "eligible": 8, "repeated_by_company": 2, "without_company": 1, "without_payment_type": 3,
        "unknown_customer": 2, "repeated_by_customer": 2, "counted": 10,
    }
    day = date(2021, 3, 5)
    rows = read_slice(spark, target, day, day)
    assert written == {day: rows.count()}
    assert rows_of(rows.drop("day")) == rows_of(daily_cube(inputs, BASE, LAUNCH))


def test_nothing_to_account(make_inputs, tmp_path):
    accounts = Accounts()
    run_day(make_inputs([], [], []), BASE, str(tmp_path / "target"), LAUNCH,
            write=replace_days, accounts=accounts)
    assert set(accounts.report.values()) == {0}
