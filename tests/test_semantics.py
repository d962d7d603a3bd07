"""Small cases whose results can be read off the input."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import at, customer, tx
from pyspark.sql import functions as F

from tidecube import Options, backfill_cube, daily_cube
from tidecube.operators.dimensions import COMPANY, CUSTOMER_TYPE, PAYMENT_TYPE, PRODUCT
from tidecube.operators.enrich import base_transactions, payments
from tidecube.plans.staged import Stages

LAUNCH = date(2020, 1, 20)
BASE = date(2021, 11, 16)
DAY = "2021-11-15"


def cell(cube, hour, payment_type=10000, company=10000):
    rows = cube.filter(
        (F.col("DateHour") == F.lit(f"{DAY} {hour:02d}:00:00").cast("timestamp_ntz"))
        & (F.col("PaymentType") == payment_type)
        & (F.col("CompanyId") == company)
    ).collect()
    assert len(rows) == 1
    return rows[0]


def test_only_eligible_transactions_of_known_customers_count(make_inputs):
    inputs = make_inputs(
        [
            tx(1, 1, 10, f"{DAY} 05:00:00", 1),
            tx(2, 1, 10, f"{DAY} 05:00:00", 1, entry=18),
            tx(3, 1, 10, f"{DAY} 05:00:00", 1, cancelled=1),
            tx(4, 1, 10, f"{DAY} 05:00:00", 1, operator=9),
            tx(5, 99, 10, f"{DAY} 05:00:00", 1),
            tx(6, 1, 10, "2020-01-19 23:59:59", 1),
            tx(7, 1, 10, "2020-01-20 00:00:00", 1),
            tx(8, 1, 10, f"{DAY} 23:59:59", 1),
            tx(9, 1, 10, "2021-11-16 00:00:00", 1),
        ],
        [(1, 2)],
        [customer(1)],
    )
    rows = base_transactions(inputs, BASE, LAUNCH).select("Id").collect()
    assert sorted(r.Id for r in rows) == [1, 7, 8]


def test_missing_dimension_members(make_inputs):
    inputs = make_inputs(
        [
            tx(1, 1, 10, f"{DAY} 05:00:00", None),
            tx(2, 1, 10, f"{DAY} 05:00:00", 7),
            tx(3, 1, 10, f"{DAY} 05:00:00", 8),
            tx(4, 1, 10, f"{DAY} 05:00:00", 9),
        ],
        [(8, None), (9, 3)],
        [customer(1)],
    )
    rows = base_transactions(inputs, BASE, LAUNCH).select("Id", "PaymentType", "CompanyId")
    assert sorted(map(tuple, rows.collect())) == [
        (1, -80, -80), (2, -80, 7), (3, -80, 8), (4, 3, 9)
    ]


@pytest.mark.parametrize("company, payment_type", [(10000, 1), (-80, 1), (5, 10000), (5, -80)])
def test_reserved_ids_fail_the_job(make_inputs, company, payment_type):
    inputs = make_inputs(
        [tx(1, 1, 10, f"{DAY} 05:00:00", company)], [(company, payment_type)], [customer(1)]
    )
    with pytest.raises(Exception, match="reserved id"):
        daily_cube(inputs, BASE, LAUNCH).collect()


@pytest.mark.parametrize("dimension", ["type", "product", "missing product"])
def test_reserved_members_of_extra_dimensions_fail_the_job(spark, make_inputs, dimension):
    by_type = dimension == "type"
    label = {"product": "(Overall)", "missing product": "NULL"}.get(dimension, "Top-up")
    inputs = make_inputs(
        [tx(1, 1, 7, f"{DAY} 05:00:00", 1)], [], [customer(1)],
        [(1, at("2021-01-01 00:00:00"), 10000 if by_type else 1)],
    )
    inputs = replace(
        inputs,
        transactions=inputs.transactions.withColumn("StandardizedProductName", F.lit(label)),
    )
    options = Options(dimensions=(PAYMENT_TYPE, COMPANY, CUSTOMER_TYPE if by_type else PRODUCT))
    day = BASE - timedelta(days=1)
    for cube in (
        daily_cube(inputs, BASE, LAUNCH, options),
        Stages(inputs, BASE, LAUNCH, options).published,
        backfill_cube(inputs, day, day, LAUNCH, options),
    ):
        with pytest.raises(Exception, match="reserved id"):
            cube.collect()


def test_a_null_customer_type_ends_the_one_before(make_inputs):
    types = [(1, at("2021-11-01 00:00:00"), 5), (1, at("2021-11-03 00:00:00"), None),
             (1, at("2021-11-05 00:00:00"), None), (1, at("2021-11-05 00:00:00"), 6)]
    inputs = make_inputs(
        [tx(d, 1, 1, f"2021-11-{d:02d} 10:00:00", 1) for d in (2, 3, 4, 5)], [], [customer(1)],
        types,
    )
    options = Options(dimensions=(PAYMENT_TYPE, COMPANY, CUSTOMER_TYPE))
    rows = payments(inputs, LAUNCH, BASE, options, "Id").collect()
    assert {r.Id: r.CustomerType for r in rows} == {2: 5, 3: -80, 4: -80, 5: 6}


def test_age_and_tenure(make_inputs):
    born = ["1899-12-31", "1900-01-01", "2019-12-31", "2020-01-01", None]
    inputs = make_inputs(
        [tx(i, i, 10, f"{DAY} 05:00:00", 1) for i in range(5)],
        [],
        [customer(i, f"{DAY} 04:59:59" if i else "2021-11-16 05:00:01", b)
         for i, b in enumerate(born)],
    )
    rows = {
        r.CustomerKey: (r.AgeDays, r.TenureMinutes)
        for r in base_transactions(inputs, BASE, LAUNCH).collect()
    }
    day = date.fromisoformat(DAY)
    assert rows == {
        0: (None, -1440),  # tenure is not guarded
        1: ((day - date(1900, 1, 1)).days, 1),  # one minute boundary, one second apart
        2: ((day - date(2019, 12, 31)).days, 1),
        3: (None, 1),
        4: (None, 1),
    }


def test_volume_nets_inside_a_customer_hour_and_is_not_additive(make_inputs):
    inputs = make_inputs(
        [
            tx(1, 1, 100, f"{DAY} 05:10:00", 1),
            tx(2, 1, -30, f"{DAY} 05:20:00", 2),
            tx(3, 1, -50, f"{DAY} 06:00:00", 1),
            tx(4, 2, 5, f"{DAY} 05:00:00", 2),
        ],
        [(1, 7), (2, 7)],
        [customer(1), customer(2)],
    )
    cube = daily_cube(inputs, BASE, LAUNCH).persist()
    assert cell(cube, 5, 7, 1).TxVolumeHourly == 100
    assert cell(cube, 5, 7, 2).TxVolumeHourly == 35
    assert cell(cube, 5).TxVolumeHourly == 75
    assert cell(cube, 6).TxVolumeDTH == Decimal(125)
    assert cell(cube, 5).UUHourly == 2 and cell(cube, 5).TxCountHourly == 3


def test_averages_weigh_customer_hours(make_inputs):
    """Two transactions in an hour weigh as one, two hours weigh twice."""
    inputs = make_inputs(
        [
            tx(1, 1, 1, f"{DAY} 05:10:00", 1),
            tx(2, 1, 1, f"{DAY} 05:20:00", 1),
            tx(3, 1, 1, f"{DAY} 06:00:00", 1),
            tx(4, 2, 1, f"{DAY} 06:00:00", 1),
        ],
        [],
        [customer(1, born="1990-01-01"), customer(2, born="2000-01-01")],
    )
    day = date.fromisoformat(DAY)
    old, young = ((day - date(y, 1, 1)).days for y in (1990, 2000))
    cube = daily_cube(inputs, BASE, LAUNCH).persist()
    assert cell(cube, 5).AvgAgeHourly == old / 365.25
    assert cell(cube, 6).AvgAgeHourly == (old + young) / (2 * 365.25)
    assert cell(cube, 6).AvgAgeMTD == (2 * old + young) / (3 * 365.25)
    quiet = cell(cube, 7)
    assert quiet.AvgAgeHourly is None and quiet.AvgTenureByYearHourly is None
    assert quiet.AvgAgeMTD == (2 * old + young) / (3 * 365.25)
    assert (quiet.UUHourly, quiet.TxCountHourly, quiet.TxVolumeHourly) == (0, 0, 0)


def test_day_averages_follow_the_month_from_the_first_activity(make_inputs):
    inputs = make_inputs(
        [tx(1, 1, 1, "2021-11-02 08:00:00", 1), tx(2, 2, 1, f"{DAY} 06:00:00", 1)],
        [],
        [customer(1, born="1990-01-01"), customer(2, born="2000-01-01")],
    )
    first = (date(2021, 11, 2) - date(1990, 1, 1)).days
    second = (date.fromisoformat(DAY) - date(2000, 1, 1)).days
    cube = daily_cube(inputs, BASE, LAUNCH).persist()
    assert cell(cube, 5).AvgAgeDTH == 0
    assert cell(cube, 5).AvgAgeMTD == first / 365.25
    assert cell(cube, 6).AvgAgeDTH == (first + second) / (2 * 365.25)
    own = daily_cube(inputs, BASE, LAUNCH, Options(dth_average="day"))
    assert cell(own, 6).AvgAgeDTH == second / 365.25
    assert cell(own, 5).AvgAgeDTH == 0


def test_cells_without_activity_this_year_are_absent(make_inputs):
    inputs = make_inputs(
        [tx(1, 1, 1, "2020-12-31 23:00:00", 1), tx(2, 1, 1, "2021-01-01 00:00:00", 2)],
        [(1, 5), (2, 5)],
        [customer(1)],
    )
    cube = daily_cube(inputs, BASE, LAUNCH)
    companies = {r.CompanyId for r in cube.select("CompanyId").distinct().collect()}
    assert companies == {2, 10000}
    assert cube.count() == 4 * 24
    last = cell(cube, 23)
    assert (last.UUYTD, last.UU2YTD, last.UUMTD) == (1, 1, 0)


def test_nothing_before_means_null_and_rate_zero(make_inputs):
    inputs = make_inputs([tx(1, 1, 1, "2021-10-05 01:00:00", 1)], [], [customer(1)])
    row = cell(daily_cube(inputs, BASE, LAUNCH), 12)
    assert row.HourlyContributerUUThisMonthToTheQuarter == 0
    assert row.HourlyRetainedUUThisMonthWithinTheQuarter == 0
    assert row.HourlyRetentionRateThisMonthWithinTheQuarter == 0
    assert row.HourlyContributerUUThisQuarterToTheSemiYear is None
    assert row.HourlyRetainedUUThisQuarterWithinTheSemiYear is None
    assert row.HourlyRetentionRateThisQuarterWithinTheSemiYear == 0


def test_repeated_dimension_keys_multiply_transactions(make_inputs):
    inputs = make_inputs(
        [tx(1, 1, 10, f"{DAY} 05:00:00", 1)],
        [(1, 3), (1, 3), (1, 4)],
        [customer(1, born="1980-01-01"), customer(1, born="1970-01-01")],
    )
    cube = daily_cube(inputs, BASE, LAUNCH).persist()
    top = cell(cube, 5)
    assert (top.TxCountHourly, top.TxVolumeHourly, top.UUHourly) == (6, 60, 1)
    assert cell(cube, 5, 3, 1).TxCountHourly == 4
    assert top.AvgAgeHourly == (date.fromisoformat(DAY) - date(1970, 1, 1)).days / 365.25


def test_hour_offset_moves_the_hour_and_not_the_date(make_inputs):
    inputs = make_inputs([tx(1, 1, 10, f"{DAY} 23:00:00", 1)], [], [customer(1)])
    cube = daily_cube(inputs, BASE, LAUNCH, Options(hour_offset=3)).persist()
    assert cell(cube, 2).UUHourly == 1 and cell(cube, 2).TxCountDTH == 1
    assert cell(cube, 1).UUDTH == 0 and cell(cube, 23).UUHourly == 0


def test_customer_type_as_of_the_transaction(make_inputs):
    types = [
        (1, at("2021-11-01 00:00:00"), 1),
        (1, at(f"{DAY} 05:00:00"), 2),
        (1, at(f"{DAY} 05:00:00"), 3),
        (1, at(f"{DAY} 07:00:00"), 4),
        (2, at("2021-12-01 00:00:00"), 9),
    ]
    inputs = make_inputs(
        [
            tx(1, 1, 1, "2021-10-31 10:00:00", 1),
            tx(2, 1, 1, "2021-11-02 10:00:00", 1),
            tx(3, 1, 1, f"{DAY} 04:59:59", 1),
            tx(4, 1, 1, f"{DAY} 05:00:00", 1),
            tx(5, 1, 1, f"{DAY} 23:00:00", 1),
            tx(6, 2, 1, f"{DAY} 23:00:00", 1),
        ],
        [],
        [customer(1), customer(2)],
        types,
    )
    options = Options(dimensions=(PAYMENT_TYPE, COMPANY, CUSTOMER_TYPE))
    rows = payments(inputs, LAUNCH, BASE, options, "Id").collect()
    assert {r.Id: r.CustomerType for r in rows} == {2: 1, 3: 1, 4: 3, 5: 4}


def test_dense_frame_keeps_quiet_hours_empty_until_filled(make_inputs):
    inputs = make_inputs(
        [tx(1, 1, 1, "2021-11-02 08:00:00", 1), tx(2, 1, 1, f"{DAY} 06:00:00", 1)],
        [],
        [customer(1)],
    )
    stages = Stages(inputs, BASE, LAUNCH)
    dense, filled = cell(stages.dense_frame, 6), cell(stages.carry_forward, 6)
    assert (dense.UUDTH, dense.UUMTD, dense.TxCountMTD) == (1, None, 2)
    assert (filled.UUDTH, filled.UUMTD, filled.TxCountMTD) == (1, 1, 2)
    assert cell(stages.dense_frame, 3).TxCountMTD is None
    assert cell(stages.carry_forward, 3).TxCountMTD == 1
