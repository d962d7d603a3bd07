"""Writing days to the target and reading them back."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from conftest import COMPANIES, CUSTOMERS, TRANSACTIONS, customer, rows_of, tx

from tidecube import Options, daily_cube, read_inputs, read_slice, run_day, run_range
from tidecube.operators.dimensions import COMPANY, CUSTOMER_TYPE, PAYMENT_TYPE, PRODUCT

LAUNCH = date(2020, 1, 20)


@pytest.fixture
def inputs(make_inputs):
    facts = [tx(i, i % 5, 10 + i, f"2021-03-{1 + i % 9:02d} {i % 24:02d}:00:00", i % 3)
             for i in range(60)]
    return make_inputs(facts, [(0, 1), (1, 1), (2, 2)], [customer(k) for k in range(5)])


def test_rerun_replaces_only_its_day(spark, inputs, tmp_path):
    target = str(tmp_path / "target")
    first, last = date(2021, 3, 4), date(2021, 3, 6)
    written = run_range(inputs, first, last, target, LAUNCH)
    assert set(written) == {first + timedelta(days=i) for i in range(3)}
    before = rows_of(read_slice(spark, target, first, last))
    again = run_day(inputs, date(2021, 3, 6), target, LAUNCH)
    assert again == {date(2021, 3, 5): written[date(2021, 3, 5)]}
    assert rows_of(read_slice(spark, target, first, last)) == before
    day = read_slice(spark, target, last, last).drop("day")
    assert rows_of(day) == rows_of(daily_cube(inputs, date(2021, 3, 7), LAUNCH))


def test_day_that_became_empty_is_emptied(spark, inputs, make_inputs, tmp_path):
    target = str(tmp_path / "target")
    first, last = date(2021, 3, 4), date(2021, 3, 5)
    run_range(inputs, first, last, target, LAUNCH)
    nobody = make_inputs([], [], [])
    assert run_day(nobody, date(2021, 3, 6), target, LAUNCH) == {last: 0}
    assert read_slice(spark, target, last, last).count() == 0
    assert read_slice(spark, target, first, first).count() > 0
    run_day(inputs, date(2021, 3, 6), target, LAUNCH)
    assert read_slice(spark, target, last, last).count() > 0


def test_a_table_as_target(spark, inputs, make_inputs):
    first, last = date(2021, 3, 4), date(2021, 3, 6)
    written = run_range(inputs, first, last, "cube_target", LAUNCH)
    assert set(written) == {first + timedelta(days=i) for i in range(3)} and min(written.values())
    before = rows_of(read_slice(spark, "cube_target", first, last))
    assert run_day(inputs, date(2021, 3, 6), "cube_target", LAUNCH) == {
        date(2021, 3, 5): written[date(2021, 3, 5)]
    }
    assert rows_of(read_slice(spark, "cube_target", first, last)) == before
    nobody = make_inputs([], [], [])
    empty = run_range(nobody, first, date(2021, 3, 5), "cube_target", LAUNCH)
    assert set(empty.values()) == {0}
    days = {r.day for r in spark.read.table("cube_target").select("day").distinct().collect()}
    assert days == {last}
    spark.sql("DROP TABLE cube_target")


def test_command_line_options():
    from tidecube.__main__ import options_of, parser

    needed = ["--transactions", "t", "--companies", "c", "--customers", "u", "--target", "x"]
    assert options_of(parser().parse_args(needed)) == Options()
    args = parser().parse_args(
        [*needed, "--customer-types", "h", "--by-customer-type", "--by-product", "--two-month",
         "--dth-average", "day", "--retained-2ytd", "fixed", "--hour-offset", "3",
         "--day-column", "d", "--launch", "2020-01-20", "--base-day", "2021-03-06",
         "--first", "2021-03-04", "--last", "2021-03-05"]
    )
    assert args.customer_types == "h" and args.first == date(2021, 3, 4)
    assert options_of(args) == Options(
        "day", "fixed", True, 3, (PAYMENT_TYPE, COMPANY, PRODUCT, CUSTOMER_TYPE)
    )


def test_slice_prunes_days_and_pushes_members(spark, inputs, tmp_path, capsys):
    target = str(tmp_path / "target")
    day = date(2021, 3, 5)
    run_range(inputs, day - timedelta(days=1), day, target, LAUNCH)
    one = read_slice(spark, target, day, day, PaymentType=10000, CompanyId=2)
    assert one.count() == 24
    one.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "EqualTo(PaymentType,10000)" in plan and "EqualTo(CompanyId,2)" in plan


def test_inputs_from_files_with_a_day_partition(spark, inputs, tmp_path, capsys):
    from pyspark.sql import functions as F

    paths = {n: str(tmp_path / n) for n in ("transactions", "companies", "customers")}
    inputs.transactions.withColumn("CreatedDay", F.to_date("CreatedAt")).write.partitionBy(
        "CreatedDay"
    ).parquet(paths["transactions"])
    inputs.companies.write.parquet(paths["companies"])
    inputs.customers.write.parquet(paths["customers"])
    files = read_inputs(spark, **paths, day_column="CreatedDay")
    base = date(2021, 3, 6)
    cube = daily_cube(files, base, LAUNCH)
    assert rows_of(cube) == rows_of(daily_cube(inputs, base, LAUNCH))
    cube.explain("formatted")
    assert "PartitionFilters: [isnotnull(CreatedDay" in capsys.readouterr().out


def test_inputs_are_checked(spark, make_inputs):
    from tidecube import Inputs

    empty = [spark.createDataFrame([], s) for s in (TRANSACTIONS, COMPANIES, CUSTOMERS)]
    with pytest.raises(ValueError, match="PaymentType"):
        Inputs(empty[0], empty[1].drop("PaymentType"), empty[2])
    zoned = empty[0].withColumn("CreatedAt", empty[0].CreatedAt.cast("timestamp"))
    with pytest.raises(ValueError, match="timestamp_ntz"):
        Inputs(zoned, *empty[1:])
