"""The shape of the physical plans."""

from __future__ import annotations

import re
from datetime import date, timedelta

import pytest
from conftest import SF, at, rows_of

from tidecube import Options, backfill_cube, daily_cube, read_inputs
from tidecube.operators.dimensions import COMPANY, CUSTOMER_TYPE, PAYMENT_TYPE
from tidecube.operators.enrich import payments
from tidecube.sources.testdata import ORDERS_LAUNCH, orders_inputs

BASE = date(2000, 11, 16)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    inputs = orders_inputs(spark, SF)
    paths = {}
    for name in ("transactions", "companies", "customers", "customer_types"):
        paths[name] = str(folder / name)
        getattr(inputs, name).write.parquet(paths[name])
    return read_inputs(spark, **paths)


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan_of(df, capsys) -> str:
    df.explain("formatted")
    return capsys.readouterr().out


def cubes(inputs):
    return {
        "daily": daily_cube(inputs, BASE, ORDERS_LAUNCH),
        "range": backfill_cube(inputs, BASE - timedelta(days=9), BASE, ORDERS_LAUNCH),
    }


def test_filters_and_columns_reach_the_scan(files, capsys):
    for cube in cubes(files).values():
        plan = plan_of(cube, capsys)
        facts = [
            (filters, schema)
            for filters, schema in re.findall(
                r"PushedFilters: (\[.*?\])\nReadSchema: (.*)", plan
            )
            if "EntryType" in schema
        ]
        assert len(facts) == 2
        for filters, schema in facts:
            for part in ("EqualTo(EntryType,17)", "EqualTo(IsCancellation,0)",
                         "IsNull(OperatorCustomerKey)", "GreaterThanOrEqual(CreatedAt,",
                         "LessThan(CreatedAt,"):
                assert part in filters
        # Users need no amounts and totals need this year only.
        assert sorted("Amount" in schema for _, schema in facts) == [False, True]
        for filters, schema in facts:
            if "Amount" in schema:
                assert "GreaterThanOrEqual(CreatedAt,2000-01-01T00:00" in filters


def test_no_cross_joins_python_or_single_partitions(files, no_broadcast, capsys):
    for cube in cubes(files).values():
        plan = plan_of(cube, capsys)
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition",
                     "ObjectHashAggregate", "SortAggregate", "Expand"):
            assert word not in plan, word


def test_levels_multiply_after_the_shuffle(files, no_broadcast, capsys):
    """No shuffle follows the multiplication into cube levels until rows are summed up."""
    for cube in cubes(files).values():
        plan = plan_of(cube, capsys)
        tree = plan[: plan.index("\n\n")]
        lines = [re.sub(r"[\s:+\-*|]*", "", line, count=1) for line in tree.splitlines()]
        scans = [i for i, line in enumerate(lines) if line.startswith("Scan")]
        generates = [i for i, line in enumerate(lines) if line.startswith("Generate")]
        for i in generates:
            above = [line.split()[0] for line in lines[:i]][::-1]
            if lines[i + 1].startswith("Exchange") or "SortMergeJoin" in lines[i + 1]:
                exchange = above.index("Exchange") if "Exchange" in above else len(above)
                assert above[:exchange].count("HashAggregate") >= 2
        assert len(scans) == 6


def test_results_do_not_depend_on_the_join_strategy(spark, files, no_broadcast):
    shuffled = {name: rows_of(cube) for name, cube in cubes(files).items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    for name, cube in cubes(files).items():
        assert rows_of(cube) == shuffled[name]


@pytest.fixture
def hot(spark, tmp_path, make_inputs):
    """Facts in files of which one customer, in one month, has most, and how joins see that."""
    from conftest import customer, tx

    facts = [tx(i, i % 40 if i % 4 == 0 else 7, 10, f"2021-03-{1 + i % 28:02d} {i % 24:02d}:00:00",
                i % 900) for i in range(6000)]
    types = [(k, at(f"2021-03-{d:02d} 09:00:00"), d) for k in range(40) for d in (1, 9, 20)]
    made = make_inputs(facts, [(i, i % 3) for i in range(900)],
                       [customer(k) for k in range(40)], types)
    paths = {n: str(tmp_path / n) for n in ("transactions", "companies", "customers", "customer_types")}
    for name, path in paths.items():
        getattr(made, name).repartition(8).write.parquet(path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield read_inputs(spark, **paths)
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_skewed_joins_are_split(hot):
    """The final plan splits joins of a hot customer; the users path has one row per company."""
    cube = daily_cube(hot, date(2021, 3, 29), date(2020, 1, 1))
    cube.collect()
    assert "skew=true" in cube._jdf.queryExecution().executedPlan().toString()


def test_customer_type_join_is_split_and_reads_facts_once(hot, capsys):
    options = Options(dimensions=(PAYMENT_TYPE, COMPANY, CUSTOMER_TYPE))
    rows = payments(hot, date(2020, 1, 1), date(2021, 3, 29), options, "Id")
    plan = plan_of(rows, capsys)
    assert len(re.findall(r"ReadSchema: .*EntryType", plan)) == 1
    rows.collect()
    final = rows._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final
    # The window over the history is below the join, none is over the facts.
    assert "Window" not in final.split("SortMergeJoin")[0]
