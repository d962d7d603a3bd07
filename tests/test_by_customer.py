"""Facts and customers stored by customer."""

from __future__ import annotations

import re
import uuid
from dataclasses import replace
from datetime import date, timedelta

import pytest
from conftest import SF, customer, rows_of, tx
from pyspark.sql import functions as F

from tidecube import daily_cube
from tidecube.functions.dates import midnight
from tidecube.sources import by_customer
from tidecube.sources.by_customer import (
    DAY,
    MONTH,
    buckets_of,
    keep_by_customer,
    read_by_customer,
    replace_facts,
    times_mean,
)
from tidecube.sources.testdata import orders_inputs

BASE = date(2000, 11, 16)
LAUNCH = date(2000, 10, 1)


def names():
    return f"facts_{uuid.uuid4().hex}", f"customers_{uuid.uuid4().hex}"


@pytest.fixture(scope="module", params=[MONTH, DAY])
def kept(request, spark, tmp_path_factory):
    """Last year's facts, which make few files by day too."""
    inputs = orders_inputs(spark, SF)
    recent = inputs.transactions.filter(F.col("CreatedAt").between(midnight(LAUNCH), midnight(BASE)))
    inputs = replace(inputs, transactions=recent, companies=F.broadcast(inputs.companies))
    facts, customers = names()
    keep_by_customer(inputs, facts, customers, 4, str(tmp_path_factory.mktemp("kept")), request.param)
    return inputs, read_by_customer(spark, facts, customers, inputs.companies)


@pytest.fixture
def no_broadcast(spark):
    """Nothing but what is marked is broadcast, as where customers are many."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def below(tree: list[str], at: int) -> list[str]:
    """The operators of a plan tree's lines below one of them."""
    depth = [len(re.match(r"[\s:+\-*|]*(\(\d+\)\s*)?", line)[0]) for line in tree]
    out = []
    for i in range(at + 1, len(tree)):
        if depth[i] <= depth[at]:
            break
        out.append(tree[i])
    return out


def test_the_customer_joins_move_no_rows(kept, no_broadcast, capsys):
    plans = {}
    for name, inputs in (("plain", kept[0]), ("kept", kept[1])):
        daily_cube(inputs, BASE, LAUNCH).explain("simple")
        tree = capsys.readouterr().out.splitlines()
        joins = [i for i, line in enumerate(tree) if "SortMergeJoin" in line]
        assert len(joins) == 2  # with attributes for totals, semi for users
        plans[name] = [sum("Exchange hashpartitioning" in x for x in below(tree, i)) for i in joins]
        if name == "kept":
            assert sum("Bucketed: true" in line for line in tree) == 4
            assert sum("PartitionFilters: [isnotnull(Created" in line for line in tree) == 2
    assert plans["kept"] == [0, 0]
    assert all(n > 0 for n in plans["plain"])


def test_cubes_are_equal(kept, no_broadcast):
    want, got = (rows_of(daily_cube(x, BASE, LAUNCH)) for x in kept)
    assert got == want and len(got) > 0


def small(make_inputs, facts):
    return make_inputs(facts, [(1, 5), (2, 6)], [customer(k) for k in range(60)])


def fact(i, key, day=1, amount=10):
    return tx(i, key, amount, f"2021-03-{day:02d} 08:00:00", 1 + i % 2)


def test_a_hot_customer_is_read_without_buckets(spark, make_inputs, no_broadcast, tmp_path, capsys):
    """One customer has most facts: files are plain then, and the cube is the same."""
    inputs = small(make_inputs, [fact(i, 7 if i % 5 else i % 60, 1 + i % 9) for i in range(500)])
    facts, customers = names()
    keep_by_customer(inputs, facts, customers, 16, str(tmp_path))
    assert times_mean(spark, facts) > by_customer.MOST_TIMES_MEAN
    plans = []
    for limit in (by_customer.MOST_TIMES_MEAN, 16.0):
        got = read_by_customer(spark, facts, customers, inputs.companies, most_times_mean=limit)
        cube = daily_cube(got, date(2021, 3, 10), date(2020, 1, 1))
        cube.explain("simple")
        plans.append(capsys.readouterr().out)
        assert rows_of(cube) == rows_of(daily_cube(inputs, date(2021, 3, 10), date(2020, 1, 1)))
    facts_scans = [[x for x in plan.splitlines() if "EntryType" in x and "FileScan" in x] for plan in plans]
    assert not any("Bucketed: true" in x for x in facts_scans[0])
    assert len(facts_scans[0]) == 2 and all("Bucketed: true" in x for x in facts_scans[1])


def test_one_file_per_day_and_bucket(spark, make_inputs, tmp_path):
    inputs = small(make_inputs, [fact(i, i % 60, 1 + i % 3) for i in range(300)])
    facts, customers = names()
    keep_by_customer(inputs, facts, customers, 4, str(tmp_path), DAY)
    assert buckets_of(spark, facts) == buckets_of(spark, customers) == 4
    files = spark.table(facts).select(DAY, F.input_file_name().alias("f")).distinct()
    assert files.groupBy(DAY).count().agg(F.max("count")).first()[0] <= 4


def test_days_are_replaced(spark, make_inputs, tmp_path):
    first = small(make_inputs, [fact(1, 3, 1), fact(2, 4, 2), fact(3, 5, 3), fact(4, 5, 4)])
    facts, customers = names()
    keep_by_customer(first, facts, customers, 4, str(tmp_path), DAY)
    later = small(make_inputs, [fact(5, 9, 1), fact(6, 9, 2), fact(7, 8, 2), fact(8, 8, 4)])
    replace_facts(later, facts, date(2021, 3, 2), date(2021, 3, 3))
    assert sorted(r.Id for r in spark.table(facts).collect()) == [1, 4, 6, 7]
    again = read_by_customer(spark, facts, customers, first.companies)
    mixed = small(make_inputs, [fact(1, 3, 1), fact(6, 9, 2), fact(7, 8, 2), fact(4, 5, 4)])
    base = date(2021, 3, 5)
    assert rows_of(daily_cube(again, base, base - timedelta(days=90))) == rows_of(
        daily_cube(mixed, base, base - timedelta(days=90)))


def test_months_are_replaced_whole(spark, make_inputs, tmp_path):
    facts, customers = names()
    keep_by_customer(small(make_inputs, [fact(1, 3), fact(2, 4, 9)]), facts, customers, 4, str(tmp_path))
    later = small(make_inputs, [fact(5, 9, 1)])
    with pytest.raises(ValueError, match="whole months"):
        replace_facts(later, facts, date(2021, 3, 1), date(2021, 3, 30))
    replace_facts(later, facts, date(2021, 3, 1), date(2021, 4, 30))
    assert [r.Id for r in spark.table(facts).collect()] == [5]
    replace_facts(small(make_inputs, []), facts, date(2021, 3, 1), date(2021, 3, 31))
    assert spark.table(facts).collect() == []


def test_empty_tables_and_null_keys(spark, make_inputs, tmp_path):
    facts, customers = names()
    keep_by_customer(small(make_inputs, []), facts, customers, 4, str(tmp_path))
    assert times_mean(spark, facts) == 0
    none = read_by_customer(spark, facts, customers, small(make_inputs, []).companies)
    assert daily_cube(none, date(2021, 3, 5), date(2020, 1, 1)).collect() == []
    replace_facts(small(make_inputs, [fact(1, None, 1), fact(2, 4, 1)]), facts, date(2021, 3, 1), date(2021, 3, 31))
    assert spark.table(facts).count() == 2


def test_keys_of_two_types_are_refused(make_inputs):
    inputs = small(make_inputs, [fact(1, 1)])
    other = inputs.transactions.withColumn("CustomerKey", F.col("CustomerKey").cast("int"))
    with pytest.raises(ValueError, match="CustomerKey is int"):
        keep_by_customer(replace(inputs, transactions=other), *names(), 4)
