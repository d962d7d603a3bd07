"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from conftest import SF

import __spark_entry__ as registered
from tidecube.plans.staged import Stages
from tidecube.sources.testdata import ORDERS_LAUNCH, orders_inputs

EXTRA = {"pipeline", *registered.llm.QUERIES} if registered.llm else set()
QUERIES = {k: v for k, v in registered.queries().items() if k not in EXTRA}
SQL = {k: v for k, v in registered.oracle_sql().items() if k not in EXTRA}


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    columns = sorted(result.columns)
    cursor = duck.execute(SQL[name])
    sql_columns = [d[0] for d in cursor.description]
    assert sorted(sql_columns) == columns
    order = [sql_columns.index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=str)
    got = sorted((tuple(row[c] for c in columns) for row in result.collect()), key=str)
    assert len(got) == len(wanted)
    assert got == wanted


def test_no_query_leaves_cached_tables(spark):
    """Stages are kept on request only, and release gives them back."""
    held = spark.sparkContext._jsc.getPersistentRDDs
    before = held().size()
    for name in ("running_users", "dense_frame", "todate_cube_staged"):
        QUERIES[name](spark, SF).count()
        assert held().size() == before
    stages = Stages(orders_inputs(spark, SF), registered.BASE_DAY, ORDERS_LAUNCH, keep=True)
    assert stages.carry_forward.count() > 0
    assert held().size() > before
    stages.release()
    assert held().size() == before


def test_entry_has_the_published_columns(spark):
    from test_columns import PUBLISHED

    assert registered.entry(spark).columns == PUBLISHED
