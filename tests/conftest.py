from __future__ import annotations

import os
import sys
from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidecube import Inputs  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SF = "/root/testdata/sf0.001"

TRANSACTIONS = (
    "Id bigint, CustomerKey bigint, Amount decimal(18,2), CreatedAt timestamp_ntz, CompanyId int, "
    "EntryType int, IsCancellation int, OperatorCustomerKey bigint"
)
COMPANIES = "Id int, PaymentType int"
CUSTOMERS = "Customer_Key bigint, CreatedAt timestamp_ntz, DateOfBirth date"
CUSTOMER_TYPES = "CustomerKey bigint, CreatedAt timestamp_ntz, CustomerType int"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')"
        )
    return connection


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def tx(id, customer, amount, created, company, entry=17, cancelled=0, operator=None):
    from decimal import Decimal

    return (id, customer, Decimal(str(amount)), at(created), company, entry, cancelled, operator)


@pytest.fixture(scope="session")
def make_inputs(spark):
    def make(transactions, companies=(), customers=(), customer_types=None, **kw) -> Inputs:
        types = None
        if customer_types is not None:
            types = spark.createDataFrame(customer_types, CUSTOMER_TYPES)
        return Inputs(
            spark.createDataFrame(list(transactions), TRANSACTIONS),
            spark.createDataFrame(list(companies), COMPANIES),
            spark.createDataFrame(list(customers), CUSTOMERS),
            types,
            **kw,
        )

    return make


def customer(key, registered="2000-01-01", born="1980-01-01"):
    return (key, at(registered), date.fromisoformat(born) if born else None)


def rows_of(df) -> list[tuple]:
    """Rows as sorted tuples with columns in name order."""
    columns = sorted(df.columns)
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=str)
