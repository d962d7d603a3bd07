"""Cube inputs derived from the generic star-schema test tables.

``orders`` spans several years and drives every period; ``events`` has natural times
within one month. The mapping is also written down in FIXTURES.md.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecube.sources.inputs import Inputs

ORDERS_LAUNCH = date(1996, 1, 20)
EVENTS_LAUNCH = date(2024, 1, 5)

_ORDERS = """
    o_orderkey AS Id,
    CASE WHEN o_orderkey % 29 = 0 THEN -o_custkey ELSE o_custkey END AS CustomerKey,
    CAST(CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END
         AS DECIMAL(18,2)) AS Amount,
    o_orderdate + make_dt_interval(0, CAST(o_orderkey * 7 % 24 AS INT),
                                   CAST(o_orderkey * 13 % 60 AS INT)) AS CreatedAt,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
         THEN CAST(CASE WHEN floor(o_totalprice / 25000) = 5 THEN 105
                        ELSE floor(o_totalprice / 25000) END AS INT) END AS CompanyId,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 18 ELSE 17 END AS EntryType,
    CASE WHEN o_totalprice < 8000 THEN 1 ELSE 0 END AS IsCancellation,
    CASE WHEN o_totalprice > 492000 THEN o_custkey END AS OperatorCustomerKey,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Fatura ödemesi'
                         WHEN '2-HIGH' THEN 'bill payment'
                         WHEN '3-MEDIUM' THEN 'Top-up' END AS StandardizedProductName
"""

_EVENTS = """
    event_id AS Id,
    user_id AS CustomerKey,
    CAST(value AS DECIMAL(18,2)) AS Amount,
    ts AS CreatedAt,
    CASE WHEN event_type <> 'error' THEN length(event_type) END AS CompanyId,
    17 AS EntryType,
    0 AS IsCancellation,
    CAST(NULL AS BIGINT) AS OperatorCustomerKey
"""

_COMPANIES = "n_nationkey AS Id, NULLIF(n_regionkey, 4) AS PaymentType"

_CUSTOMERS = """
    c_custkey AS Customer_Key,
    TIMESTAMP_NTZ '1994-06-01 00:00:00'
        + make_dt_interval(CAST(c_custkey * 97 % 900 AS INT), 0,
                           CAST(c_custkey * 31 % 1440 AS INT)) AS CreatedAt,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
         WHEN c_acctbal > 9000 THEN DATE '1899-05-05'
         WHEN c_acctbal > 8000 THEN DATE '2020-03-01'
         ELSE date_add(DATE '1950-01-01', CAST(c_custkey * 37 % 18000 AS INT))
    END AS DateOfBirth
"""

_CUSTOMER_TYPES = """
    o_custkey AS CustomerKey,
    o_orderdate + make_dt_interval(0, 12) AS CreatedAt,
    CAST(NULLIF(o_orderkey % 4, 3) AS INT) AS CustomerType
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: str) -> DataFrame:
    return df.select(F.expr(f"struct({columns}) AS row")).select("row.*")


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations. The facts of one price band have an id that is none."""
    return _select(_table(spark, sf_dir, "nation"), _COMPANIES)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers. One order in 29 has a customer key that is none."""
    return _select(_table(spark, sf_dir, "customer"), _CUSTOMERS)


def customer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's type changes at noon of each day with an order; some types are NULL."""
    return _select(_table(spark, sf_dir, "orders"), _CUSTOMER_TYPES)


def orders_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        _select(_table(spark, sf_dir, "orders"), _ORDERS),
        companies(spark, sf_dir),
        customers(spark, sf_dir),
        customer_types(spark, sf_dir),
    )


def events_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        _select(_table(spark, sf_dir, "events"), _EVENTS),
        companies(spark, sf_dir),
        customers(spark, sf_dir),
    )
