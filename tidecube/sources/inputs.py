"""Input tables of the cube."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecube.functions.dates import NTZ, midnight

# Columns each input must offer.
TRANSACTION_COLUMNS = (
    "Id",
    "CustomerKey",
    "Amount",
    "CreatedAt",
    "CompanyId",
    "EntryType",
    "IsCancellation",
    "OperatorCustomerKey",
)
COMPANY_COLUMNS = ("Id", "PaymentType")
CUSTOMER_COLUMNS = ("Customer_Key", "CreatedAt", "DateOfBirth")
CUSTOMER_TYPE_COLUMNS = ("CustomerKey", "CreatedAt", "CustomerType")

# Fixed value: the entry type that marks a payment.
PAYMENT_ENTRY_TYPE = 17


@dataclass(frozen=True)
class Inputs:
    """The fact table and its dimensions.

    ``day_column`` names a column of ``transactions`` that holds the date of
    ``CreatedAt``. Give it when the fact table is partitioned by such a column, and
    every scan is pruned to the partitions it needs. ``month_column`` does the same with the first
    day of the month of ``CreatedAt``. ``unique_companies`` says that no company
    Id repeats, as ``with_known_keys`` finds out; a day's cube then copies the levels that follow from it.
    """

    transactions: DataFrame
    companies: DataFrame
    customers: DataFrame
    customer_types: DataFrame | None = None
    day_column: str | None = None
    unique_companies: bool = False
    month_column: str | None = None

    def __post_init__(self) -> None:
        for name, df, wanted in (
            ("transactions", self.transactions, TRANSACTION_COLUMNS),
            ("companies", self.companies, COMPANY_COLUMNS),
            ("customers", self.customers, CUSTOMER_COLUMNS),
            ("customer_types", self.customer_types, CUSTOMER_TYPE_COLUMNS),
        ):
            if df is None:
                continue
            missing = [c for c in wanted if c not in df.columns]
            if missing:
                raise ValueError(f"{name} lacks {missing}")
        kind = dict(self.transactions.dtypes)["CreatedAt"]
        if kind != NTZ:
            raise ValueError(f"transactions.CreatedAt must be {NTZ}, not {kind}")


def with_known_keys(inputs: Inputs) -> Inputs:
    """The inputs, with ``unique_companies`` as the company table is now. Runs a small job."""
    repeated = inputs.companies.filter("Id IS NOT NULL").groupBy("Id").count().filter("count > 1")
    return replace(inputs, unique_companies=repeated.isEmpty())


def read_inputs(
    spark: SparkSession,
    transactions: str,
    companies: str,
    customers: str,
    customer_types: str | None = None,
    day_column: str | None = None,
    format: str = "parquet",
) -> Inputs:
    """Inputs from files; catalog tables can be put into ``Inputs`` directly."""
    reader = spark.read.format(format)
    return Inputs(
        transactions=reader.load(transactions),
        companies=reader.load(companies),
        customers=reader.load(customers),
        customer_types=reader.load(customer_types) if customer_types else None,
        day_column=day_column,
    )


def eligible(inputs: Inputs, start: date, end: date, *columns: str) -> DataFrame:
    """Payments made by customers themselves and not cancelled, ``start`` <= time < ``end``.

    The conditions are on bare columns, so they reach the scan.
    """
    tx = inputs.transactions
    if inputs.day_column:
        day = F.col(inputs.day_column)
        tx = tx.filter((day >= F.lit(start)) & (day < F.lit(end)))
    if inputs.month_column:
        month = F.col(inputs.month_column)
        tx = tx.filter((month >= F.lit(start.replace(day=1))) & (month < F.lit(end)))
    return tx.filter(
        (F.col("EntryType") == PAYMENT_ENTRY_TYPE)
        & (F.col("IsCancellation") == 0)
        & F.col("OperatorCustomerKey").isNull()
        & (F.col("CreatedAt") >= midnight(start))
        & (F.col("CreatedAt") < midnight(end))
    ).select(*columns)
