"""The customer-hour cube: what each customer did in each hour and cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecube.functions.dates import date_hour
from tidecube.operators.accounts import Accounts
from tidecube.operators.dimensions import explode_levels
from tidecube.operators.enrich import with_company, with_customer
from tidecube.plans.options import Options
from tidecube.sources.inputs import Inputs


def customer_hours(payments: DataFrame, options: Options) -> DataFrame:
    """Transactions summed per customer, company and hour.

    Doing this before any join means a customer or company with very many
    transactions has already shrunk, map-side, when the joins shuffle it. CreatedAt
    becomes the last one of the hour, which is where age and tenure are greatest.
    """
    hour = date_hour(F.col("CreatedAt"), options.hour_offset).alias("DateHour")
    extra = [d.name for d in options.extra_dimensions]
    return payments.groupBy("CustomerKey", "CompanyId", *extra, hour).agg(
        F.count("Id").alias("TxCount"),
        F.sum("Amount").alias("TotalVolume"),
        F.max("CreatedAt").alias("CreatedAt"),
    )


def customer_hour_cube(
    payments: DataFrame,
    inputs: Inputs,
    options: Options,
    without: list[int] | None = None,
    accounts: Accounts | None = None,
) -> DataFrame:
    """One row per customer, hour and cube cell, but for the levels ``without``.

    Rows are spread by customer and hour before the levels are multiplied out, so the
    shuffle carries each of them once and even one customer's rows go to many tasks.
    """
    hours = customer_hours(payments, options)
    if accounts:
        hours = accounts.eligible(hours)
    of_company = with_company(hours, inputs.companies)
    if accounts:
        of_company = accounts.of_companies(of_company)
    enriched = with_customer(of_company, inputs.customers, accounts)
    spread = enriched.drop("CreatedAt").repartition("CustomerKey", "DateHour")
    return (
        explode_levels(spread, options.dimensions, without)
        .groupBy("CustomerKey", "DateHour", *options.dimension_names)
        .agg(
            F.sum("TxCount").alias("TxCount"),
            F.sum("TotalVolume").alias("TotalVolume"),
            F.max("AgeDays").alias("AgeDays"),
            F.max("TenureMinutes").alias("TenureMinutes"),
        )
    )
