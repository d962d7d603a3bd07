"""Joining transactions with their company and customer.

The joins are plain equi-joins without hints. Spark broadcasts a side only when its size
is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. There adaptive
execution splits the joins with a company and with a customer's attributes. It does not
split the semi-join of the users path, because the aggregate by customer above it uses its
partitioning; a customer brings at most one row per company there, as rows are summed up
before, so no task gets more than the number of companies for one customer.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecube.functions.dates import days_between, minute_boundaries
from tidecube.operators.accounts import Accounts
from tidecube.operators.asof import latest_customer_type
from tidecube.operators.dimensions import (
    CUSTOMER_TYPE,
    PRODUCT,
    fill_missing,
    reject_reserved,
    standardize_product,
)
from tidecube.plans.options import Options
from tidecube.sources.inputs import Inputs, eligible

# Plausible birth years, days and minutes per year.
FIRST_BIRTH_YEAR = 1900
LAST_BIRTH_YEAR = 2019
DAYS_PER_YEAR = 365.25
MINUTES_PER_YEAR = 525960.0


def payments(
    inputs: Inputs, start: date, end: date, options: Options, *columns: str
) -> DataFrame:
    """Eligible transactions with ``columns`` and any dimension beyond the default two."""
    extra = options.extra_dimensions
    wanted = list(dict.fromkeys(("CustomerKey", "CompanyId", "CreatedAt", *columns)))
    source = wanted + [d.name for d in extra if d != CUSTOMER_TYPE]
    rows = eligible(inputs, start, end, *source)
    if PRODUCT in extra:
        rows = rows.withColumn(PRODUCT.name, standardize_product(F.col(PRODUCT.name)))
    if CUSTOMER_TYPE in extra:
        if inputs.customer_types is None:
            raise ValueError("the CustomerType dimension needs customer_types")
        rows = latest_customer_type(rows, inputs.customer_types, start, end)
    return rows


def with_company(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """Adds PaymentType and labels missing companies and payment types."""
    company = companies.select(F.col("Id").alias("_company"), "PaymentType")
    joined = rows.join(company, F.col("CompanyId") == F.col("_company"), "left")
    others = [c for c in rows.columns if c != "CompanyId"]
    return joined.select(
        *others,
        fill_missing(reject_reserved(F.col("PaymentType"), "PaymentType")).alias("PaymentType"),
        fill_missing(reject_reserved(F.col("CompanyId"), "CompanyId")).alias("CompanyId"),
    )


def age_days(birth: Column, ts: Column) -> Column:
    """Age in days; NULL unless the birth year is plausible."""
    plausible = F.year(birth).between(FIRST_BIRTH_YEAR, LAST_BIRTH_YEAR)
    return F.when(plausible, days_between(birth, ts))


def with_customer(
    rows: DataFrame, customers: DataFrame, accounts: Accounts | None = None
) -> DataFrame:
    """Keeps rows of known customers and adds AgeDays and TenureMinutes at CreatedAt."""
    customer = customers.select(
        F.col("Customer_Key").alias("_customer"),
        F.col("CreatedAt").alias("_registered"),
        F.col("DateOfBirth").alias("_birth"),
    )
    same = F.col("CustomerKey") == F.col("_customer")
    if accounts is None:
        joined = rows.join(customer, same)
    else:
        known = F.col("_customer").isNotNull()
        joined = accounts.of_customers(rows.join(customer, same, "left"), known).filter(known)
    return joined.select(
        *rows.columns,
        age_days(F.col("_birth"), F.col("CreatedAt")).alias("AgeDays"),
        minute_boundaries(F.col("_registered"), F.col("CreatedAt")).alias("TenureMinutes"),
    )


def of_known_customers(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Keeps rows of known customers."""
    known = customers.select(F.col("Customer_Key").alias("_customer"))
    return rows.join(known, F.col("CustomerKey") == F.col("_customer"), "left_semi")


def in_years(measure: Column, per_year: float) -> Column:
    return measure.cast("double") / F.lit(per_year)


def base_transactions(
    inputs: Inputs, base_day: date, launch: date, options: Options = Options()
) -> DataFrame:
    """One row per eligible transaction of a known customer, with every attribute."""
    rows = payments(inputs, launch, base_day, options, "Id", "Amount")
    return with_customer(with_company(rows, inputs.companies), inputs.customers)
