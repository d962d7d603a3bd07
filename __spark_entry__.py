"""Registered queries and the SQL they are checked against."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from tidecube import (  # noqa: E402
    Options,
    backfill_cube,
    daily_cube,
    keep_activity,
    read_changes,
    read_days,
    read_slice,
    refresh,
    replace_days,
    run_changes,
    run_day,
    run_range,
    with_known_keys,
)
from tidecube.functions.dates import NTZ, half_year_start  # noqa: E402
from tidecube.operators import bitmaps  # noqa: E402
from tidecube.operators.dimensions import (  # noqa: E402
    COMPANY,
    CUSTOMER_TYPE,
    PAYMENT_TYPE,
    PRODUCT,
)
from tidecube.operators.enrich import (  # noqa: E402
    DAYS_PER_YEAR,
    MINUTES_PER_YEAR,
    in_years,
    payments,
)
from tidecube.operators.frame import hour_spine as spine_between  # noqa: E402
from tidecube.operators.frame import recursive_spine  # noqa: E402
from tidecube.plans.periods import PAIRS, Periods  # noqa: E402
from tidecube.plans.staged import Stages  # noqa: E402
from tidecube.plans.staged import period_starts as starts_of  # noqa: E402
from tidecube.plans.user_sets import keep_user_sets, user_sets  # noqa: E402
from tidecube.sources.by_customer import (  # noqa: E402
    keep_by_customer,
    read_by_customer,
    replace_facts,
)
from tidecube.sources.testdata import (  # noqa: E402
    EVENTS_LAUNCH,
    ORDERS_LAUNCH,
    events_inputs,
    orders_inputs,
)

try:
    import corpus_pipeline  # noqa: E402
    from tidecube.llm import registry as llm  # noqa: E402
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "tidecube.llm"):
        raise
    llm = None

BASE_DAY = date(2000, 11, 16)
EVENTS_BASE_DAY = date(2024, 1, 20)
EDGE_BASE_DAYS = {
    "base_opens_month": date(2000, 5, 1),
    "day_opens_month": date(2000, 5, 2),
    "day_opens_half_year": date(2000, 7, 2),
    "base_opens_year": date(2001, 1, 1),
    "day_opens_year": date(2001, 1, 2),
    "second_month": date(2001, 2, 10),
}
WINDOWS = ((date(1998, 3, 15), date(1999, 9, 10)), (date(1999, 6, 2), date(2000, 11, 5)))
BACKFILL = (date(2000, 12, 28), date(2001, 1, 3))
CHANGES = (date(2000, 12, 31), date(2001, 1, 2))
LATE_FROM = date(2000, 12, 31)
BUCKETS = 8
FIXED = Options(dth_average="day", retained_2ytd="fixed")
TWO_MONTH = Options(two_month=True)
HOUR_SHIFT = Options(hour_offset=3)
BY_PRODUCT = Options(dimensions=(PAYMENT_TYPE, COMPANY, PRODUCT))
BY_CUSTOMER_TYPE = Options(dimensions=(PAYMENT_TYPE, COMPANY, CUSTOMER_TYPE))
KEYS = ["DateHour", "PaymentType", "CompanyId"]


def _stages(spark: SparkSession, sf_dir: str) -> Stages:
    return Stages(orders_inputs(spark, sf_dir), BASE_DAY, ORDERS_LAUNCH)


def _pairs(column: str) -> Callable[[SparkSession, str], DataFrame]:
    """One family of period-pair columns of the day's cube."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cube = daily_cube(orders_inputs(spark, sf_dir), BASE_DAY, ORDERS_LAUNCH)
        return cube.select(*KEYS, *[getattr(p, column) for p in PAIRS])

    return query


def _target_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a written target, in a folder that all executors share.

    That is ``spark.checkpoint.dir``, or else the warehouse. Folders stay until the cluster
    clears them.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def period_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    days = orders.select(F.to_date("o_orderdate").alias("BaseDay")).distinct()
    return starts_of(days, ORDERS_LAUNCH)


def _bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = orders_inputs(spark, sf_dir).transactions.select(
        F.to_date("CreatedAt").alias("day")
    )
    return created.agg(
        F.min("day").cast(NTZ).alias("start"), F.date_add(F.max("day"), 1).cast(NTZ).alias("end")
    )


def hour_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spine_between(_bounds(spark, sf_dir))


def hour_spine_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form with an exclusive end, by recursion."""
    return recursive_spine(_bounds(spark, sf_dir))


def base_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stages(spark, sf_dir).base_transactions.select(
        "Id", "CustomerKey", "Amount", "CreatedAt", "PaymentType", "CompanyId"
    )


def customer_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stages(spark, sf_dir).base_transactions.select(
        "Id",
        "CustomerKey",
        "AgeDays",
        "TenureMinutes",
        in_years(F.col("AgeDays"), DAYS_PER_YEAR).alias("Age"),
        in_years(F.col("TenureMinutes"), MINUTES_PER_YEAR).alias("TenureByYear"),
    )


def customer_hour_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stages(spark, sf_dir).customer_hour_cube.select(
        half_year_start(F.col("DateHour")).alias("SemiYearIndicator"),
        F.quarter("DateHour").alias("QuarterNumber"),
        F.to_date("DateHour").alias("Date"),
        F.col("DateHour").alias("ContributedDateHour"),
        "TxCount",
        "TotalVolume",
        in_years(F.col("AgeDays"), DAYS_PER_YEAR).alias("Age"),
        in_years(F.col("TenureMinutes"), MINUTES_PER_YEAR).alias("TenureByYear"),
        "CustomerKey",
        "PaymentType",
        "CompanyId",
    )


def _day(base_day: date, options: Options = Options(), launch: date = ORDERS_LAUNCH):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return daily_cube(orders_inputs(spark, sf_dir), base_day, launch, options)

    return query


def todate_cube_copied_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube of a day with the levels that follow from unique companies copied."""
    return daily_cube(with_known_keys(orders_inputs(spark, sf_dir)), BASE_DAY, ORDERS_LAUNCH)


def todate_cube_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_cube(events_inputs(spark, sf_dir), EVENTS_BASE_DAY, EVENTS_LAUNCH)


def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill_cube(orders_inputs(spark, sf_dir), *BACKFILL, ORDERS_LAUNCH)


def day_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes three days, then one of them again, and reads all of them back."""
    return _overwritten(spark, sf_dir, _target_folder(spark, "day_overwrite"))


def day_overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a new table of the catalog."""
    return _overwritten(spark, sf_dir, f"day_overwrite_{uuid.uuid4().hex}")


def _overwritten(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    inputs = orders_inputs(spark, sf_dir)
    last = BASE_DAY - timedelta(days=1)
    run_range(inputs, last - timedelta(days=2), last, target, ORDERS_LAUNCH)
    run_day(inputs, BASE_DAY, target, ORDERS_LAUNCH)
    return read_slice(spark, target, last - timedelta(days=2), last).drop("day")


def todate_cube_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's cube from facts and customers stored by customer.

    Facts are stored as they were before the reported month, which then comes in.
    """
    inputs = orders_inputs(spark, sf_dir)
    facts, customers = (f"{name}_{uuid.uuid4().hex}" for name in ("facts", "customers"))
    month, end = BASE_DAY.replace(day=1), date(BASE_DAY.year, BASE_DAY.month + 1, 1)
    earlier = inputs.transactions.filter(F.col("CreatedAt") < F.lit(month).cast(NTZ))
    folder = _target_folder(spark, "by_customer")
    keep_by_customer(replace(inputs, transactions=earlier), facts, customers, BUCKETS, folder)
    replace_facts(inputs, facts, month, end - timedelta(days=1))
    kept = read_by_customer(spark, facts, customers, inputs.companies)
    return daily_cube(kept, BASE_DAY, ORDERS_LAUNCH)


def day_overwrite_one_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one commit per run, read through the commits."""
    inputs, store = orders_inputs(spark, sf_dir), _target_folder(spark, "day_overwrite_one_step")
    last = BASE_DAY - timedelta(days=1)
    first = last - timedelta(days=2)
    run_range(inputs, first, last, store, ORDERS_LAUNCH, write=replace_days)
    run_day(inputs, BASE_DAY, store, ORDERS_LAUNCH, write=replace_days)
    return read_days(spark, store, first, last).drop("day")


def late_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target whose refunds of the new year's days come in late, refreshed for them."""
    inputs, target = orders_inputs(spark, sf_dir), _target_folder(spark, "late_facts")
    late = (F.col("Amount") < 0) & (F.to_date("CreatedAt") >= F.lit(LATE_FROM))
    early = replace(inputs, transactions=inputs.transactions.filter(~late))
    refresh(early, target, *BACKFILL, ORDERS_LAUNCH)
    refresh(inputs, target, *BACKFILL, ORDERS_LAUNCH)
    return read_days(spark, target, *BACKFILL).drop("day")


def _activity(spark: SparkSession, sf_dir: str, base_day: date):
    """Kept activity, built up to a year and a half before and then brought up to the day."""
    inputs, store = orders_inputs(spark, sf_dir), _target_folder(spark, "activity")
    keep_activity(inputs, base_day - timedelta(days=550), store, ORDERS_LAUNCH)
    return inputs, keep_activity(inputs, base_day, store, ORDERS_LAUNCH)


def kept_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity bits by customer, company and month."""
    return _activity(spark, sf_dir, BASE_DAY)[1].rows


def _kept_day(base_day: date) -> Callable[[SparkSession, str], DataFrame]:
    """The cube of a day with users of closed months from the kept activity."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs, activity = _activity(spark, sf_dir, base_day)
        return daily_cube(inputs, base_day, ORDERS_LAUNCH, activity=activity)

    return query


def _changes(spark: SparkSession, sf_dir: str, first: date, last: date, **members: int) -> DataFrame:
    """Days kept as change points and expanded on reading."""
    store = _target_folder(spark, "changes")
    run_changes(orders_inputs(spark, sf_dir), first, last, store, ORDERS_LAUNCH)
    return read_changes(spark, store, first, last, **members)


def todate_cube_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days over the turn of the year, from their change points."""
    return _changes(spark, sf_dir, *CHANGES)


def dashboard_slice_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = BASE_DAY - timedelta(days=1)
    return _changes(spark, sf_dir, day, day, PaymentType=10000, CompanyId=7)


def _user_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of all days since the launch, kept in two steps and read back."""
    inputs, store = orders_inputs(spark, sf_dir), _target_folder(spark, "user_sets")
    last = BASE_DAY - timedelta(days=1)
    keep_user_sets(inputs, store, ORDERS_LAUNCH, last - timedelta(days=30), ORDERS_LAUNCH)
    keep_user_sets(inputs, store, last - timedelta(days=29), last, ORDERS_LAUNCH)
    return user_sets(spark, store, ORDERS_LAUNCH, BASE_DAY)


def running_users_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = Periods(BASE_DAY, ORDERS_LAUNCH)
    return bitmaps.running_users(_user_sets(spark, sf_dir), periods, Options())


def prior_users_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = Periods(BASE_DAY, ORDERS_LAUNCH)
    return bitmaps.prior_users(_user_sets(spark, sf_dir), periods, Options())


def window_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two windows that are no period: who came in each, and who came again."""
    return bitmaps.compared_users(_user_sets(spark, sf_dir), *WINDOWS, Options())


def dashboard_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One company over all payment types, read from a written target."""
    target = _target_folder(spark, "dashboard_slice")
    run_day(orders_inputs(spark, sf_dir), BASE_DAY, target, ORDERS_LAUNCH)
    last = BASE_DAY - timedelta(days=1)
    return read_slice(spark, target, last, last, PaymentType=10000, CompanyId=7).drop("day")


def entry(spark: SparkSession) -> DataFrame:
    """The cube of one day at the smallest scale."""
    return _day(BASE_DAY)(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def stage(name: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: getattr(_stages(spark, sf_dir), name)

    staged = (
        "hourly_metrics",
        "running_tx",
        "running_averages",
        "running_users",
        "dense_frame",
        "carry_forward",
        "prior_users",
    )
    training_data = {"pipeline": corpus_pipeline.run, **llm.QUERIES} if llm else {}
    return {
        **training_data,
        "period_starts": period_starts,
        "hour_spine": hour_spine,
        "hour_spine_recursive": hour_spine_recursive,
        "base_transactions": base_transactions,
        "customer_attributes": customer_attributes,
        "customer_hour_cube": customer_hour_cube,
        **{name: stage(name) for name in staged},
        "contribution": _pairs("contribution"),
        "retained": _pairs("retained"),
        "retention_rate": _pairs("rate"),
        "todate_cube_day": _day(BASE_DAY),
        "todate_cube_staged": stage("published"),
        "todate_cube_copied_levels": todate_cube_copied_levels,
        **{f"todate_cube_{name}": _day(day) for name, day in EDGE_BASE_DAYS.items()},
        "todate_cube_events": todate_cube_events,
        "todate_cube_fixed_formulas": _day(BASE_DAY, FIXED),
        "todate_cube_two_month": _day(BASE_DAY, TWO_MONTH),
        "todate_cube_hour_shift": _day(BASE_DAY, HOUR_SHIFT),
        "todate_cube_by_product": _day(BASE_DAY, BY_PRODUCT),
        "todate_cube_by_customer_type": _day(BASE_DAY, BY_CUSTOMER_TYPE),
        "customer_type_asof": customer_type_asof,
        "backfill_range": backfill_range,
        "day_overwrite": day_overwrite,
        "day_overwrite_table": day_overwrite_table,
        "day_overwrite_one_step": day_overwrite_one_step,
        "late_facts": late_facts,
        "todate_cube_by_customer": todate_cube_by_customer,
        "dashboard_slice": dashboard_slice,
        "todate_cube_changes": todate_cube_changes,
        "dashboard_slice_changes": dashboard_slice_changes,
        "kept_activity": kept_activity,
        "running_users_bitmaps": running_users_bitmaps,
        "prior_users_bitmaps": prior_users_bitmaps,
        "window_users": window_users,
        "todate_cube_kept": _kept_day(BASE_DAY),
        "todate_cube_kept_second_month": _kept_day(EDGE_BASE_DAYS["second_month"]),
    }


def customer_type_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = orders_inputs(spark, sf_dir)
    rows = payments(inputs, ORDERS_LAUNCH, BASE_DAY, BY_CUSTOMER_TYPE, "Id")
    return rows.select("Id", "CustomerKey", "CreatedAt", "CustomerType")


def oracle_sql() -> dict[str, str]:
    launch = ORDERS_LAUNCH.isoformat()

    def day(base: date = BASE_DAY, **kw) -> oracles.Day:
        return oracles.Day(base.isoformat(), launch, **kw)

    one = day()
    in_day = f"WHERE DateHour >= TIMESTAMP '{one.day}' AND DateHour < TIMESTAMP '{one.base}'"
    hourly = ["UUHourly", "TxCountHourly", "TxVolumeHourly", "AvgAgeHourly",
              "AvgTenureByYearHourly"]

    def running(*measures: str) -> list[str]:
        return [f"{m}{p}" for p in one.calendar for m in measures]

    age, tenure = oracles.AGE_YEARS, oracles.TENURE_YEARS
    three = [BASE_DAY - timedelta(days=i) for i in range(3)]
    span = [BACKFILL[0] + timedelta(days=i + 1)
            for i in range((BACKFILL[1] - BACKFILL[0]).days + 1)]

    def days(base_days: list[date]) -> str:
        return " UNION ALL ".join(f"SELECT * FROM ({day(d).whole()})" for d in base_days)

    running_users_sql = one.select(
        one.cube() + one.users(), "users", [f"UU{p}" for p in one.calendar + oracles.LONG])
    prior_users_sql = f"""{one.compared()} SELECT {one.key},
        {', '.join(oracles.prior(*p[:2]) for p in oracles.PAIRS)}
        FROM priors SEMI JOIN keys USING ({one.key})"""
    by_product = dict(dims=("PaymentType", "CompanyId", "StandardizedProductName"))
    by_type = dict(dims=("PaymentType", "CompanyId", "CustomerType"))
    training_data = dict(llm.SQL) if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        training_data["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {
        **training_data,
        "period_starts": oracles.period_starts(launch),
        "hour_spine": oracles.hour_spine(),
        "hour_spine_recursive": f"""SELECT DateHour FROM ({oracles.hour_spine()})
            WHERE DateHour < (SELECT max(DateHour) FROM ({oracles.hour_spine()}))""",
        "base_transactions": one.enriched() + """
            SELECT Id, CustomerKey, Amount, CreatedAt, PaymentType, CompanyId FROM enriched""",
        "customer_attributes": one.enriched() + f"""
            SELECT Id, CustomerKey, AgeDays, TenureMinutes, {age.format('AgeDays')} AS Age,
              {tenure.format('TenureMinutes')} AS TenureByYear FROM enriched""",
        "customer_hour_cube": one.cube() + f"""
            SELECT make_date(year(Date), (month(Date) - 1) // 6 * 6 + 1, 1) AS SemiYearIndicator,
              CAST(quarter(Date) AS INT) AS QuarterNumber, Date, DateHour AS ContributedDateHour,
              TxCount, CAST(TotalVolume AS DECIMAL(38,2)) AS TotalVolume,
              {age.format('AgeDays')} AS Age, {tenure.format('TenureMinutes')} AS TenureByYear,
              CustomerKey, PaymentType, CompanyId FROM customer_cube""",
        "hourly_metrics": one.select(one.totals(), "totals", hourly),
        "running_tx": one.select(one.totals(), "totals", running("TxCount", "TxVolume")),
        "running_averages": one.select(
            one.totals(), "totals", running("AvgAge", "AvgTenureByYear")),
        "running_users": running_users_sql,
        "dense_frame": one.select(one.frame(), "frame", one.metrics(), in_day),
        "carry_forward": one.select(one.filled(), "filled", one.metrics()),
        "prior_users": prior_users_sql,
        "contribution": one.select(one.compared(), "compared", one.contributions()),
        "retained": one.select(one.compared(), "compared", one.retained()),
        "retention_rate": one.select(one.compared(), "compared", one.rates()),
        "todate_cube_day": one.whole(),
        "todate_cube_staged": one.whole(),
        "todate_cube_copied_levels": one.whole(),
        "todate_cube_by_customer": one.whole(),
        **{f"todate_cube_{name}": day(d).whole() for name, d in EDGE_BASE_DAYS.items()},
        "todate_cube_events": oracles.Day(
            EVENTS_BASE_DAY.isoformat(), EVENTS_LAUNCH.isoformat(), oracles.EVENTS).whole(),
        "todate_cube_fixed_formulas": day(dth_average="day", retained_2ytd="fixed").whole(),
        "todate_cube_two_month": day(two_month=True).whole(),
        "todate_cube_hour_shift": day(hour_offset=3).whole(),
        "todate_cube_by_product": day(**by_product).whole(),
        "todate_cube_by_customer_type": day(**by_type).whole(),
        "customer_type_asof": day(**by_type).enriched() + """,
            typed AS (SELECT t.Id, t.CustomerKey, t.CreatedAt,
              coalesce(h.CustomerType, -80) AS CustomerType, rank() OVER (PARTITION BY t.Id
                ORDER BY h.CreatedAt DESC, h.CustomerType DESC NULLS LAST) AS r
              FROM eligible t JOIN customer_types h
                ON h.CustomerKey = t.CustomerKey AND t.CreatedAt >= h.CreatedAt)
            SELECT DISTINCT Id, CustomerKey, CreatedAt, CustomerType FROM typed WHERE r = 1""",
        "backfill_range": days(span),
        "day_overwrite": days(three),
        "day_overwrite_table": days(three),
        "day_overwrite_one_step": days(three),
        "late_facts": days(span),
        "todate_cube_changes": days([CHANGES[0] + timedelta(days=i + 1) for i in range(3)]),
        "dashboard_slice_changes": one.whole("WHERE PaymentType = 10000 AND CompanyId = 7"),
        "kept_activity": one.activity(),
        "running_users_bitmaps": running_users_sql,
        "prior_users_bitmaps": prior_users_sql,
        "window_users": one.windows(*WINDOWS),
        "todate_cube_kept": one.whole(),
        "todate_cube_kept_second_month": day(EDGE_BASE_DAYS["second_month"]).whole(),
        "dashboard_slice": one.whole("WHERE PaymentType = 10000 AND CompanyId = 7"),
    }
