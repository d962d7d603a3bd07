"""Facts and customers stored by customer, so that joining them moves no rows.

Both become catalog tables in the same number of buckets by customer key; facts are partitioned by
month or day as well, with one file per partition and bucket. Summing per customer, the join with
customers and the cube levels of the users then run where the rows lie.

Partitions by day are replaced one by one and suit facts that fill files of a useful size in each of
them, days times buckets; partitions by month make fewer files and are replaced as a whole.

A bucket is read by one task. Where one customer has so many facts that this task would last much
longer than the others, the same files are read without regard to buckets, and adaptive execution
splits the join as it does for any other table.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidecube.sources.inputs import Inputs

DAY = "CreatedDay"
MONTH = "CreatedMonth"
_MODE = "spark.sql.sources.partitionOverwriteMode"
#: A largest bucket of more than this many times the mean is not read as one.
MOST_TIMES_MEAN = 4.0


def _bucket(key: str, buckets: int) -> Column:
    """The bucket that Spark's writer puts a key into."""
    return F.pmod(F.hash(key), F.lit(buckets))


def _facts(inputs: Inputs, buckets: int, part: str) -> DataFrame:
    """Facts with their day or month, spread so that every file has one writer.

    A customer with very many facts is spread by partition.
    """
    day = F.to_date("CreatedAt")
    value = day if part == DAY else F.trunc(day, "month")
    rows = inputs.transactions.drop(DAY, MONTH).withColumn(part, value)
    return rows.repartition(_bucket("CustomerKey", buckets), part)


def keep_by_customer(
    inputs: Inputs,
    facts_table: str,
    customers_table: str,
    buckets: int,
    folder: str | None = None,
    part: str = MONTH,
) -> None:
    """Writes transactions and customers as new tables in ``buckets`` buckets each.

    Facts are partitioned by ``part``, DAY or MONTH. With ``folder`` the tables lie there, or else in
    the warehouse. The keys must be of one type, as equal numbers of two types fall into different
    buckets. A table that exists is not replaced; trying to is an error.
    """
    if part not in (DAY, MONTH):
        raise ValueError(f"facts are partitioned by {DAY} or {MONTH}, not {part}")
    kinds = (dict(inputs.transactions.dtypes)["CustomerKey"], dict(inputs.customers.dtypes)["Customer_Key"])
    if kinds[0] != kinds[1]:
        raise ValueError(f"CustomerKey is {kinds[0]}, Customer_Key is {kinds[1]}; they must be alike")
    customers = inputs.customers.repartition(_bucket("Customer_Key", buckets))
    for rows, key, name, parts in (
        (_facts(inputs, buckets, part), "CustomerKey", facts_table, [part]),
        (customers, "Customer_Key", customers_table, []),
    ):
        writer = rows.write.format("parquet").bucketBy(buckets, key).sortBy(key)
        if parts:
            writer = writer.partitionBy(*parts)
        if folder:
            writer = writer.option("path", f"{folder.rstrip('/')}/{name}")
        writer.saveAsTable(name)


def buckets_of(spark: SparkSession, name: str) -> int:
    """The number of buckets of a table, 0 if it has none."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type) if rows else 0


def _part_of(spark: SparkSession, facts_table: str) -> str:
    return DAY if DAY in spark.table(facts_table).columns else MONTH


def replace_facts(inputs: Inputs, facts_table: str, first: date, last: date) -> None:
    """Replaces the facts of the days from ``first`` to ``last`` in the table by those of ``inputs``.

    A table by month takes whole months only. Partitions of the range without facts go; others stay
    as they are.
    """
    spark = inputs.transactions.sparkSession
    part = _part_of(spark, facts_table)
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    if part == MONTH:
        if first.day != 1 or (last + timedelta(days=1)).day != 1:
            raise ValueError(f"{facts_table} is by month; {first} to {last} are not whole months")
        days = [d for d in days if d.day == 1]
    seen = Observation()
    # The set stays right if a task runs twice; it has one entry per partition of the range.
    rows = _facts(inputs, buckets_of(spark, facts_table), part).filter(
        F.to_date("CreatedAt").between(F.lit(first), F.lit(last))
    ).observe(seen, F.collect_set(part).alias("parts"))
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        rows.select(spark.table(facts_table).columns).write.insertInto(facts_table, overwrite=True)
    finally:
        spark.conf.set(_MODE, before)
    filled = set(seen.get["parts"])
    if empty := [d for d in days if d not in filled]:
        gone = ", ".join(f"PARTITION ({part} = DATE '{d}')" for d in empty)
        spark.sql(f"ALTER TABLE {facts_table} DROP IF EXISTS {gone}")


def times_mean(spark: SparkSession, facts_table: str) -> float:
    """Facts in the largest bucket over the mean of all buckets; 0 without facts.

    One pass over the key column, summed up by bucket before the shuffle.
    """
    buckets = buckets_of(spark, facts_table)
    sizes = spark.table(facts_table).groupBy(_bucket("CustomerKey", buckets).alias("b")).count()
    row = sizes.agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    return row.most * buckets / row.all if row["all"] else 0.0


def read_by_customer(
    spark: SparkSession,
    facts_table: str,
    customers_table: str,
    companies: DataFrame,
    customer_types: DataFrame | None = None,
    most_times_mean: float = MOST_TIMES_MEAN,
) -> Inputs:
    """Inputs over the kept tables; by buckets unless one has more than ``most_times_mean`` means.

    A null CreatedAt has the null partition, which no reported day reads.
    """
    facts = spark.table(facts_table)
    part = _part_of(spark, facts_table)
    if times_mean(spark, facts_table) > most_times_mean:
        facts = _without_buckets(spark, facts_table)
    return Inputs(
        facts, companies, spark.table(customers_table), customer_types,
        day_column=DAY if part == DAY else None, month_column=MONTH if part == MONTH else None,
    )


def _without_buckets(spark: SparkSession, name: str) -> DataFrame:
    """The files of a table as plain ones, under the table's own columns and types."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return spark.read.schema(spark.table(name).schema).parquet(rows[0].data_type)
