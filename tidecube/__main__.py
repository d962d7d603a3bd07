"""Command line job, for ``spark-submit`` or ``python -m tidecube``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from tidecube.operators.dimensions import COMPANY, CUSTOMER_TYPE, PAYMENT_TYPE, PRODUCT
from tidecube.plans.job import DEFAULT_LAUNCH, run_day, run_range
from tidecube.plans.options import Options
from tidecube.sources.commits import replace_days
from tidecube.sources.inputs import read_inputs
from tidecube.sources.target import write_days


def parser() -> argparse.ArgumentParser:
    day = date.fromisoformat
    out = argparse.ArgumentParser(prog="tidecube", description=__doc__)
    out.add_argument("--transactions", required=True)
    out.add_argument("--companies", required=True)
    out.add_argument("--customers", required=True)
    out.add_argument("--day-column", help="date partition column of the transactions")
    out.add_argument("--target", required=True, help="a path or the name of a table")
    out.add_argument("--one-step", action="store_true",
                     help="the target is a folder of commits, which show a whole run at once")
    out.add_argument("--customer-types", help="history of customer types")
    out.add_argument("--launch", type=day, default=DEFAULT_LAUNCH)
    out.add_argument("--base-day", type=day, default=date.today(), help="reports the day before")
    out.add_argument("--first", type=day, help="first reported day of a backfill")
    out.add_argument("--last", type=day, help="last reported day of a backfill")
    out.add_argument("--by-customer-type", action="store_true", help="adds the dimension")
    out.add_argument("--by-product", action="store_true", help="adds the dimension")
    out.add_argument("--two-month", action="store_true", help="adds the two-month period")
    out.add_argument("--dth-average", choices=("as_written", "day"), default="as_written")
    out.add_argument("--retained-2ytd", choices=("as_written", "fixed"), default="as_written")
    out.add_argument("--hour-offset", type=int, default=0, help="shifts the hour of day")
    return out


def options_of(args: argparse.Namespace) -> Options:
    dimensions = (PAYMENT_TYPE, COMPANY)
    dimensions += (PRODUCT,) * args.by_product + (CUSTOMER_TYPE,) * args.by_customer_type
    return Options(
        dth_average=args.dth_average,
        retained_2ytd=args.retained_2ytd,
        two_month=args.two_month,
        hour_offset=args.hour_offset,
        dimensions=dimensions,
    )


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if (args.first is None) != (args.last is None):
        parser().error("--first and --last go together")
    if args.by_customer_type and not args.customer_types:
        parser().error("--by-customer-type needs --customer-types")
    options = options_of(args)

    # The cube is about a hundred columns wide. Generated methods beyond this size would
    # run uncompiled in the JVM; with the limit Spark splits the expressions instead.
    spark = (
        SparkSession.builder.appName("tidecube")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    inputs = read_inputs(
        spark,
        args.transactions,
        args.companies,
        args.customers,
        customer_types=args.customer_types,
        day_column=args.day_column,
    )
    write = replace_days if args.one_step else write_days
    if args.first:
        rows = run_range(inputs, args.first, args.last, args.target, args.launch, options, write)
    else:
        rows = run_day(inputs, args.base_day, args.target, args.launch, options, write)
    for reported, count in rows.items():
        print(f"{reported}: {count} rows")


if __name__ == "__main__":
    main()
