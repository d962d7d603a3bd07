"""What the joins with companies and customers did to the transactions, counted in passing.

The counts ride along with the job that computes the cube, so they cost no further one. They are
of transactions, in the totals of a day: this year's eligible facts. A stage that Spark runs again
after a lost executor may count its rows again.
"""

from __future__ import annotations

from collections import Counter

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidecube.operators.dimensions import MISSING


class Accounts:
    """Counts of one run; ``report`` has them once the job is done."""

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def _observe(self, rows: DataFrame, **counts: Column) -> DataFrame:
        seen = Observation()
        self._seen.append(seen)
        return rows.observe(seen, *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in counts.items()])

    def eligible(self, hours: DataFrame) -> DataFrame:
        return self._observe(hours, eligible=F.col("TxCount"))

    def of_companies(self, joined: DataFrame) -> DataFrame:
        count = F.col("TxCount")

        def where(condition: Column) -> Column:
            return F.when(condition, count).otherwise(F.lit(0))

        return self._observe(
            joined,
            with_company=count,
            without_company=where(F.col("CompanyId") == MISSING),
            without_payment_type=where(F.col("PaymentType") == MISSING),
        )

    def of_customers(self, joined: DataFrame, known: Column) -> DataFrame:
        """``joined`` still has the rows of unknown customers, which ``known`` tells."""
        count = F.col("TxCount")
        return self._observe(
            joined,
            unknown_customer=F.when(known, F.lit(0)).otherwise(count),
            counted=F.when(known, count).otherwise(F.lit(0)),
        )

    @property
    def report(self) -> dict[str, int]:
        """Eligible transactions, those repeated by companies that repeat, those without a company
        or a payment type, those dropped for an unknown customer, those repeated by customers that
        repeat, and those counted in the end."""
        found: Counter[str] = Counter()
        for seen in self._seen:
            try:
                found.update({k: int(v) for k, v in seen.get.items()})
            except Py4JJavaError:
                # No row came so far: Spark found a side empty and left out what follows from it.
                continue
        return {
            "eligible": found["eligible"],
            "repeated_by_company": found["with_company"] - found["eligible"],
            "without_company": found["without_company"],
            "without_payment_type": found["without_payment_type"],
            "unknown_customer": found["unknown_customer"],
            "repeated_by_customer": found["counted"] + found["unknown_customer"] - found["with_company"],
            "counted": found["counted"],
        }
