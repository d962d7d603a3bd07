"""Cube dimensions and their reserved values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reserved members of the cube dimensions.
MISSING = -80
MISSING_AFTER_CAST = -100
OVERALL = 10000
MISSING_PRODUCT = "NULL"
MISSING_PRODUCT_AFTER_CAST = "N/A"
OVERALL_PRODUCT = "(Overall)"


@dataclass(frozen=True)
class Dimension:
    """A cube dimension; ``overall`` labels the level that sums over it."""

    name: str
    overall: int | str = OVERALL


PAYMENT_TYPE = Dimension("PaymentType")
COMPANY = Dimension("CompanyId")
CUSTOMER_TYPE = Dimension("CustomerType")
PRODUCT = Dimension("StandardizedProductName", OVERALL_PRODUCT)


def fill_missing(value: Column) -> Column:
    """Missing ids become -80; the default after the cast never applies."""
    return F.coalesce(F.coalesce(value, F.lit(MISSING)).cast("int"), F.lit(MISSING_AFTER_CAST))


def reject_reserved(
    value: Column, name: str, reserved: tuple[int | str, ...] = (OVERALL, MISSING)
) -> Column:
    """Fail the job on a real member that equals a reserved one.

    Such a member would silently merge with "overall" or "missing". The test rides
    along in the projection, so it costs no extra pass.
    """
    message = F.concat(F.lit(f"{name} uses a reserved id: "), value.cast("string"))
    return F.when(value.isin(*reserved), F.raise_error(message)).otherwise(value)


def standardize_product(name: Column) -> Column:
    """Product name with both spellings of "payment" made equal."""
    # The two spellings replaced and their replacement.
    cleaned = F.replace(F.replace(name, F.lit("ödemesi"), F.lit("Payment")),
                        F.lit("payment"), F.lit("Payment"))
    real = reject_reserved(cleaned, PRODUCT.name, (OVERALL_PRODUCT, MISSING_PRODUCT))
    return F.coalesce(
        F.coalesce(real, F.lit(MISSING_PRODUCT)).cast("string"),
        F.lit(MISSING_PRODUCT_AFTER_CAST),
    )


def copied_levels(dimensions: tuple[Dimension, ...]) -> list[int]:
    """Levels that keep the company and roll up its payment type.

    Where a company has one payment type, they repeat the level below, label apart.
    """
    type_bit, company_bit = (1 << dimensions.index(d) for d in (PAYMENT_TYPE, COMPANY))
    return [i for i in range(2 ** len(dimensions)) if i & type_bit and not i & company_bit]


def copy_levels(cells: DataFrame) -> DataFrame:
    """Adds the copied levels to rows that were summed up without them."""
    kinds = F.when(F.col(COMPANY.name) == COMPANY.overall, F.array(PAYMENT_TYPE.name)).otherwise(
        F.array(PAYMENT_TYPE.name, F.lit(PAYMENT_TYPE.overall))
    )
    others = [c for c in cells.columns if c != PAYMENT_TYPE.name]
    return cells.select(*others, F.explode(kinds).alias(PAYMENT_TYPE.name)).select(cells.columns)


def explode_levels(
    df: DataFrame, dimensions: tuple[Dimension, ...], without: list[int] | None = None
) -> DataFrame:
    """One row per cube level: each dimension kept or replaced by its overall label.

    Levels are numbered, and bit ``i`` of the number rolls up dimension ``i``.

    Unlike ``CUBE``, which Spark plans as an ``Expand`` that forgets how its input
    is partitioned, this keeps the input's partitioning. Aggregating afterwards on
    keys that include the partitioning keys needs no shuffle of the multiplied rows.
    """
    names = {d.name for d in dimensions}
    others = [c for c in df.columns if c not in names]
    levels = [i for i in range(2 ** len(dimensions)) if i not in (without or ())]
    numbers = F.array(*[F.lit(i) for i in levels])
    return df.select("*", F.explode(numbers).alias("_level")).select(
        *others,
        *[
            F.when(F.col("_level").bitwiseAND(F.lit(1 << i)) == 0, F.col(d.name))
            .otherwise(F.lit(d.overall))
            .alias(d.name)
            for i, d in enumerate(dimensions)
        ],
    )
