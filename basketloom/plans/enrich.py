"""Sales joined with their dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.functions.scalars import clean_label


def enrich(sales: DataFrame, product: DataFrame, payment: DataFrame) -> DataFrame:
    """Add ``category``, ``payment_type`` and its cleaned label ``pay``.

    Labels are cleaned on the dimension, once per type instead of once per row.
    The product table may be large, so Spark picks that join by its size.
    """
    types = payment.select("payment_type_id", "payment_type", clean_label("", "payment_type").alias("pay"))
    return sales.join(product.select("product_id", "category"), "product_id", "left").join(
        types, "payment_type_id", "left"
    )


def cents(amount: str) -> Column:
    """Money with two decimals as bigint.

    Long sums are much cheaper than wide decimals, and as exact. More than two
    decimals, 2**51 cents or more in a value, and a sum that overflows are errors.
    """
    scaled = F.col(amount).cast("double") * 100.0
    exact = (F.abs(scaled - F.rint(scaled)) < 0.001) & (F.abs(scaled) < 2.0**51)
    wrong = F.raise_error(F.concat(F.lit(f"{amount} is not in whole cents below 2**51: "), F.col(amount).cast("string")))
    return F.when(scaled.isNull() | exact, F.rint(scaled).cast("bigint")).otherwise(wrong.cast("bigint"))


def from_cents(total: Column) -> Column:
    """The double nearest to the exact amount."""
    return total / F.lit(100.0)
