"""One row of features per customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.operators.grouping import listed, pivot_multi, pivot_single, ratio, share_of_total
from basketloom.operators.ordered import spread
from basketloom.plans.enrich import cents, enrich, from_cents

_OVERALL = [
    "sales", "qty", "orders", "unique_products_bought", "unique_payments_used", "unique_categories_bought",
]
_RATIOS = ["aov", "aur", "upt"]


def derived_ratios() -> dict[str, Column]:
    return {"aov": ratio("sales", "orders"), "aur": ratio("sales", "qty"), "upt": ratio("qty", "orders")}


def _totals(enriched: DataFrame, categories: Sequence[str] = (), payments: Sequence[str] = ()) -> DataFrame:
    """Per customer: cents, qty, the distinct counts, and the sums per listed category and payment type.

    Sums go up three nested groupings, customer by category by product, so the
    products and categories of a customer are counted as groups, and no row is
    multiplied; a product has one category, as ``enrich`` gives it. Orders and
    payment types are counted beside them from three narrow columns, which need
    none of the joins, and by order first: two distinct counts double the rows they
    read. Nothing is stored in between. The rows travel as they are, once for the
    first two groupings and once for the orders: a customer rarely buys a product
    twice, so sums in front of that exchange would be wider and no fewer, and a task
    would hold as many groups as it reads rows.
    """
    names = {p: f"pay_{p}" for p in payments}
    rows = enriched.select("customer_id", "category", "product_id", "pay", "qty", cents("dollars").alias("cents"))
    own = {"cents": F.col("cents"), "qty": F.col("qty")} | {n: F.when(F.col("pay") == p, F.col("cents")) for p, n in names.items()}
    by_product = spread(rows, "customer_id", "category").groupBy("customer_id", "category", "product_id").agg(*[F.sum(x).alias(n) for n, x in own.items()])
    summed = [F.sum(n).alias(n) for n in own]
    by_category = by_product.groupBy("customer_id", "category").agg(*summed, F.count("product_id").alias("unique_products_bought"))
    here = {c: F.col("category") == c for c in categories}
    sums = by_category.groupBy("customer_id").agg(
        *summed, F.sum("unique_products_bought").alias("unique_products_bought"), F.count("category").alias("unique_categories_bought"),
        *[F.sum(F.when(is_, F.col("cents"))).alias(f"{c}_cat_sales") for c, is_ in here.items()],
        *[F.sum(F.when(is_, F.col("qty"))).alias(f"{c}_cat_units") for c, is_ in here.items()],
    )
    ordered = spread(enriched.select("customer_id", "order_id", "payment_type_id"), "customer_id", "order_id")
    by_order = ordered.groupBy("customer_id", "order_id", "payment_type_id").agg(F.count(F.lit(1)).alias("__n"))
    distinct = by_order.groupBy(F.col("customer_id").alias("__id")).agg(
        F.countDistinct("order_id").alias("orders"), F.countDistinct("payment_type_id").alias("unique_payments_used")
    )
    totals = sums.join(distinct, F.col("customer_id").eqNullSafe(F.col("__id"))).drop("__id")
    return totals.withColumn("sales", from_cents(F.col("cents")))


def overall_features(enriched: DataFrame) -> DataFrame:
    """Totals, distinct counts and the three ratios."""
    return _totals(enriched).select("customer_id", *_OVERALL, *[c.alias(n) for n, c in derived_ratios().items()])


def category_share_features(enriched: DataFrame, categories: Sequence[str]) -> DataFrame:
    """``<category>_cat_sales`` and ``<category>_cat_units``; null where nothing was bought."""
    shares = share_of_total(enriched, "customer_id", "category", {"dollars": "sales", "qty": "units"})
    return pivot_multi(
        shares,
        "customer_id",
        "category",
        categories,
        {"cat_sales": F.max("sales"), "cat_units": F.max("units")},
    )


def payment_share_features(enriched: DataFrame, payments: Sequence[str]) -> DataFrame:
    """``pay_<type>``, the share of sales by cleaned payment type."""
    labelled = enriched.select("customer_id", F.concat(F.lit("pay_"), "pay").alias("payment"), "dollars")
    shares = share_of_total(labelled, "customer_id", "payment", {"dollars": "share"})
    return pivot_single(shares, "customer_id", "payment", [f"pay_{p}" for p in payments], F.max("share"))


def customer_features(
    sales: DataFrame,
    product: DataFrame,
    payment: DataFrame,
    customer: DataFrame,
    categories: Sequence[str],
    payments: Sequence[str],
) -> DataFrame:
    """All features of a customer, with the flags of the customer table.

    The shares are conditional sums, so no feature block needs its own
    aggregate, pivot and join. A category or payment type that is not listed is
    an error.
    """
    rows = listed(listed(enrich(sales, product, payment), "category", categories), "pay", payments)
    money = {f"{c}_cat_sales" for c in categories} | {f"pay_{p}" for p in payments}
    features = _totals(rows, categories, payments).select(
        "customer_id",
        *_OVERALL,
        *[c.alias(n) for n, c in derived_ratios().items()],
        *[ratio(from_cents(F.col(n)), "sales").alias(n) if n in money else ratio(n, "qty").alias(n) for n in _share_names(categories, payments)],
    )
    flags = customer.select("customer_id", "email_subscribed", "omni_shopper")
    return features.join(flags, "customer_id", "left")


def _share_names(categories: Sequence[str], payments: Sequence[str]) -> list[str]:
    return [f"{c}_cat_{kind}" for c in categories for kind in ("sales", "units")] + [f"pay_{p}" for p in payments]


def feature_names(categories: Sequence[str], payments: Sequence[str]) -> list[str]:
    """26 names for five categories and five payment types."""
    return [*_OVERALL, *_RATIOS, *_share_names(categories, payments), "email_subscribed", "omni_shopper"]
