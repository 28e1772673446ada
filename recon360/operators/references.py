"""Joins between facts and their parents.

The fact is on the left of every lookup: parents are unique on their key, so the join never fans
out, and adaptive execution can split a hot foreign key on the left side of a left join. Nothing is
broadcast by hint; Spark does so only below its own size threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_customer(df: DataFrame, clusters: DataFrame) -> DataFrame:
    """Add ``customer_key``: the canonical id, or NULL when the raw id is unknown."""
    parent = clusters.select(F.col("customer_id").alias("_ref"), "customer_key")
    return df.join(parent, df["customer_id"] == parent["_ref"], "left").drop("_ref")


def resolve_product(df: DataFrame, products: DataFrame) -> DataFrame:
    """Add ``product_key`` (NULL when unknown) and the ``unit_price`` that goes with it."""
    parent = products.select("product_key", "unit_price")
    return df.join(parent, df["product_id"] == parent["product_key"], "left")


def resolve_order(df: DataFrame, orders: DataFrame) -> DataFrame:
    """Add ``order_key``, or NULL when the payment's order does not exist."""
    parent = orders.select("order_key")
    return df.join(parent, df["order_id"] == parent["order_key"], "left")


def crosswalk_remap(df: DataFrame, crosswalk: DataFrame, id_column: str) -> DataFrame:
    """Add ``canonical_id``: where the crosswalk sends the id, else the id itself."""
    return df.join(crosswalk, df[id_column] == crosswalk["old_customer_id"], "left").select(
        *df.columns, F.coalesce("canonical_customer_id", id_column).alias("canonical_id")
    )


def trace_to_raw(curated: DataFrame, key: str, raw: DataFrame, raw_id: str, *raw_columns: str) -> DataFrame:
    """Curated rows with the raw values behind them, one output row per raw row with that id."""
    source = raw.select(F.col(raw_id).alias("_raw_id"), *raw_columns)
    return curated.join(source, F.col(key) == F.col("_raw_id")).drop("_raw_id")


def dangling(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent."""
    return df.where(F.col(key).isNotNull()).join(parents, df[key] == parents[parent_key], "left_anti")


def payments_of_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Each payment of a known order with the columns of that order.

    An inner join of two shuffled sides: an order that holds a large share of all payments splits.
    """
    paying = payments.select(
        F.col("order_key").alias("_order"), "payment_key", "payment_status", "payment_amount"
    )
    return orders.join(paying, orders["order_key"] == paying["_order"]).drop("_order")


def with_unpaid(orders: DataFrame, paid: DataFrame) -> DataFrame:
    """The paid orders of ``paid`` plus those of ``orders`` that are not among them.

    Together a left join of orders to payments, which itself could not split a hot order, as its payments
    sit on the right side. The keys seen in ``paid`` are reduced before the shuffle.
    """
    seen = paid.select(F.col("order_key").alias("_order")).distinct()
    unpaid = orders.join(seen, orders["order_key"] == seen["_order"], "left_anti")
    return paid.unionByName(unpaid, allowMissingColumns=True)


def orders_with_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders left-joined to their payments, one row per payment, unpaid orders kept."""
    paid = payments_of_orders(orders, payments)
    keys = payments.where(F.col("order_key").isNotNull()).select(F.col("order_key").alias("_order")).distinct()
    unpaid = orders.join(keys, orders["order_key"] == keys["_order"], "left_anti")
    return paid.unionByName(unpaid, allowMissingColumns=True)
