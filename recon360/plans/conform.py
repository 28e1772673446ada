"""Staging rows to dimensions and facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recon360.functions import parsing, text
from recon360.model import AMOUNT, DERIVED_AMOUNT, Staging, curated_schema
from recon360.operators import dedup, entity, references
from recon360.sources import mapping

Store = Callable[[str, DataFrame], DataFrame]


def fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; a column nobody computes is NULL."""
    lost = [c for c in df.columns if c not in schema.names]
    if lost:
        raise ValueError(f"the target mapping has no place for {lost}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def dim_customer(customers: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """One row per canonical customer; ``customers`` has one row per id."""
    return entity.with_merge_flag(customers, crosswalk).select(
        F.col("customer_id").alias("customer_key"),
        text.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        text.clean_email(F.col("email")).alias("email"),
        text.clean_phone(F.col("phone")).alias("phone"),
        text.normalize_country(F.col("country")).alias("standard_country"),
        text.normalize_state(F.col("state")).alias("standard_state"),
        parsing.parse_date(F.col("signup_date")).alias("signup_date"),
        "loyalty_tier",
        "duplicate_resolution_flag",
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("product_id").alias("product_key"),
        "product_name",
        "category",
        parsing.parse_money(F.col("unit_price")).alias("unit_price"),
        parsing.decode_active_flag(F.col("active_flag")).alias("active_flag"),
    )


def order_amounts(orders: DataFrame) -> DataFrame:
    """Add what the order should have cost and how far the stated total is off.

    Needs ``quantity``, ``unit_price`` and ``gross_order_amount``; NULL in, NULL out.
    """
    price = F.col("unit_price").cast(AMOUNT)
    calculated = F.round(F.col("quantity").cast("decimal(19,0)") * price, 2).cast(DERIVED_AMOUNT)
    variance = F.round(F.col("gross_order_amount") - F.col("calculated_order_amount"), 2).cast(DERIVED_AMOUNT)
    return orders.withColumn("calculated_order_amount", calculated).withColumn("order_amount_variance", variance)


def fact_order(orders: DataFrame, clusters: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order id; unknown customers and products leave NULL keys."""
    return order_facts(dedup.keep_first(orders, "order_id"), clusters, products)


def order_facts(orders: DataFrame, clusters: DataFrame, products: DataFrame) -> DataFrame:
    """The fact of each raw order; ``orders`` has one row per id."""
    parsed = orders.select(
        F.col("order_id").alias("order_key"),
        "customer_id",
        "product_id",
        parsing.parse_date(F.col("order_ts")).alias("order_date"),
        parsing.parse_quantity(F.col("quantity")).alias("quantity"),
        "order_status",
        text.normalize_state(F.col("shipping_state")).alias("shipping_state"),
        parsing.parse_money(F.col("order_total")).alias("gross_order_amount"),
    )
    priced = references.resolve_product(references.resolve_customer(parsed, clusters), products)
    # a product whose key is blank text counts as known but has no price
    priced = priced.withColumn("unit_price", F.when(F.col("product_key") != "", F.col("unit_price")))
    return order_amounts(priced).drop("customer_id", "product_id", "unit_price")


def fact_payment(payments: DataFrame, orders: DataFrame) -> DataFrame:
    parsed = payments.select(
        F.col("payment_id").alias("payment_key"),
        "order_id",
        parsing.parse_date(F.col("payment_ts")).alias("payment_date"),
        "payment_method",
        "payment_status",
        parsing.parse_money(F.col("amount")).alias("payment_amount"),
    )
    return references.resolve_order(parsed, orders).drop("order_id")


def fact_customer_issue(tickets: DataFrame, clusters: DataFrame) -> DataFrame:
    parsed = tickets.select(
        "ticket_id",
        "customer_id",
        parsing.parse_date(F.col("created_ts")).alias("created_date"),
        "channel",
        F.col("category").alias("issue_category"),
        "sentiment",
        "description",
    )
    return references.resolve_customer(parsed, clusters).drop("customer_id")


# what rules, answers and checks ask of an order besides its payments
ORDER_FACTS = (
    "order_key", "customer_key", "product_key", "quantity", "order_status", "gross_order_amount", "order_amount_variance",
)


class Customer360:
    """The tables of one run, each built and written on first use.

    ``store(name, df)`` writes a table and returns it as a scan, so every later step starts from
    files and not from the whole lineage; ``work`` does so for tables that only serve the run.
    """

    def __init__(
        self,
        staging: Staging,
        store: Store,
        match_on: Mapping[str, str] = entity.MATCH_ON,
        schemas: Mapping[str, T.StructType] | None = None,
        work: Store | None = None,
        mapped: Mapping[str, list[mapping.MappedColumn]] | None = None,
    ):
        self.staging = staging
        self.store = store
        self.work = work or store
        self.match_on = match_on
        self.schemas = schemas or curated_schema()
        self.mapped = mapped or {}

    def _curated(self, name: str, df: DataFrame) -> DataFrame:
        return self.store(name, fit(df, self.schemas[name]))

    @cached_property
    def customers(self) -> DataFrame:
        """Raw customers, one row per id."""
        return self.work("customers_by_id", dedup.keep_most_complete(self.staging.customers, "customer_id"))

    @cached_property
    def id_crosswalk(self) -> DataFrame:
        return entity.id_crosswalk(entity.match_keys(self.customers), self.work, self.match_on)

    @cached_property
    def clusters(self) -> DataFrame:
        return self.work(
            "entity_clusters", entity.entity_clusters(self.customers.select("customer_id"), self.id_crosswalk)
        )

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._curated("dim_customer", dim_customer(self.customers, self.id_crosswalk))

    @cached_property
    def dim_product(self) -> DataFrame:
        """By the mapping alone where it names the source of every column."""
        columns = mapping.direct(self.mapped, "dim_product")
        products = self.staging.products
        return self._curated("dim_product", mapping.project(products, columns) if columns else dim_product(products))

    @cached_property
    def fact_order(self) -> DataFrame:
        return self._curated("fact_order", fact_order(self.staging.orders, self.clusters, self.dim_product))

    @cached_property
    def fact_payment(self) -> DataFrame:
        return self._curated("fact_payment", fact_payment(self.staging.payments, self.fact_order))

    @cached_property
    def fact_customer_issue(self) -> DataFrame:
        return self._curated(
            "fact_customer_issue", fact_customer_issue(self.staging.support_tickets, self.clusters)
        )

    @cached_property
    def order_payments(self) -> DataFrame:
        """Payments of known orders with the order's columns: joined once for rules, answers and checks."""
        orders = self.fact_order.select(*ORDER_FACTS)
        return self.work("order_payments", references.payments_of_orders(orders, self.fact_payment))

    def _trace(self, name: str, lost: DataFrame, raw: DataFrame, raw_id: str, *raw_columns: str) -> DataFrame:
        """Raw values behind the few curated rows that lost something.

        Those rows are written first: the join then knows their real size, and only ships the raw
        table across the network when they are too many to send to it.
        """
        lost = self.work(f"lost_{name}", lost)
        return self.work(f"trace_{name}", references.trace_to_raw(lost, lost.columns[0], raw, raw_id, *raw_columns))

    @cached_property
    def order_trace(self) -> DataFrame:
        """Raw ids of orders without a known customer or product."""
        lost = self.fact_order.where("customer_key is null or product_key is null").selectExpr(
            "order_key", "customer_key is null as no_customer", "product_key is null as no_product"
        )
        return self._trace("orders", lost, self.staging.orders, "order_id", "customer_id", "product_id")

    @cached_property
    def payment_trace(self) -> DataFrame:
        """Raw order ids of payments without a known order."""
        lost = self.fact_payment.where("order_key is null").select("payment_key")
        return self._trace("payments", lost, self.staging.payments, "payment_id", "order_id")

    @cached_property
    def ticket_trace(self) -> DataFrame:
        """Raw customer ids and times of tickets without a known customer or a readable time."""
        lost = self.fact_customer_issue.where("customer_key is null or created_date is null").select(
            F.col("ticket_id").alias("ticket_key"),
            F.col("customer_key").isNull().alias("no_customer"),
            F.col("created_date").isNull().alias("no_date"),
        )
        return self._trace("tickets", lost, self.staging.support_tickets, "ticket_id", "customer_id", "created_ts")

    def curated(self) -> dict[str, DataFrame]:
        names = ["dim_customer", "dim_product", "fact_order", "fact_payment", "fact_customer_issue"]
        return {name: getattr(self, name) for name in names}
