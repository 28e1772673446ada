"""The five staging tables derived from the order tables at hand, with planted anomalies.

Source rows are clean, so fixed arithmetic on their keys plants repeated ids, shared contacts, odd
spellings, mixed date formats, dangling references and wrong amounts.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recon360.model import SEQ, STAGING_COLUMNS
from recon360.operators import dedup
from recon360.plans.conform import Store


LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
]


def _pad(c: Column) -> Column:
    return F.lpad(c.cast("string"), 9, "0")


def _pick(c: Column, *values: object) -> Column:
    """The value whose position equals ``c``."""
    first, *rest = values
    choice = F.when(c == 0, first)
    for i, v in enumerate(rest, start=1):
        choice = choice.when(c == i, v)
    return choice


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _states(c: Column) -> Column:
    return _pick(c % 8, "IL", "Illinois", "new york", "ca", "TX", "Florida", "Ontario", "")


def bind_customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    person = F.when((k % 30).isin(27, 28, 29), k - k % 30 + 27).when(k % 10 == 6, k - 1).otherwise(k)
    day = F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int"))
    email = F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com"))
    email_before = F.concat(F.lit("user"), (k - 1).cast("string"), F.lit("@example.com"))
    phone = F.concat(F.lit("555-"), _pad(k))
    phone_before = F.concat(F.lit("555-"), _pad(k - 1))
    base = customer.select(
        "c_custkey",
        F.concat(F.lit("C"), _pad(k)).alias("customer_id"),
        F.concat(F.lit("First"), (person % 89).cast("string")).alias("first_name"),
        F.concat(F.when(k % 2 == 1, "LAST").otherwise(" Last"), person.cast("string")).alias("last_name"),
        F.when((k % 50).isin(2, 22), "")
        .when(k % 30 == 29, email_before)
        .when(k % 20 == 16, F.upper(email_before))
        .otherwise(email)
        .alias("email"),
        F.when(k % 40 == 11, "")
        .when((k % 30 == 28) | (k % 20 == 6) | (k % 10 == 4), phone_before)
        .otherwise(phone)
        .alias("phone"),
        _pick(k % 5, "USA", "US", "United States", " usa ", "Canada").alias("country"),
        _states(k).alias("state"),
        F.when(k % 25 == 4, "not_a_date")
        .otherwise(
            _pick(
                k % 5,
                F.date_format(day, "yyyy-MM-dd"),
                F.date_format(day, "MM/dd/yyyy"),
                F.date_format(day, "yyyy/MM/dd"),
                F.date_format(day, "MM-dd-yyyy"),
                F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            )
        )
        .alias("signup_date"),
        F.col("c_mktsegment").alias("loyalty_tier"),
        F.lit(0).alias(SEQ),
    )
    again = base.where((k % 50).isin(2, 7, 31)).withColumns(
        {
            "email": F.when(k % 50 == 7, "").when(k % 50 == 2, email).otherwise(F.col("email")),
            "loyalty_tier": F.when(k % 50 == 31, "OTHER").otherwise(F.col("loyalty_tier")),
            SEQ: F.lit(1),
        }
    )
    return base.unionByName(again).select(*STAGING_COLUMNS["customers"], SEQ)


def bind_products(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    price = _money(F.col("p_retailprice")).cast("string")
    return part.select(
        F.concat(F.lit("P"), _pad(k)).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(k % 3 == 0, F.concat(F.lit("$"), price)).otherwise(price).alias("unit_price"),
        _pick(k % 7, "Y", "N", "yes", "0", "", "maybe", "TRUE").alias("active_flag"),
        F.lit(0).alias(SEQ),
    )


def bind_orders(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Order rows plus the helper columns ``_orderkey``, ``_orderdate``, ``_total`` and ``_place``.

    ``_place`` counts the rows of one order id by ``_seq``: these lie together after the join by order.
    """
    lines = lineitem.select(*LINE_COLUMNS)
    heads = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    prices = part.select("p_partkey", "p_retailprice")
    rows = lines.join(prices, F.col("l_partkey") == F.col("p_partkey")).join(
        heads, F.col("l_orderkey") == F.col("o_orderkey")
    )
    seq = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    place = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy(seq))
    rows = rows.withColumn("_place", place)
    k, cust, item = F.col("l_orderkey"), F.col("o_custkey"), F.col("l_partkey")
    no_number = k % 223 == 5
    pieces = F.col("l_quantity").cast("int")
    signed = F.when((k % 211 == 3) & ~no_number, -pieces).otherwise(pieces)
    surcharge = F.when(k % 53 == 0, 6).otherwise(0).cast("decimal(18,2)")
    total = _money(signed.cast("decimal(10,0)") * _money(F.col("p_retailprice")) + surcharge)
    at = F.col("o_orderdate")
    return rows.select(
        F.concat(F.lit("O"), k.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.when(cust % 101 == 0, "C999999999").otherwise(F.concat(F.lit("C"), _pad(cust))).alias("customer_id"),
        _pick(
            k % 6,
            F.date_format(at, "yyyy-MM-dd HH:mm:ss"),
            F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            F.date_format(at, "yyyy-MM-dd HH:mm"),
            F.date_format(at, "MM/dd/yyyy HH:mm"),
            F.date_format(at, "yyyy/MM/dd HH:mm"),
            F.date_format(at, "MM-dd-yyyy HH:mm"),
        ).alias("order_ts"),
        F.when(item % 97 == 1, "P999999999").otherwise(F.concat(F.lit("P"), _pad(item))).alias("product_id"),
        F.when(no_number, "abc").otherwise(signed.cast("string")).alias("quantity"),
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "Completed")
        .when(F.col("o_orderstatus") == "P", "cancelled")
        .alias("order_status"),
        _states(cust).alias("shipping_state"),
        total.cast("string").alias("order_total"),
        seq.alias(SEQ),
        k.alias("_orderkey"),
        at.alias("_orderdate"),
        total.alias("_total"),
        "_place",
    )


def bind_payments(orders: DataFrame) -> DataFrame:
    """One payment for the first row of most order ids, two for some."""
    k, total = F.col("_orderkey"), F.col("_total")
    columns = ("order_id", SEQ, "_orderkey", "_orderdate", "_total")
    first = orders.where("order_id is not null and _place = 1").select(*columns)
    # rows without an id are one id together, whatever their order
    paid = first.unionByName(dedup.keep_first(orders.where("order_id is null").select(*columns), "order_id"))
    status = F.when(k % 19 == 0, "refunded").when(k % 23 == 0, "voided").otherwise("settled")
    extra = F.when(k % 59 == 0, 5).otherwise(0).cast("decimal(18,2)")
    amount = (
        F.when(k % 19 == 0, _money(-total))
        .when(k % 23 == 0, _money(F.lit(0)))
        .otherwise(_money(total + extra))
    )
    prefixes = F.when(k % 67 == 0, F.array(F.lit("M"), F.lit("N"))).otherwise(F.array(F.lit("M")))
    return paid.where(k % 37 != 0).select(
        F.explode(prefixes).alias("_prefix"), "*"
    ).select(
        F.concat("_prefix", "order_id").alias("payment_id"),
        F.when(k % 307 == 11, "O999999999-0").otherwise(F.col("order_id")).alias("order_id"),
        F.date_format(F.col("_orderdate") + F.expr("interval 1 minute"), "yyyy-MM-dd HH:mm").alias("payment_ts"),
        _pick(k % 3, "card", "paypal", "apple_pay").alias("payment_method"),
        status.alias("payment_status"),
        amount.cast("string").alias("amount"),
        F.lit(0).alias(SEQ),
    )


def bind_tickets(events: DataFrame) -> DataFrame:
    e, user = F.col("event_id"), F.col("user_id")
    return events.select(
        F.concat(F.lit("T"), e.cast("string")).alias("ticket_id"),
        F.when(user % 29 == 7, "C999999999").otherwise(F.concat(F.lit("C"), _pad(user))).alias("customer_id"),
        F.when(e % 83 == 0, "")
        .when(e % 41 == 0, "bad_timestamp")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("created_ts"),
        _pick(e % 3, "email", "chat", "phone").alias("channel"),
        _pick(e % 5, "delivery", "product_quality", "return", "billing", "account").alias("category"),
        F.when(F.col("event_type") == "error", "negative")
        .when(F.col("event_type").isin("view", "click"), "Neutral")
        .otherwise("positive")
        .alias("sentiment"),
        F.col("props").alias("description"),
        F.lit(0).alias(SEQ),
    )


class BoundStaging:
    """Staging over the order tables below ``sf_dir``.

    Customers, products and tickets are projections of one table each. Orders take two joins and
    payments a deduplication, so those two are written on first use.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, store: Store):
        self._spark, self._dir, self._store = spark, sf_dir, store

    def _table(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        return bind_customers(self._table("customer"))

    @cached_property
    def products(self) -> DataFrame:
        return bind_products(self._table("part"))

    @cached_property
    def _orders(self) -> DataFrame:
        lines = self._table("lineitem").select(*LINE_COLUMNS)
        return self._store("staging_orders", bind_orders(lines, self._table("orders"), self._table("part")))

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders.select(*STAGING_COLUMNS["orders"], SEQ)

    @cached_property
    def payments(self) -> DataFrame:
        return self._store("staging_payments", bind_payments(self._orders))

    @cached_property
    def support_tickets(self) -> DataFrame:
        return bind_tickets(self._table("events"))
