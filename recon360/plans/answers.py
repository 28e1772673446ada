"""The five business questions, on curated tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recon360.operators import predicates
from recon360.operators.references import with_unpaid
from recon360.plans.conform import ORDER_FACTS, Customer360
from recon360.sources.sinks import sorted_by


def _revenue(alias: str) -> Column:
    """Exact decimal sum, shown as a number with two decimals."""
    return F.round(F.sum("gross_order_amount"), 2).cast("double").alias(alias)


def revenue_by_month(t: Customer360) -> DataFrame:
    return (
        t.fact_order.where(predicates.completed() & F.col("order_date").isNotNull())
        .groupBy(F.date_format("order_date", "yyyy-MM").alias("month"))
        .agg(_revenue("completed_revenue"))
        .orderBy("month")
    )


def top_customers(t: Customer360, n: int = 10) -> DataFrame:
    """Ten rows are left before the names are looked up: a key in the fact is known to have one."""
    spent = (
        t.fact_order.where(predicates.completed() & F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(_revenue("total_completed_value"))
    )
    order = (F.col("total_completed_value").desc(), "customer_key")
    # written: ten rows go to the names, instead of all names to the ten rows
    best = t.work("top_customers", spent.orderBy(*order).limit(n))
    return (
        best.join(t.dim_customer.select("customer_key", "full_name"), "customer_key")
        .select("customer_key", "full_name", "total_completed_value")
        .orderBy(*order)
    )


def problem_orders(t: Customer360) -> DataFrame:
    problems = {
        "invalid_customer": F.col("customer_key").isNull(),
        "invalid_product": F.col("product_key").isNull(),
        "suspicious_qty": predicates.suspicious_quantity(),
        "total_mismatch": predicates.total_mismatch(),
        "missing_payment": predicates.missing_payment(),
        "payment_mismatch": predicates.payment_mismatch(),
    }
    flags = {name: F.coalesce(test, F.lit(False)) for name, test in problems.items()}
    rows = (
        with_unpaid(t.fact_order.select(*ORDER_FACTS), t.order_payments)
        .select("order_key", "order_status", F.col("gross_order_amount").cast("double").alias("gross_order_amount"), *[c.alias(k) for k, c in flags.items()])
        .where(" or ".join(flags))
    )
    shown = rows.withColumns({name: F.when(F.col(name), "Yes").otherwise("No") for name in flags})
    # a global sort runs its input twice, once to find the ranges; written first, the join runs once
    return sorted_by(t.work("problem_orders", shown), "order_key")


def revenue_by_state(t: Customer360) -> DataFrame:
    return (
        t.fact_order.where(predicates.completed() & F.col("shipping_state").isNotNull())
        .groupBy("shipping_state")
        .agg(_revenue("completed_revenue"))
        .orderBy(F.col("completed_revenue").desc(), "shipping_state")
    )


def order_problems_per_customer(orders: DataFrame, paid_orders: DataFrame) -> DataFrame:
    """What orders left-joined to payments would count per customer, without building that join.

    Every order counts once as if unpaid; its payments then correct that: an order with n payments
    stands in n joined rows and misses none. Both sums combine before the shuffle, so neither a hot order
    nor a hot customer is gathered in one place.
    """
    flags = {
        "orders_with_total_mismatch": predicates.total_mismatch(),
        "orders_missing_payment": predicates.completed(),
        "orders_with_suspicious_qty": predicates.suspicious_quantity(),
    }

    def flagged(df: DataFrame, *more: str) -> DataFrame:
        found = [F.coalesce(test, F.lit(False)).cast("long").alias(name) for name, test in flags.items()]
        return df.where(F.col("customer_key").isNotNull()).select("customer_key", "order_key", *found, *more)

    unpaid = flagged(orders).select(
        "customer_key", F.lit(1).alias("orders_placed"), F.lit(0).alias("orders_with_payment_mismatch"), *flags
    )
    paid = (
        flagged(paid_orders, "payment_key", "payment_status", "payment_amount", "gross_order_amount")
        .groupBy("customer_key", "order_key", *flags)
        .agg(F.count(F.lit(1)).alias("_n"), F.count_if(predicates.payment_mismatch()).alias("orders_with_payment_mismatch"))
    )
    more_rows = F.col("_n") - 1
    correction = paid.select(
        "customer_key",
        F.lit(0).alias("orders_placed"),
        "orders_with_payment_mismatch",
        (F.col("orders_with_total_mismatch") * more_rows).alias("orders_with_total_mismatch"),
        (-F.col("orders_missing_payment")).alias("orders_missing_payment"),
        (F.col("orders_with_suspicious_qty") * more_rows).alias("orders_with_suspicious_qty"),
    )
    counts = ["orders_placed", "orders_with_payment_mismatch", *flags]
    return unpaid.unionByName(correction).groupBy("customer_key").agg(*[F.sum(c).alias(c) for c in counts])


def tickets_vs_exceptions(t: Customer360) -> DataFrame:
    """Negative tickets with the order and payment problems of their customer.

    Tickets, orders and payments of one customer are never multiplied out: problems are counted per
    customer and only then meet the tickets.
    """
    counted = [
        "orders_with_total_mismatch", "orders_missing_payment", "orders_with_payment_mismatch",
        "orders_with_suspicious_qty",
    ]
    # a ticket id that occurs twice would count its customer's rows twice
    tickets = (
        t.fact_customer_issue.where(predicates.negative_ticket())
        .groupBy("ticket_id", "customer_key", "issue_category")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    names = t.dim_customer.select("customer_key", "full_name")
    problems = order_problems_per_customer(t.fact_order, t.order_payments)
    # one written row per customer: a single lookup, which adaptive execution can split by ticket
    customers = t.work("customer_problems", names.join(problems, "customer_key", "full"))
    rows = (
        tickets.join(customers, "customer_key", "left")
        .select(
            "ticket_id",
            "customer_key",
            F.coalesce("full_name", F.lit("Unknown")).alias("customer_name"),
            "issue_category",
            F.coalesce("orders_placed", F.lit(0)).alias("orders_placed"),
            *[F.coalesce(F.col(name) * F.col("_times"), F.lit(0)).alias(name) for name in counted],
        )
    )
    total = sum((F.col(name) for name in counted[1:]), F.col(counted[0]))
    # the sort runs its input twice; written first, the join runs once
    return t.work("ticket_problems", rows).orderBy(total.desc(), "ticket_id")


# in the order of the question catalog
Answer = Callable[[Customer360], DataFrame]
ANSWERS: dict[str, Answer] = {
    "bq1_revenue_by_month": revenue_by_month,
    "bq2_top_customers": top_customers,
    "bq3_problem_orders": problem_orders,
    "bq4_revenue_by_state": revenue_by_state,
    "bq5_tickets_vs_exceptions": tickets_vs_exceptions,
}
