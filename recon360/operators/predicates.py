"""Tests shared by the rules, the answers and the checks. NULL input makes them NULL, as in SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recon360.functions.text import status_is

# Fixed value: differences up to one cent are no mismatch.
TOLERANCE = "0.01"


def differs(amount: Column) -> Column:
    return F.abs(amount) > F.lit(TOLERANCE).cast("decimal(3,2)")


def completed() -> Column:
    return status_is(F.col("order_status"), "completed")


def settled() -> Column:
    return status_is(F.col("payment_status"), "settled")


def negative_ticket() -> Column:
    return status_is(F.col("sentiment"), "negative")


def total_mismatch() -> Column:
    return differs(F.col("order_amount_variance"))


def payment_mismatch() -> Column:
    return F.col("payment_key").isNotNull() & settled() & differs(
        F.col("payment_amount") - F.col("gross_order_amount")
    )


def missing_payment() -> Column:
    return F.col("payment_key").isNull() & completed()


def suspicious_quantity() -> Column:
    return (F.col("quantity") <= 0) & completed()
