"""Which customer of a component survives, and what its row takes over from the others.

The components are those of the crosswalk. A strategy orders the rows of a component; the first one gives
the surviving id, and every field comes from the first row that has something in it. Both are partial
minima over (order, value), so a component of any size is reduced before it crosses the network, and
customers without a partner take no part in it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recon360.functions import parsing
from recon360.functions.text import completeness
from recon360.operators.dedup import business_columns

# Best first; what is not named comes last.
TIERS = ["PLATINUM", "GOLD", "SILVER", "BRONZE"]


def _fullest(df: DataFrame) -> list[Column]:
    return [-completeness(c for c in business_columns(df) if c != "customer_id")]


def _latest(df: DataFrame) -> list[Column]:
    """An unreadable date comes last; the fuller row among equals."""
    day = F.unix_date(parsing.parse_date(F.col("signup_date")))
    return [day.isNull(), -F.coalesce(day, F.lit(0)), *_fullest(df)]


def by_tier(tiers: Sequence[str] = TIERS) -> Callable[[DataFrame], list[Column]]:
    def order(df: DataFrame) -> list[Column]:
        place = F.array_position(F.array(*[F.lit(t.lower()) for t in tiers]), F.lower("loyalty_tier"))
        return [F.coalesce(F.nullif(place.cast("int"), F.lit(0)), F.lit(len(tiers) + 1)), *_fullest(df)]

    return order


def smallest_id(df: DataFrame) -> list[Column]:
    """No order but that of the ids."""
    return []


STRATEGIES: dict[str, Callable[[DataFrame], list[Column]]] = {
    "smallest_id": smallest_id,
    "most_complete": _fullest,
    "latest_signup": _latest,
    "highest_tier": by_tier(),
}


def _members(customers: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """The customers that share a component with others, with its ``component``."""
    of = crosswalk.select(F.col("old_customer_id").alias("_id"), F.col("canonical_customer_id").alias("component"))
    roots = of.select(F.col("component").alias("_id"), "component").distinct()
    of = of.unionByName(roots)
    return customers.join(of, customers["customer_id"] == of["_id"]).drop("_id")


def elect(customers: DataFrame, crosswalk: DataFrame, strategy: Callable[[DataFrame], list[Column]]) -> DataFrame:
    """(component, survivor, n_merged and the fields of ``customers``) for every component of several ids.

    ``customers`` has one row per id. Equal rows by the strategy are ordered by id.
    """
    fields = [c for c in business_columns(customers) if c != "customer_id"]
    members = _members(customers, crosswalk)
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(strategy(customers))], F.col("customer_id").alias("id"))
    ordered = members.withColumn("_place", place)
    best = [
        F.coalesce(F.min(F.when(F.col(c) != "", F.struct("_place", c)))[c], F.min(F.struct("_place", c))[c]).alias(c) for c in fields
    ]
    return ordered.groupBy("component").agg(
        F.min("_place")["id"].alias("survivor"), F.count(F.lit(1)).alias("n_merged"), *best
    )


def surviving_customers(customers: DataFrame, crosswalk: DataFrame, elected: DataFrame) -> DataFrame:
    """One row per person: elected rows under their survivor's id, and all customers without a partner."""
    gone = crosswalk.select(F.col("old_customer_id").alias("_id"))
    gone = gone.unionByName(elected.select(F.col("component").alias("_id")))
    alone = customers.join(gone, customers["customer_id"] == gone["_id"], "left_anti")
    merged = elected.withColumnRenamed("survivor", "customer_id").drop("component")
    return merged.unionByName(alone.select(*business_columns(customers), F.lit(1).cast("long").alias("n_merged")))


def rerooted(crosswalk: DataFrame, elected: DataFrame) -> DataFrame:
    """The crosswalk with survivors in the place of the smallest ids."""
    roots = elected.select("component", "survivor")
    moved = crosswalk.join(roots, crosswalk["canonical_customer_id"] == roots["component"])
    old = moved.select("old_customer_id", F.col("survivor").alias("canonical_customer_id"))
    former = roots.select(F.col("component").alias("old_customer_id"), F.col("survivor").alias("canonical_customer_id"))
    return old.unionByName(former).where("old_customer_id <> canonical_customer_id")
