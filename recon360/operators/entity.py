"""Which customer ids are the same person.

Two ids match when the normalised name agrees and so does the phone or the email. Instead of
comparing pairs, every id is linked to the smallest id that shares a (name, phone) or (name, email)
key: at most one link per id and key kind, and the same connected components as all pairs would give.

Adaptive execution splits a hot key only where both sides of a join come straight from a shuffle, so
every aggregate is written before it is joined back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recon360.functions import text

Store = Callable[[str, DataFrame], DataFrame]

# kind of match -> column that must agree besides the name
MATCH_ON = {"phone": "match_phone", "email": "match_email"}


def match_keys(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        text.match_name(F.col("first_name"), F.col("last_name")).alias("match_name"),
        text.match_phone(F.col("phone")).alias("match_phone"),
        text.clean_email(F.col("email")).alias("match_email"),
    )


def shared_key_links(keys: DataFrame, store: Store, match_on: Mapping[str, str] = MATCH_ON) -> DataFrame:
    """(customer_id, linked_id, matched_on): each id to the smallest id with the same key."""
    kinds = [
        F.struct(F.lit(kind).alias("matched_on"), F.col(column).alias("value"))
        for kind, column in match_on.items()
    ]
    keyed = keys.select("customer_id", "match_name", F.inline(F.array(*kinds))).where("value is not null")
    hubs = (
        keyed.groupBy("matched_on", "match_name", "value")
        .agg(F.min("customer_id").alias("linked_id"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    hubs = store("shared_keys", hubs)
    return (
        keyed.join(hubs, ["matched_on", "match_name", "value"])
        .where("customer_id > linked_id")
        .select("customer_id", "linked_id", "matched_on")
    )


def _settled(edges: DataFrame) -> bool:
    """True when every upper id has one edge and no lower id has an edge of its own."""
    ends = edges.select(F.col("upper").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionByName(
        edges.select(F.col("lower").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("low"))
    )
    seen = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("low").alias("low"))
    return seen.where("up > 1 or (up = 1 and low = 1)").isEmpty()


def _star_round(edges: DataFrame, store: Store, number: int) -> DataFrame:
    """One large-star and one small-star step (Kiveris et al., SoCC 2014) on upper > lower edges.

    Both steps are a partial ``min`` per id and an equi-join back to the edge list; the edge list
    never grows, and a hub with very many edges is never gathered in one group.
    """

    def lowest(name: str, e: DataFrame) -> DataFrame:
        return store(
            f"{name}_{number}", e.groupBy(F.col("upper").alias("id")).agg(F.min("lower").alias("lowest"))
        )

    # large star: hang each id on the lowest neighbour of its lower end
    hop = lowest("lowest_before", edges)
    far = store(
        f"far_{number}",
        edges.join(hop, edges["lower"] == hop["id"], "left")
        .select("upper", F.coalesce("lowest", "lower").alias("lower"))
        .distinct(),
    )
    # small star: hang all lower neighbours of an id on the lowest of them
    hop = lowest("lowest_after", far)
    near = (
        far.join(hop, far["upper"] == hop["id"])
        .where(F.col("lower") > F.col("lowest"))
        .select(F.col("lower").alias("upper"), F.col("lowest").alias("lower"))
    )
    kept = hop.select(F.col("id").alias("upper"), F.col("lowest").alias("lower"))
    return store(f"links_{number}", kept.unionByName(near).distinct())


def smallest_in_component(links: DataFrame, store: Store) -> DataFrame:
    """(id, root) for every id that is not the smallest of its connected component.

    ``links`` has columns ``upper > lower`` of one ordered type, text or numbers. Each round is written out, which cuts the
    lineage and survives the loss of executors.
    """
    edges = store("links_0", links.select("upper", "lower").distinct())
    done = 0
    while not _settled(edges):
        done += 1
        edges = _star_round(edges, store, done)
    return edges.select(F.col("upper").alias("id"), F.col("lower").alias("root"))


def id_crosswalk(keys: DataFrame, store: Store, match_on: Mapping[str, str] = MATCH_ON) -> DataFrame:
    links = shared_key_links(keys, store, match_on).select(
        F.col("customer_id").alias("upper"), F.col("linked_id").alias("lower")
    )
    return smallest_in_component(links, store).select(
        F.col("id").alias("old_customer_id"), F.col("root").alias("canonical_customer_id")
    )


def entity_clusters(customer_ids: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """(customer_id, customer_key) for every known id."""
    return customer_ids.join(
        crosswalk, customer_ids["customer_id"] == crosswalk["old_customer_id"], "left"
    ).select("customer_id", F.coalesce("canonical_customer_id", "customer_id").alias("customer_key"))


def with_merge_flag(customers: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Canonical customers only, with 1 where another id was merged in.

    An id is either absorbed or a root, never both, so one join serves both questions.
    """
    role = (
        crosswalk.select(F.col("old_customer_id").alias("_id"), F.lit(0).alias("_root"))
        .unionByName(crosswalk.select(F.col("canonical_customer_id").alias("_id"), F.lit(1).alias("_root")).distinct())
    )
    return (
        customers.join(role, customers["customer_id"] == role["_id"], "left")
        .where("_root is null or _root = 1")
        .withColumn("duplicate_resolution_flag", F.coalesce("_root", F.lit(0)))
        .drop("_id", "_root")
    )
