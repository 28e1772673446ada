"""Entity clusters that take in batches of customers.

Of what came before, only the holder of each match key and the cluster of each id are kept. The links of
a batch go from its ids to the holders of their keys; there each id is replaced by the root of its
cluster, so the components that are found anew are those of the few roots a batch touches. Everything
else, stored links above all, stays as it is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recon360.operators import entity
from recon360.sources.store import TableStore
from recon360.streaming.upsert import KeyedTable


class Clusters:
    """The stored state below ``path``: ``holders`` (matched_on, match_name, value, customer_id) and
    ``members`` (customer_id, customer_key), both by key and rewritten only where a batch changes them."""

    def __init__(self, spark: SparkSession, path: str, match_on: Mapping[str, str] = entity.MATCH_ON, buckets: int = 64):
        self.spark, self.match_on = spark, match_on
        self.holders = KeyedTable(spark, f"{path}/holders", ["matched_on", "match_name", "value"], ["customer_id"], buckets=buckets)
        self.members = KeyedTable(spark, f"{path}/members", ["customer_id"], ["customer_key"], buckets=buckets)
        # by cluster, to find the members of a cluster whose root changes
        self.by_root = KeyedTable(spark, f"{path}/by_root", ["customer_key", "customer_id"], bucket_by=["customer_key"], buckets=buckets)

    def add(self, customers: DataFrame, store: TableStore) -> None:
        """Take in customers, one row per id; ids that are known already must come with the same keys."""
        known = self.members.exists()
        keys = store("batch_keys", entity.match_keys(customers))
        kinds = [F.struct(F.lit(kind).alias("matched_on"), F.col(column).alias("value")) for kind, column in self.match_on.items()]
        keyed = store("batch_keyed", keys.select("customer_id", "match_name", F.inline(F.array(*kinds))).where("value is not null"))
        columns = ["matched_on", "match_name", "value"]
        first = keyed.groupBy(columns).agg(F.min("customer_id").alias("hub"))
        if known:
            held = self.holders.read_for(keyed).withColumnRenamed("customer_id", "held")
            first = first.join(held, columns, "left").select(*columns, F.coalesce("held", "hub").alias("hub"))
        hubs = store("batch_hubs", first)
        links = keyed.join(hubs, columns).where("customer_id <> hub").select("customer_id", "hub").distinct()

        ids = store("batch_ids", keys.select("customer_id").unionByName(links.select(F.col("hub").alias("customer_id"))).distinct())
        if known:
            rooted = ids.join(self.members.read_for(ids), "customer_id", "left")
        else:
            rooted = ids.withColumn("customer_key", F.lit(None).cast("string"))
        roots = store("batch_roots", rooted.select(
            "customer_id", F.coalesce("customer_key", "customer_id").alias("root"), F.col("customer_key").isNull().alias("unknown")
        ))
        a, b = (roots.select(F.col("customer_id").alias(f"{x}_id"), F.col("root").alias(x)) for x in "ab")
        contracted = links.join(a, F.col("customer_id") == F.col("a_id")).join(b, F.col("hub") == F.col("b_id")).where("a <> b")
        edges = contracted.select(F.greatest("a", "b").alias("upper"), F.least("a", "b").alias("lower")).distinct()
        moved = store("batch_moved", entity.smallest_in_component(edges, store))

        new = moved.withColumnRenamed("root", "customer_key")
        placed = roots.join(new, roots["root"] == new["id"], "left").where("unknown or customer_key is not null")
        changed = placed.select("customer_id", F.coalesce("customer_key", "root").alias("customer_key"))
        if known:
            # members of clusters that lost their root
            of = new.select(F.col("id").alias("customer_key"))
            lost = self.by_root.read_for(of).join(new.withColumnRenamed("customer_key", "new_key"), F.col("customer_key") == F.col("id"))
            changed = changed.unionByName(lost.select("customer_id", F.col("new_key").alias("customer_key")))
        changed = store("batch_changed", changed.distinct())
        self.holders.upsert(keyed.join(hubs, columns).select(*columns, F.col("hub").alias("customer_id")).distinct())
        self.by_root.upsert(changed)
        self.members.upsert(changed)

    def clusters(self) -> DataFrame:
        """(customer_id, customer_key) of every id so far."""
        return self.members.read()
