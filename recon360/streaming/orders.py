"""The order fact kept up to date by batches of raw orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recon360.model import SEQ, curated_schema
from recon360.plans import conform
from recon360.streaming.upsert import KeyedTable, Mark


class OrderFacts:
    """Raw orders by id, and ``fact_order`` over them, in the same buckets.

    A batch is merged with the raw orders of the buckets it touches, of an id the earliest row by ``_seq``;
    the facts of those buckets are worked out anew, and no other file is read or written. ``mark`` names a
    column that grows from load to load: rows up to the highest value taken in are not read again.
    """

    def __init__(self, spark: SparkSession, path: str, mark: str | None = None, buckets: int = 64):
        self.raw = KeyedTable(spark, f"{path}/raw", ["order_id"], [SEQ], buckets=buckets)
        self.facts = KeyedTable(spark, f"{path}/facts", ["order_key"], buckets=buckets)
        self.mark = Mark(spark, f"{path}/mark", mark) if mark else None

    def add(self, orders: DataFrame, clusters: DataFrame, products: DataFrame) -> list[int]:
        """Take in raw orders; returns the buckets that were written."""
        new = self.mark.new_rows(orders) if self.mark else orders
        touched = self.raw.upsert(new.drop(self.mark.column) if self.mark else new)
        if touched:
            rows = conform.order_facts(self.raw.read(touched), clusters, products)
            self.facts.replace(conform.fit(rows, curated_schema()["fact_order"]))
        if self.mark:
            self.mark.advance(new)
        return touched

    def read(self) -> DataFrame:
        return self.facts.read()
