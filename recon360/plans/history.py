"""Exception counts of every run, and how they change from run to run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class History:
    """A table that runs append to; a run that is repeated takes the place of its earlier self.

    Each run is a folder of its own, so nothing of other runs is read or written when one is added.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def record(self, run: int, summary: DataFrame) -> None:
        """``summary`` has rule_id and n_exceptions; runs are ordered by their number."""
        counts = summary.select("rule_id", F.col("n_exceptions").cast("long"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={run}")

    def read(self) -> DataFrame:
        return self.spark.read.schema("rule_id string, n_exceptions long, run int").option("basePath", self.path).parquet(self.path)


def trend(history: DataFrame) -> DataFrame:
    """Per rule and run the count, that of the run before which has the rule, and the change."""
    order = Window.partitionBy("rule_id").orderBy("run")  # a rule has one row for each run
    before = F.lag("n_exceptions").over(order)
    change = F.col("n_exceptions") - F.col("previous")
    direction = F.when(change < 0, "better").when(change > 0, "worse").when(change == 0, "same").otherwise("new")
    return history.withColumn("previous", before).select(
        "rule_id", "run", "n_exceptions", "previous", change.alias("change"), direction.alias("direction")
    )


def last_change(history: DataFrame) -> DataFrame:
    """What the latest run changed against the one before, per rule."""
    last = history.agg(F.max("run").alias("run"))
    return trend(history).join(F.broadcast(last), "run")  # one row
