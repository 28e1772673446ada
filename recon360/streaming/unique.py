"""Each event once, from files that bring some twice and some late."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_unique(
    spark: SparkSession,
    schema: T.StructType,
    source_dir: str,
    target_dir: str,
    checkpoint_dir: str,
    key: str,
    event_time: str,
    delay: str = "1 hour",
    files_per_batch: int | None = None,
) -> int:
    """Read Parquet files not seen before, write the first row of each key, then stop.

    Keys live in the state store until the watermark (the latest event time seen, less ``delay``) has
    passed them by ``delay``, so the state is bounded by the events of that time, not by all there were.
    A restart goes on from the checkpoint. Each batch replaces its own folder, so one that is run again
    leaves its rows once. Returns how many rows came too late and were left out; ``late_rows`` gives them.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    unique = reader.parquet(source_dir).withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target_dir}/batch={batch_id}")

    query = (
        unique.writeStream.foreachBatch(append)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p.stateOperators]
    return sum(o.numRowsDroppedByWatermark for p in progress for o in p.stateOperators)


def read_unique(spark: SparkSession, schema: T.StructType, target_dir: str) -> DataFrame:
    return spark.read.schema(schema).option("basePath", target_dir).parquet(f"{target_dir}/batch=*")


def late_rows(spark: SparkSession, schema: T.StructType, source_dir: str, target_dir: str, key: str) -> DataFrame:
    """Source rows whose key was never written: all of them came after the watermark had passed."""
    source = spark.read.schema(schema).parquet(source_dir)
    seen = read_unique(spark, schema, target_dir).select(F.col(key).alias("_seen"))
    return source.join(seen, source[key] == seen["_seen"], "left_anti")
