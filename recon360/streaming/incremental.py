"""Append files that arrived since the last run to a staging table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recon360.model import SEQ, STAGING_COLUMNS
from recon360.sources.files import CSV_FORMAT


def _schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in STAGING_COLUMNS[name]])


def ingest_new_files(
    spark: SparkSession, name: str, source_dir: str, target_dir: str, checkpoint_dir: str, multi_line: bool = True
) -> None:
    """Read every file not seen before, then stop.

    Each micro-batch replaces its own folder, so a batch that is run again after a failure leaves
    its rows once. ``multi_line=False`` lets large CSV files split when no field spans lines.
    """
    reader = spark.readStream.schema(_schema(name))
    csv = name != "support_tickets"
    if csv:
        stream = reader.options(**CSV_FORMAT, multiLine=multi_line, enforceSchema=False).csv(source_dir)
    else:
        stream = reader.options(mode="FAILFAST").json(source_dir)

    def append(batch: DataFrame, batch_id: int) -> None:
        place = F.struct(
            F.lit(batch_id).cast("long").alias("batch"),
            F.col("_file").alias("file"),
            F.col("_block").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        columns = [(F.coalesce(c, F.lit("")) if csv else F.col(c)).alias(c) for c in STAGING_COLUMNS[name]]
        batch.select(*columns, place.alias(SEQ)).write.mode("overwrite").parquet(f"{target_dir}/batch={batch_id}")

    query = (
        stream.select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
        )
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_staging(spark: SparkSession, target_dir: str) -> DataFrame:
    """All batches so far; earlier batches order first."""
    return spark.read.option("basePath", target_dir).parquet(target_dir).drop("batch")
