"""A table by key that takes in batches and rewrites only the partitions a batch touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recon360.session import shuffle_partitions

BUCKET = "_bucket"
SLICE = "_slice"


class KeyedTable:
    """One row per key, spread over ``buckets`` folders by a hash of the key or of ``bucket_by``.

    ``order`` names the columns by which the first of several rows with a key is the one that counts.
    A batch is merged with the folders that hold its keys, and those alone are replaced (dynamic
    partition overwrite), so a batch that is applied again, also after it failed half way, changes
    nothing. One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int = 64
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.order, self.bucket_by, self.buckets = list(keys), list(order), list(bucket_by or keys), buckets

    def exists(self) -> bool:
        return exists(self.spark, self.path)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int"))

    def touched(self, df: DataFrame) -> list[int]:
        """The buckets that hold what ``df`` has in the columns of ``bucket_by``; at most ``buckets``."""
        return sorted(r[0] for r in self._bucketed(df.select(self.bucket_by)).select(BUCKET).distinct().collect())

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets: other folders are not read."""
        rows = self.spark.read.parquet(self.path)
        return (rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))).drop(BUCKET)

    def read_for(self, df: DataFrame) -> DataFrame:
        """Rows of the buckets that ``df`` touches."""
        return self.read(self.touched(df))

    def replace(self, rows: DataFrame) -> None:
        """Write whole buckets in the place of what they held; a large bucket is dealt to many tasks by key."""
        slices = -(-shuffle_partitions(self.spark) // self.buckets)
        piece = F.pmod(F.xxhash64(F.lit(SLICE), *self.keys), F.lit(slices)).cast("int")
        spread = self._bucketed(rows).withColumn(SLICE, piece).repartition(BUCKET, SLICE).drop(SLICE)
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path, compression="zstd")

    def upsert(self, batch: DataFrame) -> list[int]:
        """Merge the batch; returns the buckets that were written."""
        touched = self.touched(batch)
        if not touched:
            return []
        merged = batch
        if self.exists():
            merged = self.read(touched).select(batch.columns).unionByName(batch)
        order = [F.col(c).asc_nulls_last() for c in self.order] or [F.lit(0)]
        place = F.row_number().over(Window.partitionBy(*self.keys).orderBy(*order))
        self.replace(merged.withColumn("_place", place).where("_place = 1").drop("_place"))
        return touched


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


class Mark:
    """The highest value of a column that was taken in, kept beside a table."""

    def __init__(self, spark: SparkSession, path: str, column: str):
        self.spark, self.path, self.column = spark, path.rstrip("/"), column

    def new_rows(self, df: DataFrame) -> DataFrame:
        """Rows above the mark; all before the first one."""
        if not exists(self.spark, self.path):
            return df
        last = self.spark.read.parquet(self.path).agg(F.max("mark")).first()[0]
        return df.where(F.col(self.column) > F.lit(last))

    def advance(self, df: DataFrame) -> None:
        """Call it when the rows are stored: a batch in between is taken in once more, which changes nothing."""
        df.agg(F.max(self.column).alias("mark")).where("mark is not null").write.mode("append").parquet(self.path)
