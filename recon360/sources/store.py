"""Tables written once and read back."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def constant_rows(spark: SparkSession, rows: Sequence[dict[str, Any]]) -> DataFrame:
    """A few fixed rows as literals of the plan."""
    structs = [F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


class TableStore:
    """Writes a DataFrame as Parquet below ``root`` and returns it as a fresh scan.

    The scan has no lineage behind it, knows its size, prunes columns, and outlives lost executors.
    A name that is written again gets a folder of its own, so frames read from the first stay valid.
    ``codec`` compresses the files by other than the session's codec.
    """

    def __init__(self, spark: SparkSession, root: str, codec: str | None = None):
        self.spark = spark
        self.codec = codec
        self.root = root.rstrip("/")
        self._times: dict[str, int] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def fresh(self, name: str) -> str:
        """The path of a name when first asked for, then others that begin like it."""
        self._times[name] = self._times.get(name, 0) + 1
        return self.path(name if self._times[name] == 1 else f"{name}__{self._times[name]}")

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        path = self.fresh(name)
        df.write.mode("overwrite").parquet(path, compression=self.codec)
        return self.spark.read.schema(df.schema).parquet(path)
