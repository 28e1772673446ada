"""Result files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recon360.model import EXCEPTION_COLUMNS
from recon360.sources.files import CSV_FORMAT


def sorted_by(df: DataFrame, *columns: str) -> DataFrame:
    """Total order over the whole result, without piling equal rows into one task.

    The map partition breaks ties, so the range partitioning can cut through a key that repeats
    very often.
    """
    return df.withColumn("_tie", F.spark_partition_id()).orderBy(*columns, "_tie").drop("_tie")


def write_csv(df: DataFrame, path: str, null: str = "") -> None:
    (
        df.write.mode("overwrite")
        .options(**CSV_FORMAT, emptyValue="", nullValue=null)
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def export_exceptions(exceptions: DataFrame, path: str) -> None:
    """Part files in global order of rule and record."""
    write_csv(sorted_by(exceptions.select(EXCEPTION_COLUMNS), "rule_id", "record_key"), path)
