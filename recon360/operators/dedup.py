"""One row per id.

``row_number() == 1`` directly above the window lets Spark keep one row per id in every map task
before the shuffle, so an id that holds a third of the table still sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recon360.functions.text import completeness
from recon360.model import SEQ


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def _top_row(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, *by: str) -> DataFrame:
    return _top_row(df, list(by), [F.col(SEQ)])


def keep_most_complete(df: DataFrame, by: str) -> DataFrame:
    """The row with most filled columns; the earliest one among equals."""
    scored = df.withColumn("_filled", completeness(business_columns(df)))
    return _top_row(scored, [by], [F.col("_filled").desc(), F.col(SEQ)]).drop("_filled")


def duplicate_ids(df: DataFrame, id_column: str) -> DataFrame:
    return (
        df.groupBy(F.col(id_column).alias("record_key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where("n_rows > 1")
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that break uniqueness, NULL left out."""
    return duplicate_ids(df.where(F.col(key).isNotNull()).select(key), key)
