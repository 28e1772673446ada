"""Pieces that several of the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recon360.session import prepare, scratch_root
from recon360.sources.store import TableStore

# The white space that separates words: U+0020 and U+0009 to U+000D.
SPACE = "\\x20\\x09-\\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def workspace(spark: SparkSession, name: str) -> TableStore:
    """A new folder for the tables one call writes, below the folder in ``spark.checkpoint.dir``."""
    prepare(spark)
    return TableStore(spark, f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, found by position: other columns may have any names.

    A name is matched exactly, or else without regard to case.
    """
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_c{_position(df.columns, n)}").alias(n) for n in names])


def leading(df: DataFrame, names: list[str]) -> DataFrame:
    """The first columns of ``df``, as many as there are ``names``, under those names."""
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)])


def _position(columns: list[str], name: str) -> int:
    if name in columns:
        return columns.index(name)
    lower = [c.lower() for c in columns]
    if name.lower() not in lower:
        raise ValueError(f"no column {name} among {columns}")
    return lower.index(name.lower())


class Rows:
    """All columns of a table under safe names, to add columns to and to give back as they were."""

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        self.columns = list(df.columns)
        self.flat = df.toDF(*[f"_c{i}" for i in range(len(self.columns))])
        self.id = self[id_col]
        self.text = self[text_col]

    def __getitem__(self, name: str) -> Column:
        return F.col(f"_c{_position(self.columns, name)}")

    def back(self, df: DataFrame, *extra: Column) -> DataFrame:
        return df.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(self.columns)], *extra)

    def keyed(self) -> DataFrame:
        """With ``_id`` and ``_hash``, which name a row up to equal texts under one id."""
        return self.flat.withColumns({"_id": self.id, "_hash": text_hash(self.text)})


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without_rows(df: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``df`` whose (doc_id, text) is not among ``gone`` (doc_id, _hash); null ids compare equal."""
    rows = Rows(df)
    keyed = rows.keyed()
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("_hash").alias("_gone_hash"))
    same = keyed["_id"].eqNullSafe(gone["_gone_id"]) & (keyed["_hash"] == gone["_gone_hash"])
    return rows.back(keyed.join(gone, same, "left_anti"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; a text of ASCII alone takes the faster way to the same result."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, also where a lambda refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def log_factorial(n: Column) -> Column:
    """ln(n!) for n >= 0: Stirling's series at n + 9, walked back by eight factors."""
    x = n.cast("double") + F.lit(9.0)
    stirling = (
        (x - 0.5) * F.log(x) - x + F.lit(0.9189385332046727)
        + F.lit(1.0) / (12.0 * x) - F.lit(1.0) / (360.0 * x * x * x) + F.lit(1.0) / (1260.0 * x * x * x * x * x)
    )
    product = F.lit(1.0)
    for i in range(1, 9):
        product = product * (n.cast("double") + F.lit(float(i)))
    return stirling - F.log(product)


def seeded_uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts joined by colons; 52 bits, the same in any engine."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def crc32_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def text_slices(batches: Iterable[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller record batches: at most ``most_bytes`` each, or one row.

    Spark fills its Arrow batches by rows, so a batch of long texts could be large; what a task holds
    besides the batch itself stays small this way.
    """
    for batch in batches:
        rows = max(1, min(batch.num_rows, most_bytes * batch.num_rows // max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
