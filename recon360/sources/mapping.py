"""Target tables from a mapping file: which source columns a target column is made of, and how."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recon360.functions import parsing, text
from recon360.model import COLUMN_TYPES, SEQ
from recon360.sources import files

# What can be done with source columns.
KINDS: dict[str, Callable[..., Column]] = {
    "text": lambda c: c,
    "money": parsing.parse_money,
    "date": parsing.parse_date,
    "integer": parsing.parse_quantity,
    "flag": parsing.decode_active_flag,
    "country": text.normalize_country,
    "state": text.normalize_state,
    "email": text.clean_email,
    "phone": text.clean_phone,
    "name": text.full_name,
}

# The kind of a target column where the file names none.
DEFAULT_KINDS = {
    "full_name": "name", "email": "email", "phone": "phone", "standard_country": "country", "standard_state": "state",
    "shipping_state": "state", "signup_date": "date", "order_date": "date", "payment_date": "date", "created_date": "date",
    "unit_price": "money", "gross_order_amount": "money", "payment_amount": "money", "active_flag": "flag", "quantity": "integer",
}


@dataclass(frozen=True)
class MappedColumn:
    target: str
    sources: tuple[str, ...]
    kind: str

    def column(self) -> Column:
        made = KINDS[self.kind](*[F.col(f"`{c}`") for c in self.sources])
        kind = COLUMN_TYPES.get(self.target)
        return (made.cast(kind) if kind is not None else made).alias(self.target)


def load(spark: SparkSession, path: str) -> dict[str, list[MappedColumn]]:
    """Per target table its columns in file order. A mapping is as long as the tables have columns.

    The file has target_table, target_column, source_column (several separated by commas) and optionally
    a column ``kind``; a kind nobody knows is an error.
    """
    scanned = files.with_columns(files.scan_csv(spark, path), ["source_column", "kind"])
    tables: dict[str, list[MappedColumn]] = {}
    for row in scanned.orderBy(SEQ).collect():
        target = row["target_column"]
        kind = (row["kind"] or "").strip().lower() or DEFAULT_KINDS.get(target, "text")
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r} of {row['target_table']}.{target}")
        sources = tuple(s.strip() for s in (row["source_column"] or "").split(",") if s.strip())
        tables.setdefault(row["target_table"], []).append(MappedColumn(target, sources, kind))
    return tables


def project(df: DataFrame, columns: list[MappedColumn]) -> DataFrame:
    """The target columns of one source; a missing source column is an error that names it."""
    missing = {s for c in columns for s in c.sources} - set(df.columns)
    if missing:
        raise ValueError(f"the source has no columns {sorted(missing)}")
    return df.select(*[c.column() for c in columns])


def direct(mapping: Mapping[str, list[MappedColumn]], table: str) -> list[MappedColumn] | None:
    """The columns of a table, if the mapping names the sources of every one of them."""
    columns = mapping.get(table)
    return columns if columns and all(c.sources for c in columns) else None
