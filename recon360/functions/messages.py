"""Pieces of the issue texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def shown_amount(c: Column) -> Column:
    """50.0000 reads 50.0, 44.2500 reads 44.25, NULL reads None."""
    return F.coalesce(F.regexp_replace(c.cast("string"), r"(\.\d+?)0+$", "$1"), F.lit("None"))


def message(template: str, **values: Column) -> Column:
    """Fill ``{name}`` places; every value must be non-NULL text."""
    pieces, rest = [], template
    while "{" in rest:
        text, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [F.lit(text), values[name]]
    return F.concat(*pieces, F.lit(rest))
