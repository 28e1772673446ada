"""Mixing sources to target weights by Poisson replication.

A document of source s is repeated k times, k drawn from a Poisson distribution whose mean is the
source's target repetition rate. The draw inverts the distribution at a uniform number hashed from the
document's id and a seed, so it needs no state and any rerun gives the same rows. DataFrame operations
only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recon360.llm.common import Rows, let, log_factorial, seeded_uniform
from recon360.sources.store import TableStore, constant_rows


def tempered_weights(docs: DataFrame, exponent: float = 0.5, source_col: str = "source") -> DataFrame:
    """(source, weight): weight is the number of the source's documents to the power ``exponent``."""
    rows = Rows(docs, text_col=source_col)
    sizes = rows.flat.groupBy(rows[source_col].alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.select("source", F.pow(F.col("n").cast("double"), F.lit(float(exponent))).alias("weight"))


def fixed_weights(docs: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(source, weight) from a mapping. Sources it does not name get weight 0."""
    return constant_rows(docs.sparkSession, [{"source": s, "weight": float(w)} for s, w in weights.items()])


def poisson_cdf(rate: Column) -> tuple[Column, Column]:
    """(smallest count listed, cumulative probabilities from there): all but about 1e-30 of the mass."""
    spread = 12.0 * F.sqrt(rate) + 30.0
    low = F.greatest(F.lit(0).cast("long"), F.floor(rate - spread))
    counts = F.sequence(low, F.ceil(rate + spread))
    mass = F.transform(counts, lambda j: F.exp(j * F.log(rate) - rate - log_factorial(j)))
    running = let(
        mass,
        lambda m: F.transform(
            F.sequence(F.lit(1), F.size(m)), lambda i: F.aggregate(F.slice(m, 1, i), F.lit(0.0), lambda total, p: total + p)
        ),
    )
    return low, running


def rates(docs: DataFrame, weights: DataFrame, total: int | None = None, source_col: str = "source") -> DataFrame:
    """Per source: n, target share, rate (copies per document on average) and its Poisson table.

    The sources' weights are shares of ``total`` documents (as many as there are, by default). A null
    source is a source of its own.
    """
    rows = Rows(docs, text_col=source_col)
    sizes = rows.flat.groupBy(rows[source_col].alias("source")).agg(F.count(F.lit(1)).alias("n"))
    weights = weights.select(F.col("source").alias("_source"), "weight")
    joined = sizes.join(weights, sizes["source"].eqNullSafe(weights["_source"]), "left").select(
        "source", "n", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight")
    )
    whole = joined.agg(F.sum("weight").alias("weight"), F.sum("n").alias("n")).first()
    all_weight, wanted = whole["weight"] or 0.0, (whole["n"] or 0) if total is None else total
    share = F.col("weight") / F.lit(all_weight) if all_weight else F.lit(0.0)
    shares = joined.select("source", "n", share.alias("target_share"))
    rated = shares.withColumn("rate", F.col("target_share") * F.lit(float(wanted)) / F.col("n"))
    low, running = poisson_cdf(F.col("rate"))
    return rated.withColumns(
        {"low": F.when(F.col("rate") > 0, low), "cdf": F.when(F.col("rate") > 0, running)}
    )


def mix(
    docs: DataFrame, weights: DataFrame, total: int | None = None, seed: int = 0,
    id_col: str = "doc_id", source_col: str = "source", store: TableStore | None = None,
) -> DataFrame:
    """All columns of ``docs`` plus copy_no (1..k) and shuffle_key, one row per drawn copy.

    With a ``store`` the table of rates is written first: its size is then known, and while it is small
    the documents are not shuffled to meet it.

    Every copy goes to the partition that the hash of its key names and is sorted by the key there, so
    the order of the output has nothing to do with the order or source of the input.

    A source without weight gives no rows; a null id draws like the empty text; rows that share an id
    draw the same count; an empty table gives an empty result. Columns of ``docs`` that are called
    copy_no or shuffle_key are kept under a trailing underscore.
    """
    rows = Rows(docs, id_col, source_col)
    table = rates(docs, weights, total, source_col).select(F.col("source").alias("_source"), "low", "cdf")
    if store:
        table = store("rates", table)
    drawn = rows.flat.withColumn("_u", seeded_uniform(F.lit(seed), rows.id))
    source = rows[source_col]
    counted = drawn.join(table, source.eqNullSafe(F.col("_source"))).withColumn(
        "_k", F.coalesce(F.col("low") + F.size(F.filter("cdf", lambda c: c <= F.col("_u"))), F.lit(0).cast("long"))
    )
    copies = counted.where("_k > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k"))))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}"), F.coalesce(rows.id.cast("string"), F.lit("")), F.col("_copy").cast("string")))
    out = copies.withColumn("_key", key).drop("_u", "_source", "low", "cdf", "_k")
    spread = out.repartition(F.col("_key")).sortWithinPartitions("_key")
    taken = {"copy_no", "shuffle_key"}
    rows.columns = [f"{c}_" if c.lower() in taken else c for c in rows.columns]
    return rows.back(spread, F.col("_copy").alias("copy_no"), F.col("_key").alias("shuffle_key"))
