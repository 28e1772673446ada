"""From raw documents to token ids: quality rules, exact and near deduplication, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns a DataFrame that
is written as Parquet and reread as the next stage's ``docs``. All but the last return the columns of
``documents``. In every stage null texts count as empty, other columns are carried along whatever they
hold or are called, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recon360.llm import bpe, exact_dedup, mixing, quality_rules, simhash
from recon360.llm.common import leading, pick, without_rows, workspace
from recon360.llm.queries import ENCODE_VOCABULARY, MIX_EXPONENT, MIX_SEED


def pass_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base conditions nor a risk-controlled rule rejects."""
    store = workspace(spark, "stage_quality_rules")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    verdicts = quality_rules.apply_rules(docs, labels, store)
    return without_rows(docs, store("rejected", verdicts.where("not kept").select("doc_id", "_hash").distinct()))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id; of a repeated row one."""
    store = workspace(spark, "stage_exact_dedup")
    index = exact_dedup.DigestIndex(spark, store.path("index"))
    kept = exact_dedup.keep_documents(docs, index, store)
    index.close()
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints the document with the smallest doc_id, those without an id last; of its texts,
    or of texts without an id, the one with the smallest hash."""
    store = workspace(spark, "stage_simhash")
    classes = simhash.components(docs, store)
    gone = classes.where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_hash") == F.col("first._hash"))))
    return without_rows(docs, store("gone", gone.select("doc_id", "_hash").distinct()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many documents as there are, sources in proportion to the root of their size, shuffled; a
    document comes as often as it was drawn."""
    store = workspace(spark, "stage_mixing")
    weights = mixing.tempered_weights(docs, MIX_EXPONENT)
    mixed = mixing.mix(docs, weights, seed=MIX_SEED, store=store)
    return leading(mixed, docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digests of ids and decoded bytes, one row per document or copy."""
    workspace(spark, "stage_byte_bpe")
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(ENCODE_VOCABULARY))
    decoded = bpe.round_trip(pick(docs, "doc_id", "text"), vocabulary)
    return decoded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", "ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", pass_quality_rules),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_texts),
]

# Encoding is beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below ``spark.checkpoint.dir`` and read again."""
    store = workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(name, stage(spark, docs, sf_dir))
    return docs
