"""The operators as queries over the tables of a folder, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recon360.llm import (
    bpe, exact_dedup, html_diff, language, lexical, licenses, minmax, mixing, quality_knn, quality_rules, simhash, token_align,
    token_files,
)
from recon360.llm.common import crc32_mod, pick, workspace

Query = Callable[[SparkSession, str], DataFrame]

ENCODE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
FILES_VOCABULARY = "byte_bpe_50k.json"
FILES_END_ID = 2
ALIGNED_VOCABULARY = "piece_bpe_32k.model"
MIX_SEED = 20
MIX_EXPONENT = 0.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace(spark, "byte_bpe")
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(ENCODE_VOCABULARY))
    return token_digests(bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary))


def token_digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", "ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace(spark, "language_id")
    docs = pick(_table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    held_out = crc32_mod(F.col("doc_id"), 5) == 0
    dictionaries = language.build_dictionaries(docs.where(~held_out).select("lang", "text"))
    return language.predict(docs, dictionaries).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "narrow")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = workspace(spark, "quality_rules")
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_rules.apply_rules(docs, labels, store).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.concat_ws(",", "rejected_by").alias("rejected_by"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), workspace(spark, "simhash")).drop("_hash")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = workspace(spark, "exact_dedup")
    index = exact_dedup.DigestIndex(spark, store.path("index"))
    found = exact_dedup.ingest(_table(spark, sf_dir, "documents"), index, store)
    index.close()
    return found


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = workspace(spark, "mixing")
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.tempered_weights(docs, MIX_EXPONENT), seed=MIX_SEED, store=store)


def op7_html_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.extract(_table(spark, sf_dir, "pages"), workspace(spark, "html_diff"))


def op8_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace(spark, "quality_knn")
    docs, labels = _table(spark, sf_dir, "documents"), pick(_table(spark, sf_dir, "labels"), "doc_id", "quality")
    held_out = crc32_mod(F.col("doc_id"), 3) == 1
    model = quality_knn.train(docs, labels.where(~held_out))
    return quality_knn.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "token_files").path("ids")
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(FILES_VOCABULARY), special_names=True)
    token_files.write(_table(spark, sf_dir, "documents"), vocabulary, path, end_id=FILES_END_ID)
    return token_files.read_documents(spark, path)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = workspace(spark, "licenses")
    docs = _table(spark, sf_dir, "documents")
    seen = licenses.paragraph_vectors(docs, store)
    return licenses.scan(docs, licenses.train(docs, store, seen), store, seen)


def op11_minmax_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(_table(spark, sf_dir, "documents"), workspace(spark, "minmax"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = workspace(spark, "lexical")
    index = lexical.build(_table(spark, sf_dir, "documents"), store.path("index"))
    return lexical.search(index, _table(spark, sf_dir, "benchmark"), store)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = workspace(spark, "token_align")
    paths = [public_tokenizers.path(name) for name in (FILES_VOCABULARY, ALIGNED_VOCABULARY)]
    return token_align.align(_table(spark, sf_dir, "documents"), token_align.Tokenizers(spark, *paths), store)


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_language_id": op2_language_id,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash": op4_simhash,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_mixing": op6_mixing,
    "op7_html_diff": op7_html_diff,
    "op8_quality_knn": op8_quality_knn,
    "op9_token_files": op9_token_files,
    "op10_licenses": op10_licenses,
    "op11_minmax_hash": op11_minmax_hash,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_alignment": op13_token_alignment,
}
