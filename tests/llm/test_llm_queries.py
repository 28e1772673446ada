"""The registered queries over the smallest data set: contract columns, whole tables, SQL where there is any."""

from collections import Counter
from pathlib import Path

import pytest

from recon360.llm.oracle import ORACLE_SQL
from recon360.llm.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data here")

CONTRACT = {
    "op1_byte_bpe": ["doc_id bigint", "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"],
    "op2_language_id": ["doc_id bigint", "held_out boolean", "lang_pred string", "score double"],
    "op3_quality_rules": [
        "doc_id bigint", "n_words bigint", "word_chars bigint", "n_symbols bigint", "n_dup_lines bigint", "n_repeat_words bigint",
        "base_failed boolean", "kept boolean",
    ],
    "op4_simhash": ["doc_id bigint", "fingerprint string", "component_id bigint"],
    "op5_exact_dedup": ["doc_id bigint", "keep_id bigint", "group_size bigint", "kept boolean", "text_sha256 string"],
    "op6_mixing": ["doc_id bigint", "source string", "copy_no bigint"],
    "op7_html_diff": ["page_id bigint", "url string", "text string", "n_chars bigint"],
    "op8_quality_knn": ["doc_id bigint", "held_out boolean", "score double", "predicted int"],
    "op9_token_files": ["doc_id bigint", "start bigint", "n_tokens bigint", "ids_crc32 bigint"],
    "op10_licenses": ["doc_id bigint", "n_licensed bigint", "families string"],
    "op13_token_alignment": [
        "doc_id bigint", "n_a bigint", "n_b bigint", "n_groups bigint", "n_links bigint", "n_best bigint", "count_sum bigint",
        "groups_sha256 string",
    ],
    "op12_lexical_search": ["item_id bigint", "rank int", "doc_id bigint", "score bigint"],
    "op11_minmax_hash": ["doc_id bigint", "n_shingles bigint", "component_id bigint", "kept boolean"],
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "benchmark"):
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    kinds = [" ".join(x) for x in df.dtypes]
    assert set(CONTRACT[name]) <= set(kinds)
    rows = df.collect()
    table = "pages" if name == "op7_html_diff" else "documents"
    if name not in ("op6_mixing", "op12_lexical_search"):
        assert len(rows) == duck.execute(f"select count(*) from {table}").fetchone()[0]
    if name in ORACLE_SQL:
        columns = sorted(df.columns)
        result = duck.execute(ORACLE_SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert Counter(tuple(r[c] for c in columns) for r in rows) == Counter(
            tuple(r[names.index(c)] for c in columns) for r in result.fetchall()
        )


@pytest.mark.parametrize("name", ["op3_quality_rules", "op5_exact_dedup", "op6_mixing", "op10_licenses"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_languages_and_quality_of_held_out_rows(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op2_language_id"](spark, DATA).where("held_out").join(documents, "doc_id")
    assert found.where("lang = lang_pred").count() >= 0.9 * found.count()
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    scored = QUERIES["op8_quality_knn"](spark, DATA).where("held_out").join(labels, "doc_id")
    assert scored.where("quality = predicted").count() >= 0.9 * scored.count()
