"""Every registered query against its SQL on the smallest data set, and the shape of its plan."""

import re
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as driver
from recon360.model import DEFAULT_RULES, EXCEPTION_COLUMNS
from recon360.plans import rules
from recon360.plans.queries import QUERIES as PLAIN
from recon360.plans.queries import open_run
from recon360.session import drop_scratch

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
TABLES = ["customer", "part", "orders", "lineitem", "events"]
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data here")

BASE = [name for name in driver.queries() if name in PLAIN]
QUERIES = {name: driver.queries()[name] for name in BASE}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name in PLAIN}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = Counter(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
    assert got == want and got
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and ("Arrow" not in plan or name == "scan_csv_lines")


def test_rules_scan_each_table_once(spark):
    run = open_run(spark, DATA)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = rules.exceptions(run, DEFAULT_RULES)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for table in ("fact_order", "dim_customer", "dim_product", "order_payments", "trace_orders", "trace_tickets"):
        assert len(re.findall(rf"/{table}\]", plan)) == 1, table


def test_a_rule_alone_is_its_share_of_all(spark):
    run = open_run(spark, DATA)
    whole = Counter(map(tuple, run.exceptions.select(EXCEPTION_COLUMNS).collect()))
    parts = Counter(tuple(r) for rule in DEFAULT_RULES for r in rules.run_rule(run, rule).collect())
    assert whole == parts and whole


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and df.columns[0] == "order_key"


WRITERS = [
    "scan_csv_text", "scan_jsonl_text", "duplicate_pairs", "dq_exceptions_export", "bq2_top_customers", "bq3_problem_orders",
    "bq5_tickets_vs_exceptions",
]


def test_a_second_call_leaves_the_first_frame_alone(spark):
    """Queries that write tables on the way, built twice and once more after the tables were dropped."""
    frames = {name: [QUERIES[name](spark, DATA), QUERIES[name](spark, DATA)] for name in WRITERS}
    counts = {name: {f.count() for f in pair} for name, pair in frames.items()}
    assert all(len(found) == 1 for found in counts.values())
    drop_scratch(spark)
    for name in WRITERS:
        assert {QUERIES[name](spark, DATA).count()} == counts[name]
