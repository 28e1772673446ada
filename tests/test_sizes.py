"""Partitions grow with the input, and payments take the first row of an id without another shuffle."""

import pytest
from pyspark.sql import functions as F

from recon360 import session
from recon360.model import SEQ
from recon360.operators import dedup
from recon360.sources import bound
from recon360.sources.store import TableStore
from recon360.streaming.upsert import KeyedTable


@pytest.fixture
def conf(spark):
    names = [session.INITIAL_PARTITIONS, *session.DEFAULTS]
    before = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.unset(k)
    yield spark.conf
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_partitions_follow_the_input(spark, conf):
    session.size_for(spark, 100 * session.BYTES_PER_PARTITION)
    small = session.shuffle_partitions(spark)
    session.size_for(spark, 600 * session.BYTES_PER_PARTITION)
    assert (small, session.shuffle_partitions(spark)) == (100, 600)
    session.size_for(spark, 1)
    assert session.shuffle_partitions(spark) == int(conf.get("spark.sql.shuffle.partitions"))


def test_a_session_keeps_its_own_limits(spark, conf):
    name = "spark.sql.autoBroadcastJoinThreshold"
    conf.set(name, "-1")
    session.size_for(spark, 1)
    assert conf.get(name) == "-1" and conf.get("spark.sql.files.maxPartitionBytes") == "32MB"


def test_a_large_bucket_is_written_by_many_tasks(spark, conf, tmp_path):
    conf.set(session.INITIAL_PARTITIONS, "16")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf.set("spark.sql.shuffle.partitions", "16")
    try:
        table = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=1)
        table.upsert(spark.range(2000).select(F.col("id").alias("k"), F.lit("v").alias("v")))
        assert table.read().count() == 2000
        assert table.read().select(F.input_file_name()).distinct().count() > 4
    finally:
        conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        conf.set("spark.sql.shuffle.partitions", "2")


def _orders(spark):
    line = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, l_quantity double, l_extendedprice double"
    day = F.lit("2024-01-01").cast("timestamp")
    rows = [(k, n, p, s, 1.0 * p, 2.0 * s) for k in (1, 2, 3) for n in (1, 2, None) for p in (1, 2) for s in (5, 4)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double")
    lines = lines.withColumn("l_shipdate", F.when(F.col("l_suppkey") == 5, day)).selectExpr(*[c.split()[0] for c in line.split(", ")])
    heads = spark.createDataFrame([(k, 7, "F") for k in (1, 2, 3)], "o_orderkey long, o_custkey long, o_orderstatus string")
    prices = spark.createDataFrame([(1, 10.0), (2, 20.0)], "p_partkey long, p_retailprice double")
    return bound.bind_orders(lines, heads.withColumn("o_orderdate", day), prices)


def test_payments_are_those_of_first_rows(spark, tmp_path):
    orders = TableStore(spark, str(tmp_path), codec="zstd")("orders", _orders(spark))
    first = {r.order_id: r._total for r in dedup.keep_first(orders.select("order_id", SEQ, "_total"), "order_id").collect()}
    got = bound.bind_payments(orders)
    assert {r.order_id: r.amount for r in got.collect()} == {k: str(v) for k, v in first.items()} and None in first
    assert got.count() == len(first) == 7


def test_a_store_compresses_by_its_codec(spark, tmp_path):
    TableStore(spark, str(tmp_path / "z"), codec="zstd")("t", spark.range(3))
    assert list((tmp_path / "z" / "t").glob("*.zstd.parquet"))
