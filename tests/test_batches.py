import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recon360.model import SEQ, STAGING_COLUMNS
from recon360.operators import entity
from recon360.plans import conform
from recon360.plans.history import History, last_change, trend
from recon360.streaming.clusters import Clusters
from recon360.streaming.orders import OrderFacts
from recon360.streaming.unique import keep_unique, late_rows, read_unique
from recon360.streaming.upsert import KeyedTable, Mark


def data_files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet")}


# --- tables by key


def test_upserts_keep_the_first_row_of_each_key(spark, tmp_path):
    rng = random.Random(3)
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["at", "v"], buckets=8)
    expected = {}
    for _ in range(4):
        rows = [(f"k{rng.randrange(60)}", rng.randrange(50), f"v{rng.randrange(9)}") for _ in range(40)] + [(None, 1, "null key")]
        for _ in range(2):  # a batch that is applied again changes nothing
            table.upsert(spark.createDataFrame(rows, "k string, at int, v string"))
        for k, at, v in rows:
            expected[k] = min(expected.get(k, (at, v)), (at, v))
        assert {r.k: (r.at, r.v) for r in table.read().collect()} == expected
        assert table.read().count() == len(expected)


def test_a_batch_leaves_the_files_of_other_buckets_alone(spark, tmp_path):
    path = tmp_path / "t"
    table = KeyedTable(spark, str(path), ["k"], buckets=16)
    rows = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v"))
    assert table.upsert(rows) == list(range(16))
    before = data_files(path)
    touched = table.upsert(rows.where("k in ('7', '8')").withColumn("v", F.lit("new")))
    assert 1 <= len(touched) <= 2
    kept = {f for f in before if int(f.split("=")[1].split("/")[0]) not in touched}
    assert kept == before & data_files(path) and len(kept) == 16 - len(touched)
    assert table.upsert(rows.limit(0)) == [] and table.read().count() == 500


def test_a_mark_passes_new_rows_only(spark, tmp_path):
    mark = Mark(spark, str(tmp_path / "mark"), "load")
    df = spark.range(10).withColumn("load", F.col("id") % 3)
    assert mark.new_rows(df).count() == 10
    mark.advance(df.where("load < 2"))
    mark.advance(df.limit(0))
    assert {r.load for r in mark.new_rows(df).collect()} == {2}


# --- the order fact


def _orders(spark, rows):
    """order_id, customer, product, quantity, total, place"""
    full = [
        (o, c, "2024-01-05 10:00:00", p, q, "completed", "IL", total, place) for o, c, p, q, total, place in rows
    ]
    names = ", ".join(f"{c} string" for c in STAGING_COLUMNS["orders"])
    return spark.createDataFrame(full, f"{names}, {SEQ} int")


def test_order_facts_after_batches_equal_the_full_build(spark, tmp_path):
    rng = random.Random(8)
    rows = [
        (f"O{rng.randrange(150)}", f"C{rng.randrange(12)}", f"P{rng.randrange(5)}", str(rng.randrange(-1, 5)), f"{rng.randrange(90)}.5", i)
        for i in range(300)
    ]
    rng.shuffle(rows)
    clusters = spark.createDataFrame([(f"C{i}", f"C{i - i % 2}") for i in range(10)], "customer_id string, customer_key string")
    products = spark.createDataFrame([(f"P{i}", i * 1.5) for i in range(4)], "product_key string, unit_price double")
    facts = OrderFacts(spark, str(tmp_path / "o"), buckets=8)
    for start in range(0, 300, 100):
        facts.add(_orders(spark, rows[start : start + 100]), clusters, products)
    full = conform.fit(conform.fact_order(_orders(spark, rows), clusters, products), conform.curated_schema()["fact_order"])
    as_rows = lambda df: sorted(tuple(r) for r in df.select(full.columns).collect())
    assert as_rows(facts.read()) == as_rows(full)

    before = data_files(tmp_path / "o" / "facts")
    touched = facts.add(_orders(spark, [("O1", "C1", "P1", "2", "3.0", -1)]), clusters, products)
    after = data_files(tmp_path / "o" / "facts")
    assert len(touched) == 1 and len(before - after) == 1 and len(before & after) == len(before) - 1
    assert facts.read().where("order_key = 'O1'").first().quantity == 2


# --- clusters


def _people(spark, people):
    df = spark.createDataFrame(people, "customer_id string, first_name string, phone string, email string")
    return df.select("customer_id", "first_name", F.lit("x").alias("last_name"), "phone", "email")


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_after_every_batch_equal_the_full_build(spark, store, tmp_path, seed):
    rng = random.Random(seed)
    people = [
        (f"C{i:03}", f"n{rng.randrange(2)}", rng.choice(["", f"{rng.randrange(25)}"]), rng.choice(["", f"e{rng.randrange(25)}"]))
        for i in range(60)
    ]
    rng.shuffle(people)
    state = Clusters(spark, str(tmp_path / "c"), buckets=4)
    for end in (20, 21, 45, 60):
        start = {20: 0, 21: 20, 45: 21, 60: 45}[end]
        state.add(_people(spark, people[start:end]), store)
        if end == 45:
            state.add(_people(spark, people[start:end]), store)  # again
        so_far = _people(spark, people[:end])
        crosswalk = entity.id_crosswalk(entity.match_keys(so_far), store)
        full = entity.entity_clusters(so_far.select("customer_id"), crosswalk)
        got = sorted(tuple(r) for r in state.clusters().select("customer_id", "customer_key").collect())
        assert got == sorted(tuple(r) for r in full.collect())
    assert len({key for _, key in got}) < 55


def test_a_batch_may_join_clusters_and_bring_a_smaller_id(spark, store, tmp_path):
    state = Clusters(spark, str(tmp_path / "c"), buckets=4)
    state.add(_people(spark, [("C5", "a", "1", ""), ("C6", "a", "1", ""), ("C8", "a", "2", ""), ("C9", "a", "2", "")]), store)
    assert {tuple(r) for r in state.clusters().collect()} == {("C5", "C5"), ("C6", "C5"), ("C8", "C8"), ("C9", "C8")}
    state.add(_people(spark, [("C7", "a", "1", "m")]), store)
    state.add(_people(spark, [("C1", "a", "2", "m")]), store)
    assert {r.customer_key for r in state.clusters().collect()} == {"C1"} and state.clusters().count() == 6


# --- streams


SCHEMA = "id long, ts timestamp, v string"


def _events(spark, rows):
    return spark.createDataFrame(rows, "id long, at long, v string").select("id", F.timestamp_seconds("at").alias("ts"), "v")


def test_each_event_once_and_late_ones_counted(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("source", "target", "checkpoint"))
    schema = _events(spark, [(1, 1, "")]).schema

    def arrive(n, rows):
        _events(spark, rows).coalesce(1).write.mode("overwrite").parquet(f"{source}/part={n}")
        return keep_unique(spark, schema, f"{source}/part=*", target, checkpoint, "id", "ts", "100 seconds")

    assert arrive(0, [(1, 1000, "a"), (2, 1010, "a"), (1, 1000, "b")]) == 0
    assert arrive(1, [(2, 1010, "c"), (3, 5000, "a")]) == 0  # a copy within the watermark, in another run
    assert arrive(2, [(4, 1020, "late"), (3, 5000, "c"), (5, 4990, "in time")]) == 1
    assert keep_unique(spark, schema, f"{source}/part=*", target, checkpoint, "id", "ts", "100 seconds") == 0  # nothing new
    kept = read_unique(spark, schema, target)
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 5]
    assert [r.v for r in late_rows(spark, schema, f"{source}/part=*", target, "id").collect()] == ["late"]


# --- runs


def test_a_repeated_run_takes_the_place_of_the_first(spark, tmp_path):
    history = History(spark, str(tmp_path / "h"))
    for run, counts in ((1, {"A": 5, "B": 0}), (2, {"A": 9}), (3, {"A": 5, "B": 0, "C": 1}), (2, {"A": 3, "B": 0})):
        history.record(run, spark.createDataFrame(list(counts.items()), "rule_id string, n_exceptions int"))
    rows = {(r.rule_id, r.run): (r.n_exceptions, r.previous, r.change, r.direction) for r in trend(history.read()).collect()}
    assert rows == {
        ("A", 1): (5, None, None, "new"), ("A", 2): (3, 5, -2, "better"), ("A", 3): (5, 3, 2, "worse"),
        ("B", 1): (0, None, None, "new"), ("B", 2): (0, 0, 0, "same"), ("B", 3): (0, 0, 0, "same"), ("C", 3): (1, None, None, "new"),
    }
    assert {(r.rule_id, r.run) for r in last_change(history.read()).collect()} == {("A", 3), ("B", 3), ("C", 3)}
