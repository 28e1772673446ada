import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recon360.llm import mixing

from messy_table import messy_rows


def _cdf(rate, k):
    return sum(math.exp(j * math.log(rate) - rate - math.lgamma(j + 1)) for j in range(k + 1))


@pytest.mark.parametrize("rate", [0.01, 0.4, 1.0, 7.5, 60.0, 2000.0])
def test_table_is_the_poisson_distribution(spark, rate):
    low, running = mixing.poisson_cdf(F.col("rate"))
    row = spark.createDataFrame([(rate,)], "rate double").select(low.alias("low"), running.alias("cdf")).first()
    assert row.cdf[-1] == pytest.approx(1.0, abs=1e-9)
    for k in {0, len(row.cdf) // 3, len(row.cdf) // 2}:
        assert row.cdf[k] == pytest.approx(_cdf(rate, row.low + k), rel=1e-9, abs=1e-12)


def test_means_follow_the_weights(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("small").alias("source")
    )
    weights = mixing.fixed_weights(docs, {"big": 1.0, "mid": 1.0, "small": 2.0})
    counts = Counter({r.source: r.n for r in mixing.mix(docs, weights, seed=3).groupBy("source").agg(F.count("*").alias("n")).collect()})
    for source, wanted in (("big", 5000), ("mid", 5000), ("small", 10_000)):
        assert abs(counts[source] - wanted) < 5 * math.sqrt(wanted)


def test_same_seed_same_rows_and_partitions_do_not_matter(spark, messy):
    weights = mixing.tempered_weights(messy, 0.5)
    a = mixing.mix(messy, weights, total=60, seed=1).select("doc_id", "copy_no_", "shuffle_key").collect()
    b = mixing.mix(messy.repartition(7), weights, total=60, seed=1).select("doc_id", "copy_no_", "shuffle_key").collect()
    c = mixing.mix(messy, weights, total=60, seed=2).select("shuffle_key").collect()
    assert sorted(r.shuffle_key for r in a) == sorted(r.shuffle_key for r in b)
    assert {r.shuffle_key for r in a}.isdisjoint(r.shuffle_key for r in c)


def test_messy_table(spark, messy):
    out = mixing.mix(messy, mixing.tempered_weights(messy, 1.0), total=300, seed=5)
    assert out.columns == ["copy_no_" if c == "copy_no" else c for c in messy.columns] + ["copy_no", "shuffle_key"]
    rows = out.collect()
    assert {r.source for r in rows} == {"a", "b", "c", None}
    texts = Counter(r[1] for r in messy_rows())
    assert set(Counter(r.text for r in rows)) == set(texts)
    by_id = Counter(r.doc_id for r in rows if r.doc_id == 3)
    assert by_id[3] % 2 == 0  # the repeated row draws the same count twice


def test_no_weight_and_no_rows(spark, messy, nothing):
    assert mixing.mix(messy, mixing.fixed_weights(messy, {"a": 0.0})).count() == 0
    only = mixing.mix(messy, mixing.fixed_weights(messy, {"a": 1.0}), total=500).select("source").distinct().collect()
    assert [r.source for r in only] == ["a"]
    assert mixing.mix(nothing, mixing.tempered_weights(nothing)).count() == 0


def test_small_rate_table_is_sent_to_the_documents(spark, messy):
    plan = mixing.mix(messy, mixing.tempered_weights(messy), seed=1)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
