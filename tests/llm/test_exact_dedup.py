import hashlib
from collections import defaultdict

from recon360.llm import exact_dedup

from messy_table import messy_rows

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _digest(text):
    return hashlib.sha256((text or "").translate(_LOWER).encode()).hexdigest()


def _index(spark, work, name="index"):
    return exact_dedup.DigestIndex(spark, work.path(name), buckets=4)


def test_groups_of_a_messy_table(spark, messy, work):
    got = exact_dedup.ingest(messy, _index(spark, work), work).collect()
    groups = defaultdict(list)
    for row in messy_rows():
        groups[_digest(row[1])].append(row[0])
    assert len(got) == len(messy_rows())
    for row in got:
        ids = groups[row.text_sha256]
        assert row.group_size == len(ids)
        assert row.keep_id == max((i for i in ids if i is not None), default=None)
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(groups)  # one of each, of repeated rows too
    assert all(r.doc_id == r.keep_id for r in kept)


def test_only_ascii_is_lowered(spark, work):
    docs = spark.createDataFrame([(1, "ÄB"), (2, "äb"), (3, "Äb")], "doc_id long, text string")
    got = {r.doc_id: r.keep_id for r in exact_dedup.ingest(docs, _index(spark, work), work).collect()}
    assert got == {1: 3, 2: 2, 3: 3}


def test_a_later_batch_meets_the_index(spark, work):
    index = _index(spark, work)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    exact_dedup.ingest(first, index, work).collect()
    again = _index(spark, work)  # opened anew
    second = spark.createDataFrame([(9, "A"), (8, "c"), (7, "C")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.ingest(second, again, work).collect()}
    assert got == {9: (1, False), 8: (8, True), 7: (8, False)}
    assert again.read().count() == 3


def _batch(spark, start):
    return spark.range(start, start + 300).selectExpr("id as doc_id", "concat('text ', id % 400) as text")


def test_the_index_is_neither_shuffled_nor_sorted(spark, work, monkeypatch):
    monkeypatch.setattr(exact_dedup.DigestIndex, "MOST_APPENDS", 1)
    index = _index(spark, work)
    for i in range(4):  # the second append is merged into the sorted files, the others bring nothing new
        exact_dedup.ingest(_batch(spark, 150 * i), index, work).count()
    assert index.version == 1 and index.read().count() == 400
    plan = index.unseen(spark.read.parquet(work.path("groups")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1  # the batch's own
    exact_dedup.ingest(_batch(spark, 600), index, work).count()
    exact_dedup.ingest(_batch(spark, 750), index, work).count()
    plan = index.unseen(spark.read.parquet(work.path("groups")))._jdf.queryExecution().executedPlan().toString()
    above = [a for a, b in zip(plan.split("\n"), plan.split("\n")[1:], strict=False) if "_sorted_1[" in b]
    assert index.version == 1 and len(above) == 1 and "Filter" in above[0] and plan.count("Sort [") <= 2


def test_an_index_opened_anew_goes_on_after_a_merge(spark, work, monkeypatch):
    monkeypatch.setattr(exact_dedup.DigestIndex, "MOST_APPENDS", 1)
    index = _index(spark, work)
    for i in range(3):
        exact_dedup.ingest(_batch(spark, 150 * i), index, work).count()
    version, names = index.version, set(index.tables.values())
    index.close()
    assert not names & {t.name for t in spark.catalog.listTables()}
    again = _index(spark, work)
    assert version >= 1 and again.version == version and again.read().count() == 400
    assert exact_dedup.ingest(_batch(spark, 5000), again, work).where("kept").count() == 0


def test_kept_documents_carry_all_columns(spark, messy, work):
    kept = exact_dedup.keep_documents(messy, _index(spark, work), work)
    assert kept.columns == messy.columns
    rows = kept.collect()
    assert len(rows) == len({_digest(r[1]) for r in messy_rows()})
    assert {r.doc_id for r in rows} == {3, 6, 5, 7, 8, 9, 10}


def test_empty_table(spark, nothing, work):
    assert exact_dedup.ingest(nothing, _index(spark, work), work).count() == 0
    assert exact_dedup.keep_documents(nothing, _index(spark, work), work).count() == 0
