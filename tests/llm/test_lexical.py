import math
import random
import re
from collections import Counter

import pytest

from recon360.llm import lexical

from messy_table import messy_rows


def brute_terms(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_force(docs, items, k=20):
    """(item_id, rank, doc_id, score) of every row of items, scoring every document."""
    counted = [(d, Counter(brute_terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    rows = []
    for item_id, text in items:
        scored = []
        for d, c, n in counted:
            m = 75 + (25 * n * n_docs) // n_terms
            score = 0
            for t in brute_terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        rows += [(item_id, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(rows, key=str)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def _tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_terms():
    texts = [r[1] for r in messy_rows()] + ["a-b_c d'e 1.2 \u00e9\u0301 \x85\xa0x \x00y", "", None, "A a 9"]
    assert [{t.decode(): n for t, n in lexical.term_counts(t).items()} for t in texts] == [dict(Counter(brute_terms(t))) for t in texts]


def _corpus():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    often = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, often, k=rng.choice([1, 3, 20, 21, 22, 60, 400])))) for i in range(400)]
    docs += [(1000 + i, "w1 w2 Same text") for i in range(60)]  # ties beyond the twentieth
    items = [(i, " ".join(rng.choices(words, often, k=rng.choice([1, 4, 30])))) for i in range(25)]
    return docs, items + [(90, "same TEXT"), (91, "no such thing w1w2"), (92, None), (93, ""), (94, "w1 w1 w2"), (94, "w299 w298")]


@pytest.mark.parametrize(("block_docs", "first"), [(8192, 8), (7, 2), (1, 0)])
def test_results_match_scoring_every_document(spark, work, monkeypatch, block_docs, first):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(lexical, "FIRST_BLOCKS", first)
    docs, items = _corpus()
    d, i = _tables(spark, docs, items)
    index = lexical.build(d.repartition(3), work.path("index"))
    assert got(lexical.search(index, i, work)) == brute_force(docs, items)


def test_bounds_leave_out_blocks_that_cannot_matter(spark, work, monkeypatch):
    monkeypatch.setattr(lexical, "FIRST_BLOCKS", 1)
    docs = [(i, f"rare{i % 2} " + "filler " * (1 + i)) for i in range(80)]
    docs += [(500 + i, "rare0 rare0 rare0") for i in range(30)]
    items = [(1, "rare0")]
    index = lexical.build(_tables(spark, docs, items)[0].coalesce(1), work.path("index"))
    assert got(lexical.search(index, _tables(spark, docs, items)[1], work)) == brute_force(docs, items)
    n_blocks = index.blocks.count()
    assert spark.read.parquet(work.path("rest")).count() < n_blocks - 1


def test_a_row_of_the_index_holds_one_tf_of_one_stratum(spark, work):
    docs, items = _corpus()
    index = lexical.build(_tables(spark, docs, items)[0], work.path("index"))
    rows = index.postings.collect()
    assert len({(r.shard, r.block, r.term, r.tf) for r in rows}) == len(rows)
    ids = {(r.shard, r.block): r.docs for r in index.blocks.collect()}
    found = {(ids[r.shard, r.block][p], r.term, r.tf, r.m) for r in rows for p in r.places}
    n_terms = sum(len(brute_terms(t)) for _, t in docs)
    assert found == {
        (d, t, n, 75 + 25 * len(brute_terms(text)) * len(docs) // n_terms) for d, text in docs for t, n in Counter(brute_terms(text)).items()
    }


def test_messy_and_empty_tables(spark, messy, nothing, work):
    items = spark.createDataFrame([(1, PROSE, 0), (2, None, 0), (None, "von der lonely", 0)], "item_id long, text string, score long")
    index = lexical.build(messy, work.path("index"))
    expected = brute_force([r[:2] for r in messy_rows()], [(1, PROSE), (2, None), (None, "von der lonely")])
    assert got(lexical.search(index, items, work)) == expected
    assert lexical.search(index, items.limit(0), type(work)(spark, work.path("no_items"))).count() == 0
    empty = lexical.build(nothing, work.path("empty"))
    assert lexical.search(empty, items, type(work)(spark, work.path("no_docs"))).count() == 0


PROSE = messy_rows()[0][1]
