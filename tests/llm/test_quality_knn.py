import random

import numpy as np
import pytest

from recon360.llm import quality_knn as knn

from messy_table import messy_rows


def _good(i):
    rng = random.Random(i)
    return " ".join("".join(rng.choices(["ka", "to", "mi", "ru", "le"], k=3)) for _ in range(rng.randint(5, 120)))


def _bad(i):
    rng = random.Random(-i)
    return " ".join(w + rng.choice(["%%%", "###"]) for w in _good(i).split()) if i % 2 else " ".join([_good(i).split()[0]] * 40)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, _good(i) if i % 5 else _bad(i // 5), 1 if i % 5 else 0) for i in range(900)]
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


@pytest.fixture(scope="module")
def model(corpus):
    return knn.train(corpus.select("doc_id", "text"), corpus.where("doc_id % 3 <> 1").select("doc_id", "quality"))


def test_held_out_accuracy(corpus, model):
    found = knn.score(corpus.where("doc_id % 3 = 1").select("doc_id", "text"), model).join(corpus, "doc_id")
    assert found.where("quality = predicted").count() >= 0.97 * found.count()
    assert found.where("score < 0 or score > 1").count() == 0


def test_votes_match_brute_force(model):
    vectors = np.stack([model.project(*knn.features(_good(i) if i % 3 else _bad(i))) for i in range(1000, 1060)])
    got = model.scores(vectors)
    for v, score in zip(vectors, got, strict=True):
        v = v / np.linalg.norm(v)
        close = (v[None, :] @ model.vectors.T)[0]
        last = np.sort(close)[-knn.NEIGHBOURS]
        votes = [(max(float(c), 0.0), y) for c, y in zip(close, model.labels, strict=True) if c >= last - 1e-6]
        assert score == pytest.approx(sum(c * y for c, y in votes) / sum(c for c, _ in votes), abs=2e-2)


def test_reduction_keeps_the_neighbourhood(model):
    assert model.axes.shape == (knn.BUCKETS, knn.DIMENSIONS)
    assert np.allclose(np.linalg.norm(model.vectors, axis=1), 1, atol=1e-3)
    basis = model.axes.T @ model.axes
    assert np.allclose(basis, np.eye(len(basis)), atol=1e-2)


def test_references_are_bounded(corpus):
    few = knn.train(corpus.select("doc_id", "text"), corpus.select("doc_id", "quality"), references=40)
    assert len(few.labels) <= 40


def test_partitions_do_not_matter(corpus, model):
    again = knn.train(corpus.repartition(5).select("doc_id", "text"), corpus.where("doc_id % 3 <> 1").select("doc_id", "quality"))
    assert np.array_equal(again.labels, model.labels) and np.allclose(np.abs(again.vectors), np.abs(model.vectors), atol=1e-3)


def test_messy_table(spark, messy, nothing, model, corpus):
    got = knn.score(messy, model).collect()
    assert len(got) == len(messy_rows()) and all(0 <= r.score <= 1 for r in got)
    by_text = {r.doc_id: r.score for r in got}
    assert by_text[4] == by_text[5]  # null counts as empty
    assert knn.score(nothing, model).count() == 0
    labels = spark.createDataFrame([(None, 1), (1, None), (77, 1)], "doc_id long, quality int")
    untrained = knn.train(messy, labels)
    assert {r.score for r in knn.score(messy, untrained).collect()} == {0.5}
    assert len(knn.train(messy, spark.createDataFrame([(3, 1), (3, 0)], "doc_id long, quality int")).labels) == 2


def test_repeats_of_one_document_leave_room_for_the_others(spark):
    rows = [(1, _good(1))] * 200 + [(i, _good(i)) for i in range(2, 12)] + [(11, _bad(3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i != 11)) for i in range(1, 12)], "doc_id long, quality int")
    found = knn.train(docs, labels, references=11)
    assert len(found.labels) == 22 and (found.labels == 0).sum() == 2  # both texts of the largest id


def test_every_character_of_a_long_word_counts():
    same = lambda a, b: all(np.array_equal(x, y) for x, y in zip(knn.features(a), knn.features(b), strict=True))
    for long in ("语言" * 500, "x" * 1000, "a1" * 30):
        assert not same(long + "!?" * 10, long + "终了" * 10) and same(long, long)
    assert knn._words("kurz " + "y" * 40) == ["kurz", "y" * 40]
