import random

import pytest
from pyspark.sql import functions as F

from recon360.llm import licenses

from messy_table import messy_rows

NOTICES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0.": "CC",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "BSD",
}


def _prose(i):
    rng = random.Random(i)
    return " ".join(rng.choices(["the", "river", "house", "of", "and", "was", "old", "version", "under", "free", "this", "use"], k=25))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, "\n".join(_prose(10 * i + k) for k in range(4)), None) for i in range(150)]
    notices = list(NOTICES)
    rows += [(1000 + i, f"{_prose(-i)}\n{notices[i % 5]}\n{_prose(-i - 500)}", NOTICES[notices[i % 5]]) for i in range(25)]
    return spark.createDataFrame(rows, "doc_id long, text string, families string")


@pytest.fixture(scope="module")
def scanner(spark, corpus, tmp_path_factory):
    from recon360.sources.store import TableStore

    return licenses.train(corpus, TableStore(spark, str(tmp_path_factory.mktemp("train"))))


def test_planted_notices_are_found_and_prose_is_left(corpus, scanner, work):
    got = {r.doc_id: r.families for r in licenses.scan(corpus, scanner, work).collect()}
    assert got == {r.doc_id: r.families or "" for r in corpus.collect()}


def test_the_model_is_sparse_and_calibrated(scanner):
    weights = scanner.model.coefficientMatrix.toArray()
    assert 0 < (weights != 0).sum() < 0.05 * weights.size
    assert 0.5 <= scanner.least <= 0.99


def test_a_prediction_needs_a_text(spark, scanner, work):
    text = "license license apache mit gnu permitted redistribution warranty warranties copyright lesser mozilla"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = licenses.scan(docs, scanner, work).first()
    assert row.n_licensed == 0 and row.families == ""


def test_agreement_is_of_the_shorter_side(spark):
    frame = spark.createDataFrame([(["a b", "b c", "c d", "d e"], ["b c", "x y"])], "p array<string>, t array<string>")
    assert frame.select(licenses.agreement(F.col("p"), F.col("t")).alias("a")).first().a == 0.5


def test_messy_table(spark, messy, nothing, scanner, work):
    got = licenses.scan(messy, scanner, work).collect()
    assert len(got) == len(messy_rows())
    assert {r.n_paragraphs for r in got if r.doc_id in (4, 5, 6)} == {0}
    assert all(r.families == "" for r in got)
    assert licenses.scan(nothing, scanner, type(work)(spark, work.path("none"))).count() == 0
    twice = spark.createDataFrame([(1, "Released under the MIT License.")] * 2 + [(None, "Released under the MIT License.")], "doc_id long, text string")
    rows = licenses.scan(twice, scanner, type(work)(spark, work.path("twice"))).collect()
    assert [(r.n_licensed, r.families) for r in rows] == [(1, "MIT")] * 3


def test_an_empty_corpus_trains_on_the_texts_alone(spark, nothing, work):
    scanner = licenses.train(nothing, work)
    docs = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    assert licenses.scan(docs, scanner, type(work)(spark, work.path("scan"))).first().families == "MIT"


def test_lines_in_any_script_are_paragraphs(spark, scanner, work):
    docs = spark.createDataFrame([(1, "Лицензия и право\n语言\nعربي\n2024\n***\n\nRead on")], "doc_id long, text string")
    assert licenses.scan(docs, scanner, work).first().n_paragraphs == 5


def test_repeated_lines_do_not_shrink_the_sample(spark):
    rows = [(i, f"boilerplate\n{_prose(i)}" if i < 60 else "boilerplate") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert licenses.corpus_paragraphs(docs, most=61).count() == 61


def test_every_paragraph_trains_or_calibrates(spark, work):
    rows = [(i, f"river{i} house\nriver{i} garden\nthe same line") for i in range(3600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert licenses.corpus_paragraphs(docs).count() == 7201
    assert licenses.train(docs, work).least >= 0.5
    counts = {r.fit: r.n for r in spark.read.parquet(work.path("plain")).groupBy("fit").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 7201 and min(counts.values()) > 3000


def test_the_quantile_is_that_of_the_values_between_the_bounds(spark):
    frame = spark.range(1001).select((F.col("id") / 1000).alias("likelihood"))
    assert licenses._quantile(frame, 0.75) == 0.75
    assert (licenses._quantile(frame, 0.1), licenses._quantile(frame, 0.999)) == (0.5, 0.99)
    assert licenses._quantile(frame.where("likelihood > 2"), 0.5) is None


def test_vectors_that_are_there_give_the_same_result(spark, corpus, scanner, work):
    seen = licenses.paragraph_vectors(corpus, work)
    assert {r.fit for r in seen.select("fit").distinct().collect()} == {True, False, None}  # notices do neither
    plain = {r.doc_id: r for r in licenses.scan(corpus, scanner, work).collect()}
    again = {r.doc_id: r for r in licenses.scan(corpus, scanner, type(work)(spark, work.path("seen")), seen).collect()}
    assert plain == again and sum(r.n_licensed for r in again.values()) == 25
    # only lines with a prediction are looked at again
    assert spark.read.parquet(work.path("seen/lines")).count() < 40


def test_agreement_may_be_of_the_pairs_of_any_text_alone(spark):
    frame = spark.createDataFrame([(["a b", "b c", "c d", "d e"], ["b c"], ["b c", "x y"])], "p array<string>, c array<string>, t array<string>")
    assert frame.select(licenses.agreement(F.col("p"), F.col("t"), F.col("c")).alias("a")).first().a == 0.5


def test_pairs_of_words(spark):
    frame = spark.createDataFrame([("",), ("one",), ("One two",), ("a, b  c",)], "t string")
    assert [r.p for r in frame.select(licenses.bigrams(licenses.words(F.col("t"))).alias("p")).collect()] == [[], [], ["one two"], ["a b", "b c"]]
