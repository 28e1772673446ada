import random

import pytest
from pyspark.sql import functions as F

from recon360.llm import language
from recon360.llm.common import crc32_mod

from messy_table import messy_rows

SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ein", "ung", "ver"], "cc": ["ción", "que", "ll", "ado"]}


def _text(lang, seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, _text(lang, f"{lang}{i}", 5 + i % 90), lang, "s") for lang in SYLLABLES for i in range(300)]
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_held_out_accuracy(corpus):
    held_out = crc32_mod(F.col("doc_id"), 5) == 0
    dictionaries = language.build_dictionaries(corpus.where(~held_out))
    found = language.predict(corpus.where(held_out), dictionaries).join(corpus, "doc_id")
    n, right = found.count(), found.where("lang = lang_pred").count()
    assert n > 100 and right >= 0.98 * n
    assert found.where("score < 0 or score > 1").count() == 0


def test_dictionaries_do_not_depend_on_partitions_or_copies(corpus):
    plain = language.build_dictionaries(corpus, per_language=50)
    assert language.build_dictionaries(corpus.repartition(7), per_language=50) == plain
    assert list(plain) == sorted(SYLLABLES)  # equally frequent: by name
    assert all(len(d) <= language.DICTIONARY_BYTES for d in plain.values())


def test_narrow_margins_and_ties():
    classifier = language.Classifier({"x": b"same content here", "y": b"same content here"})
    assert classifier.classify("same content") == ("x", 0.5, True)
    assert language.Classifier({}).classify("text") == ("und", 0.0, True)
    for text in (None, "", " \n", "123 $%", "½ 7"):
        assert classifier.classify(text) == ("und", 0.0, True)


def test_long_text_is_read_whole():
    classifier = language.Classifier({lang: _text(lang, "d", 3000).encode() for lang in SYLLABLES})
    start = _text("aa", 1, 50)
    assert classifier.classify(start + " " + _text("bb", 2, 5000))[0] == "bb"


def test_messy_table(spark, messy, nothing, corpus):
    dictionaries = language.build_dictionaries(corpus)
    got = language.predict(messy, dictionaries).collect()
    assert len(got) == len(messy_rows())
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {4, 5, 6, None}
    assert language.predict(nothing, dictionaries).count() == 0
    assert language.build_dictionaries(nothing) == {}
    assert language.predict(messy, {}).where("lang_pred <> 'und'").count() == 0
    assert language.build_dictionaries(messy).keys() == {"en", "de"}


def test_copies_do_not_thin_out_a_language(spark):
    rows = [("aa", _text("aa", f"hot{i // 4000}")) for i in range(4000)] + [("aa", _text("aa", f"aa{i}")) for i in range(30)]
    rows += [("bb", _text("bb", f"bb{i}")) for i in range(300)]
    labelled = spark.createDataFrame(rows, "lang string, text string")
    assert language.language_sizes(labelled) == {"aa": 31, "bb": 300}
    found = language.build_dictionaries(labelled, per_language=20)
    assert list(found) == ["aa", "bb"] and all(len(d) > 1000 for d in found.values())


def test_pieces_come_from_all_over_the_texts_and_from_every_text(spark):
    texts = [" ".join(["kopf"] * 2000 + [f"mitte{chr(97 + i % 26)}"] * 4000) for i in range(26)]
    labelled = spark.createDataFrame([("aa", t) for t in texts], "lang string, text string")
    assert len(set(language.build_dictionaries(labelled)["aa"].split()) - {b"kopf"}) > 13
    parts = [(i * 7919, "abcdefg " * 100) for i in range(600)]
    content = language._content(parts, language.DICTIONARY_BYTES)
    assert len(content) == 600 * (language.DICTIONARY_BYTES // 600)


def test_a_language_without_letters_is_reported(spark):
    labelled = spark.createDataFrame([("aa", "ka to"), ("xx", "12 34")], "lang string, text string")
    with pytest.warns(UserWarning, match="xx"):
        assert list(language.build_dictionaries(labelled)) == ["aa"]
