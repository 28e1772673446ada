"""The pipeline against a brute-force version of its stages."""

import hashlib
import math
import uuid

import public_tokenizers
import tiktoken

import corpus_pipeline
from recon360.llm import bpe
from recon360.llm.queries import ENCODE_VOCABULARY, MIX_EXPONENT, MIX_SEED

from messy_table import SCHEMA, messy_rows
from test_quality_rules import counts
from test_simhash import brute_components

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _folder(spark, tmp_path, docs, labels):
    path = str(tmp_path / uuid.uuid4().hex)
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def _prose(i, n=30):
    return " ".join(f"w{(i * 31 + k * 7) % 997}" for k in range(n))


def _uniform(doc_id):
    return int(hashlib.md5(f"{MIX_SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52


def brute(rows):
    """Ids of the output with their text, in any order; no cutoff is in force with few labels."""
    rows = [r for r in rows if not counts(r[1])[-1]]
    last = {}
    for r in rows:
        key = (r[1] or "").translate(_LOWER)
        if key not in last or (r[0] is not None and (last[key][0] is None or r[0] > last[key][0])):
            last[key] = r
    rows = list(last.values())
    rows = [r for r, (i, _, c) in zip(rows, brute_components(rows), strict=True) if i == c]
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + 1
    whole = sum(n**MIX_EXPONENT for n in sizes.values())
    out = []
    for r in rows:
        rate = sizes[r[3]] ** MIX_EXPONENT / whole * len(rows) / sizes[r[3]]
        total, k = math.exp(-rate), 0
        while total <= _uniform(r[0]):
            k += 1
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        out += [r] * k
    return out


def test_all_stages(spark, tmp_path):
    rows = messy_rows()
    rows += [(100 + i, _prose(i % 40), "en", f"s{i % 3}" if i % 4 else "hot", 1, *rows[0][5:]) for i in range(120)]
    rows += [(300, _prose(1).upper(), "en", "hot", 1, *rows[0][5:]), (301, "%%% " * 40, "en", "hot", 1, *rows[0][5:])]
    docs = spark.createDataFrame(rows, SCHEMA)
    folder = _folder(spark, tmp_path, docs, spark.createDataFrame([(1, 1), (None, None)], "doc_id long, quality int"))
    got = corpus_pipeline.run(spark, folder).collect()
    ranks = bpe.load_ranks(open(public_tokenizers.path(ENCODE_VOCABULARY), "rb").read())
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = [(r[0], encoding.encode_ordinary(r[1] or "")) for r in brute(rows)]
    assert len(expected) > 20
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == sorted((str(i), ids) for i, ids in expected)
    for r in got:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()


def test_stages_keep_the_columns_and_bear_odd_tables(spark, tmp_path, messy, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for docs in (messy, nothing):
        folder = _folder(spark, tmp_path, docs, labels)
        current = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            current = stage(spark, current, folder)
            assert current.dtypes == messy.dtypes
        last = corpus_pipeline.STAGES[-1][1](spark, current, folder)
        assert last.columns[0] == "doc_id" and last.count() == current.count()


def test_each_stage_calls_one_operator_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_near_dedup", "mixing", "byte_bpe"]


def test_one_document_stays_of_near_copies(spark):
    near = [_prose(1, 200) + end for end in ("", " ", "\n")]  # other texts with the same words
    rows = [(7, near[0]), (7, near[1]), (8, near[2]), (7, _prose(500, 200)), (None, "a b c d"), (None, "a b c d ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text.strip()) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(7, near[0]), (7, _prose(500, 200)), (None, "a b c d")], key=str)
