import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recon360.llm import bpe, token_files
from recon360.llm.queries import FILES_VOCABULARY

from messy_table import messy_rows

PATH = public_tokenizers.path(FILES_VOCABULARY)


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 16, 17, 24, 32])
def test_round_trip_and_random_access(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert np.array_equal(token_files.unpack(packed, bits, len(ids)), ids)
    for start, n in ((0, 0), (1, 1), (13, 500), (1000, 1)):
        assert np.array_equal(token_files.unpack(packed, bits, n, start), ids[start : start + n])


def test_whole_bytes_have_the_general_layout():
    ids = np.array([1, 65535, 258], np.uint32)
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    assert token_files.pack(ids, 16) == np.packbits(wide[:, 16:]).tobytes()


def test_bits():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]
    with pytest.raises(ValueError):
        token_files.pack(np.array([8], np.uint32), 3)


def test_messy_table(spark, messy, work):
    vocabulary = bpe.Vocabulary(spark, PATH)
    path = work.path("ids")
    token_files.write(messy.repartition(5), vocabulary, path, end_id=2, block_ids=50)
    got = token_files.read_documents(spark, path).orderBy("start").collect()
    library = Tokenizer.from_file(PATH)
    ids = {i: library.encode(r[1] or "", add_special_tokens=False).ids + [2] for i, r in enumerate(messy_rows())}
    assert [r.doc_id for r in got] == sorted([r[0] for r in messy_rows()], key=lambda i: (i is not None, i or 0))
    start = 0
    crcs = sorted((str(messy_rows()[i][0]), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids.items())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == crcs
    for r in got:
        assert r.start == start
        start += r.n_tokens
    one = next(r for r in got if r.doc_id == 7)
    assert token_files.read_range(spark, path, one.start, one.n_tokens).tolist() == ids[7]
    assert len(token_files.read_range(spark, path, 0, start)) == start
    assert len(token_files.read_range(spark, path, start, 5)) == 0


def test_empty_table(spark, nothing, work):
    path = work.path("none")
    token_files.write(nothing, bpe.Vocabulary(spark, PATH), path, end_id=2)
    assert token_files.read_documents(spark, path).count() == 0


def test_names_of_special_tokens_are_read_as_the_library_reads_them(spark, work):
    texts = [(1, "a <|endoftext|> b"), (2, "plain"), (3, "<|endoftext|>" * 3)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    token_files.write(docs, bpe.Vocabulary(spark, PATH, special_names=True), work.path("ids"), end_id=2)
    library = Tokenizer.from_file(PATH)
    expected = [library.encode(t, add_special_tokens=False).ids + [2] for _, t in texts]
    assert 50256 in expected[0] and expected[2] == [50256] * 3 + [2]
    assert token_files.read_range(spark, work.path("ids"), 0, sum(map(len, expected))).tolist() == sum(expected, [])


def test_words_of_plain_letters_go_straight_to_the_merges(monkeypatch):
    codec = bpe.Codec(FILES_VOCABULARY, open(PATH, "rb").read())
    words = ["the", "Zyxwvut", "a", "enoiment", "x" * 300]
    expected = [codec.tokenizer.encode(" " + w, add_special_tokens=False).ids for w in words]
    monkeypatch.setattr(bpe, "_MARKED_WORD", None)
    monkeypatch.setattr(bpe, "as_characters", None)
    assert [np.frombuffer(codec.after_space(w), "<u4").tolist() for w in words] == expected
    for n in (0, 1, bpe.REMEMBERED_LENGTH - 1, bpe.REMEMBERED_LENGTH, 500):
        assert bpe.little_endian(list(range(n))) == np.arange(n, dtype="<u4").tobytes()
