import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from recon360.llm import bpe
from recon360.llm.queries import ENCODE_VOCABULARY, FILES_VOCABULARY, token_digests

from messy_table import messy_rows

RANKS = public_tokenizers.path(ENCODE_VOCABULARY)


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.load_ranks(open(RANKS, "rb").read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(RANKS, open(RANKS, "rb").read())


def odd_texts():
    random.seed(11)
    alphabet = [
        "a", "b", "The", " ", "  ", "\n", "\r\n", "\t", "=", "---", "'", "'s", "'ll", "é", "é", "ß", "的", "1", "23", "½", ".", ",", "!",
        "\x1c", "\x85", "\xa0", " ", "　", "‏", "\U0001f600", "Σ", "ª", "<|endoftext|>",
    ]
    texts = ["".join(random.choices(random.sample(alphabet, random.randint(1, 8)), k=random.randint(0, 50))) for _ in range(4000)]
    return texts + ["", " ", "\n\n", "x" * 5000, " ".join(["word,"] * 3000), "a" * 70 + "." * 70]


def test_ids_are_those_of_the_rank_file(codec, reference):
    for text in odd_texts():
        assert codec.encode(text).tolist() == reference.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("special_names", [False, True])
def test_json_vocabulary_agrees_with_the_library(special_names):
    path = public_tokenizers.path(FILES_VOCABULARY)
    library = Tokenizer.from_file(path)
    assert not library.encode_special_tokens
    library.encode_special_tokens = not special_names
    codec = bpe.Codec(path, open(path, "rb").read(), special_names)
    named = "a <|endoftext|> b<|endoftext|>\n<|endoftext|><|endoftext|>c <|endoftext| >"
    assert (50256 in codec.encode(named).tolist()) == special_names
    lines = ["Aa.\nBb cc,\nDd. Ee", " x\ny\nZ, a.\nb\n", "one.\n two", "a\n1 b", "a.\n\nb", "q\né. É\nz"]
    for text in [*odd_texts(), named, *lines]:
        assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_code_point(codec, reference):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::97]
    for c in map(chr, points):
        text = f"a{c}b {c}1{c}\n{c}{c} .{c}"
        assert codec.encode(text).tolist() == reference.encode_ordinary(text), hex(ord(c))


def test_bytes_come_back(codec):
    assert sorted(bpe.BYTE_CHARACTERS) == sorted(set(bpe.BYTE_CHARACTERS))
    for text in odd_texts():
        assert codec.decode(codec.encode(text).tolist()) == text.encode()
    assert codec.decode([-1, 10**9]) == b""


def test_split_characters(codec):
    text = "x \U0001f9ff的\U00012345 y"
    ids = codec.encode(text)
    assert any((codec.decode([i])[0] & 0xC0) == 0x80 for i in ids.tolist())  # a token begins inside a character
    assert "".join(bpe.decode_characters([codec.decode([i]) for i in ids.tolist()])) == text
    assert "".join(bpe.decode_characters([b"a\xf0\x9f"])) == "a�"


def test_offsets(codec):
    for text in [*odd_texts()[:300], "x \U0001f9ff的\U00012345 y"]:
        ids, data = codec.encode(text), text.encode()
        begin, end = codec.offsets(ids, data)
        at = 0
        for i, b, e in zip(ids.tolist(), begin.tolist(), end.tolist(), strict=True):
            token = codec.token_bytes[i]
            whole = text[b:e].encode()
            before = len(text[:b].encode())
            assert before <= at and at + len(token) <= before + len(whole)  # the characters hold the token
            assert len(text[: b + 1].encode()) > at  # and none before it is named
            at += len(token)


def test_memory_of_pieces_is_bounded(monkeypatch, reference):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    codec = bpe.Codec(RANKS, open(RANKS, "rb").read())
    for i in range(50):
        text = " ".join(f"word{'abcdefghij'[(i * k) % 10]}{'xyz'[k % 3]}," for k in range(9))
        assert codec.encode(text).tolist() == reference.encode_ordinary(text)
        codec.rest()
        assert max(len(codec.spaced), len(codec.spaced.older), len(codec.known), len(codec.known.older)) <= 30
    codec.encode("z" * 100 + " " + "z" * 100)
    assert all(len(k) <= bpe.REMEMBERED_LENGTH for k in (*codec.known, *codec.spaced))


def test_large_vocabulary_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_VOCAB_BYTES", 10)
    with pytest.raises(ValueError):
        bpe.Vocabulary(spark, RANKS)


def test_messy_table(spark, messy, nothing, reference):
    vocabulary = bpe.Vocabulary(spark, RANKS)
    got = token_digests(bpe.round_trip(messy, vocabulary)).collect()
    expected = []
    for row in messy_rows():
        ids = reference.encode_ordinary(row[1] or "")
        expected.append(
            (
                row[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((row[1] or "").encode()).hexdigest(),
            )
        )
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    two_steps = token_digests(bpe.decode(bpe.encode(messy, vocabulary), vocabulary)).collect()
    assert sorted(map(tuple, two_steps), key=str) == sorted(expected, key=str)
    spans = bpe.encode(messy, vocabulary, with_offsets=True).where("doc_id = 7").first()
    text = messy_rows()[7][1]
    assert spans.char_start[0] == 0 and spans.char_end[-1] == len(text)
    assert bpe.round_trip(nothing, vocabulary).count() == 0


def test_ranks_parse():
    line = base64.b64encode(b"ab") + b" 7\n"
    assert bpe.load_ranks(line) == {b"ab": 7}
    assert np.array_equal(bpe._lists([np.array([], "<u4")]).to_pylist(), [[]])
