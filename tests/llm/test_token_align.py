import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from recon360.llm import token_align
from recon360.llm.bpe import as_bytes

from messy_table import messy_rows

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def plain():
    """Both libraries without anything of ours but the byte table."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute_tokens(text, plain):
    a, b = plain
    if not text:
        return None
    left = [(i, as_bytes(a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text, num_threads=1):
        piece = b.id_to_piece(i)
        right.append((i, bytes.fromhex(piece[3:5]) if b.is_byte(i) else piece.replace("\u2581", " ").encode()))
    spelled = (" " + text).encode()
    return (left, right) if all(b"".join(t for _, t in side) == spelled for side in (left, right)) else None


def spans(tokens):
    at, found = 0, []
    for i, t in tokens:
        found.append((i, at, at + len(t)))
        at += len(t)
    return found


def brute_force(rows, plain):
    """Every row's result, from all pairs of token occurrences."""
    found = [brute_tokens(r[1], plain) for r in rows]
    links, total = [], Counter()
    for f in found:
        pairs = []
        if f:
            a, b = map(spans, f)
            pairs = [(i, j) for i, s, e in a for j, t, u in b if s < u and t < e]
        links.append(pairs)
        total.update(pairs)
    most = {}
    for (_, j), n in total.items():
        most[j] = max(most.get(j, 0), n)
    out = []
    for r, f, pairs in zip(rows, found, links, strict=True):
        digest, n_groups = "", 0
        if f:
            a, b = map(spans, f)
            cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
            n_groups = len(cuts)
            groups = []
            for low, high in zip([0, *cuts], cuts, strict=False):
                groups.append("|".join(",".join(str(i) for i, s, e in side if s >= low and e <= high) for side in (a, b)))
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        sizes = (len(f[0]), len(f[1])) if f else (0, 0)
        best = sum(total[p] == most[p[1]] for p in pairs)
        out.append((r[0], *sizes, n_groups, len(pairs), best, sum(total[p] for p in pairs), digest))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


TEXTS = [
    "The quick brown fox", "the quick  brown\tfox\n\n jumps", "<|endoftext|> and <s> </s> <unk> <0x41>", "\u2581 is not a space", " leading", "trailing ",
    "Stra\u00dfe \u00c4\u00d6\u00dc \u7684\u8bed\u8a00 \U0001f600 e\u0301", "a\x00b", "\ufeffbom", "\ud55c\uad6d\uc5b4 \u0395\u03bb\u03bb\u03b7\u03bd\u03b9\u03ba\u03ac", "12345 67,890.12", "a" * 50, "ab" * 40,
    "\r\n", " ", "\u3000\u00a0x", "\uff21\uff22 \u2460 \ufb01", "http://example.com/a_b-c?d=1&e=%20", "def f(x):\n    return x\n",
]


def test_matches_all_pairs_of_tokens(spark, work, plain):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, TEXTS[0]), (100, TEXTS[0]), (None, "The fox"), (101, None), (102, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = token_align.align(docs, token_align.Tokenizers(spark, A, B), work)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected = brute_force(rows, plain)
    assert got(df) == expected
    assert any(r[7] == "" and r[0] == 3 for r in expected)  # a text that its pieces do not spell


def test_messy_and_empty_tables(spark, messy, nothing, work, plain):
    rows = [(r[0], r[1] if r[1] is None or len(r[1]) < 5000 else None) for r in messy_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokenizers = token_align.Tokenizers(spark, A, B)
    assert got(token_align.align(docs, tokenizers, work)) == brute_force(rows, plain)
    whole = token_align.align(messy, tokenizers, type(work)(spark, work.path("whole"))).where("doc_id = 8").first()
    long = messy_rows()[8][1]
    assert (whole.n_a, whole.n_b) == tuple(map(len, brute_tokens(long, plain)))
    assert token_align.align(nothing, tokenizers, type(work)(spark, work.path("none"))).count() == 0


def test_only_irregular_groups_enter_the_shuffle(spark, work):
    docs = spark.createDataFrame([(1, "the of and to in"), (2, "the of and to in")], "doc_id long, text string")
    rows = token_align.align(docs, token_align.Tokenizers(spark, A, B), work).collect()
    aligned = spark.read.parquet(work.path("aligned"))
    assert aligned.where("size(pairs) > 0").count() == 0
    assert [(r.n_groups, r.n_links, r.n_best, r.count_sum) for r in rows] == [(5, 5, 5, 10)] * 2


def test_segments_give_the_tokens_of_whole_texts(plain, monkeypatch):
    codec = token_align.Codec("byte_bpe_50k.json", open(A, "rb").read())
    aligner = token_align.Aligner(codec, token_align.Pieces(open(B, "rb").read()))
    assert aligner.b.separable and set(aligner.b.marks) == set(",.;:!?") and aligner.a_spells
    rng = random.Random(2)
    alphabet = [" ", "  ", "\n", "\t", "\r\n", "\x85", "\xa0", "\u3000", "\u200b", "\x1c", "\x0b", "the", "The", "ing", "a", "'s", "'", "1", "99", ".", ",", "!", "?", ":", ";", "\u00b2", "\u00df", "\u00e9", "\u7684", "\u2581", "<s>", "_"]
    spelled = 0
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 9))) for _ in range(6000)]
    monkeypatch.setattr(token_align, "REMEMBERED", 200)
    aligned = []
    for start in range(0, 6000, 50):
        aligned += aligner.tokens([*texts[start : start + 50], None, ""])[:50]
        aligner.rest()
        assert len(aligner.known) <= 100
    for text, found in zip(texts, aligned, strict=True):
        expected = brute_tokens(text, plain)
        assert (found is None) == (expected is None), repr(text)
        if found:
            spelled += 1
            assert [x.tolist() for x in found] == [[i for i, _ in side] for side in expected], repr(text)
    assert 2000 < spelled < 6000


def test_identity_map():
    class Model:
        is_byte = staticmethod(lambda i: i == 0)

    class Side:
        model, token_bytes = Model, [b"a", b"x", b"a", b"a"]

    assert token_align.identity_map([b"a", b"b", b"x"], Side).tolist() == [2, -1, 1]
