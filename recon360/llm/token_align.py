"""Alignment of two tokenizers' ids over a corpus, with a fast path for tokens of the same bytes.

A byte-level BPE vocabulary (A) and a sentencepiece model (B) cut the same bytes. Where a token of either
side ends at the same byte, a group ends; an A and a B token that overlap are a link. Most groups are one
A token and the B token of the same bytes: an array as long as A's vocabulary names that B id, and such
groups are counted in a vector of the same length, one for each task. The links of all other groups are
counted per pair of ids by a shuffle, and only they meet the corpus-wide counts through a shuffle again.

B's pieces never reach over a place before white space that follows something else, so a text is encoded
in segments that begin there, and a task remembers the ids of segments it has met.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recon360.llm.bpe import LETTERS, MOST_VOCAB_BYTES, Codec, Vocabulary
from recon360.llm.common import pick, text_slices
from recon360.sources.store import TableStore

# Ids of a pair are packed into one long: A's id above B's.
_B_BITS = 24
_META_SPACE = "▁"
# Segments begin where a space or a line end follows something else.
SEGMENT = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")
_MARKS = ",.;:!?"
A_WORD = re.compile(f" [{LETTERS}]+\\Z")
_LETTER_MARK = re.compile(f"[{LETTERS}].\\Z")
# Segments a task remembers, and the longest of them.
REMEMBERED = 400_000
REMEMBERED_LENGTH = 64

_ALIGNED = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("same", pa.list_(pa.int32())),
        ("same_n", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64())), ("pairs_n", pa.list_(pa.int64())),
    ]
)
_ALIGNED_SQL = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "same array<int>, same_n array<long>, pairs array<long>, pairs_n array<long>"
)


class Pieces:
    """A sentencepiece model and the bytes of its ids."""

    def __init__(self, data: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.token_bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]
        self.token_lengths = np.array([len(t) for t in self.token_bytes], np.int64)
        # Tokens never reach over the start of a segment if no piece has such a place.
        pieces = [self.model.id_to_piece(i) for i in range(len(self.token_bytes)) if not self.model.is_byte(i)]
        self.separable = not any(re.search(rf"[^{_META_SPACE}]{_META_SPACE}", p) or "\n" in p[1:] for p in pieces)
        self.prefix = self.model.piece_to_id(_META_SPACE)
        # Nor do they reach from a letter to a mark after it, if no piece has both.
        ids = {mark: self.model.piece_to_id(mark) for mark in _MARKS}
        self.marks = {
            mark: i
            for mark, i in ids.items()
            if self.token_bytes[i] == mark.encode() and not any(re.search(f"[{LETTERS}]{re.escape(mark)}", p) for p in pieces)
        }

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(_META_SPACE, " ").encode()

    def segments(self, texts: list[str]) -> list[list[int] | None]:
        """Ids of each segment, None where they do not spell it."""
        # The model puts a space before a text but an empty one. A segment begins with a space, which stands
        # for that one, or with a line end, where the one put before it is a token alone.
        found = self.model.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        return [self._spelled(t, ids) for t, ids in zip(texts, found, strict=True)]

    def _spelled(self, text: str, ids: list[int]) -> list[int] | None:
        if text == " ":
            ids = [self.prefix]
        elif text[0] != " ":
            if ids[:1] != [self.prefix]:
                return None
            ids = ids[1:]
        return ids if b"".join(map(self.token_bytes.__getitem__, ids)) == text.encode() else None


def identity_map(a: list[bytes], b: Pieces) -> np.ndarray:
    """For every A id the B id of the same bytes, -1 if there is none; of several a piece before a byte,
    then the smallest."""
    ids: dict[bytes, int] = {}
    n = len(b.token_bytes)
    for i in sorted(range(n), key=lambda i: (b.model.is_byte(i), i)):
        ids.setdefault(b.token_bytes[i], i)
    return np.array([ids.get(t, -1) for t in a], np.int64)


Ids = tuple[bytes, bytes]  # of A and of B, as little-endian integers of 32 bits


class Aligner:
    """Both tokenizers of a task, and the ids of segments met before."""

    def __init__(self, a: Codec, b: Pieces):
        self.a, self.b = a, b
        # A byte-level vocabulary that has every byte spells every text.
        self.a_spells = a.tokenizer.normalizer is None and {bytes([i]) for i in range(256)} <= set(a.token_bytes)
        self.same = identity_map(a.token_bytes, b)
        self.a_texts = _texts(len(a.token_bytes), ",|")
        self.b_texts = _texts(len(b.token_bytes), ",;")
        self.marks = {m: (a.word(m), _little_endian([i])) for m, i in b.marks.items()}
        self.known: dict[str, Ids | None] = {}
        self.older: dict[str, Ids | None] = {}

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides of each text, None if they do not spell a space and the text."""
        cut = SEGMENT.findall if self.b.separable else lambda text: [text]
        parts = [cut(" " + t) if t else [] for t in texts]
        ids = self._learned(set().union(*parts))
        found = []
        for segments in parts:
            pairs = [ids[s] for s in segments]
            if not pairs or None in pairs:
                found.append(None)
                continue
            a, b = zip(*pairs, strict=True)
            found.append(tuple(np.frombuffer(b"".join(side), "<i4").astype(np.int64) for side in (a, b)))
        return found

    def _learned(self, segments: set[str]) -> dict[str, Ids | None]:
        """Ids of the segments; all new ones go to the model in one call."""
        known, older = self.known, self.older
        words = {s[:-1] if s[-1] in self.marks and _LETTER_MARK.search(s) else s for s in segments if s not in known}
        new = []
        for word in words:
            if word in older:
                known[word] = older[word]
            elif word not in known:
                new.append(word)
        for word, b in zip(new, self.b.segments(new) if new else [], strict=True):
            known[word] = None if b is None else self._both(word, b)
        for s in segments:
            if s not in known:
                word = known[s[:-1]]
                known[s] = word and (word[0] + self.marks[s[-1]][0], word[1] + self.marks[s[-1]][1])
        return known

    def _both(self, text: str, b: list[int]) -> Ids | None:
        a = self.a.word(text) if A_WORD.match(text) else self.a.encode(text).tobytes()
        if not self.a_spells and self.a.decode(np.frombuffer(a, "<u4").tolist()) != text.encode():
            return None
        return a, _little_endian(b)

    def rest(self) -> None:
        """Forget what has not been met for long, and long segments."""
        self.a.rest()
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = {s: ids for s, ids in self.known.items() if len(s) <= REMEMBERED_LENGTH}, {}


def _little_endian(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def _texts(n: int, marks: str) -> list[np.ndarray]:
    """Per mark the decimal ids followed by it."""
    return [np.array([f"{i}{mark}" for i in range(n)], object) for mark in marks]


class Alignment:
    """Groups and links of one document."""

    def __init__(self, with_: Aligner, a: np.ndarray, b: np.ndarray):
        self.a, self.b, self.of = a, b, with_
        a_ends, b_ends = np.cumsum(with_.a.token_lengths[a]), np.cumsum(with_.b.token_lengths[b])
        marks = np.zeros(int(a_ends[-1]) + 1, np.uint8)
        marks[a_ends] = 1
        marks[b_ends] += 2
        # Between two ends next to each other lie one token of A and one of B, and no other such place
        # has the same two: each is a link.
        kinds = marks[np.flatnonzero(marks)].astype(np.int64)
        a_after, b_after = np.cumsum(kinds & 1), np.cumsum(kinds >> 1)
        self.link_a, self.link_b = a[a_after - (kinds & 1)], b[b_after - (kinds >> 1)]
        both = kinds == 3
        # tokens of either side up to the end of each group
        self.a_cuts, self.b_cuts = a_after[both], b_after[both]
        self.a_sizes, self.b_sizes = np.diff(self.a_cuts, prepend=0), np.diff(self.b_cuts, prepend=0)
        regular = both & (with_.same[self.link_a] == self.link_b)
        regular[both] &= (self.a_sizes == 1) & (self.b_sizes == 1)
        self.same = self.link_a[regular]
        self.pairs = (self.link_a[~regular] << _B_BITS) | self.link_b[~regular]

    def text(self) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        out = np.empty(len(self.a) + len(self.b), object)
        a_at = np.arange(len(self.a)) + np.repeat(self.b_cuts - self.b_sizes, self.a_sizes)
        b_at = np.arange(len(self.b)) + np.repeat(self.a_cuts, self.b_sizes)
        out[a_at], out[b_at] = self.of.a_texts[0][self.a], self.of.b_texts[0][self.b]
        a_last, b_last = self.a_cuts - 1, self.b_cuts - 1
        out[a_at[a_last]], out[b_at[b_last]] = self.of.a_texts[1][self.a[a_last]], self.of.b_texts[1][self.b[b_last]]
        return "".join(out.tolist())[:-1]


class Tokenizers:
    """Both files, read by the driver and sent once to each executor."""

    def __init__(self, spark: SparkSession, a_path: str, b_path: str):
        self.a = Vocabulary(spark, a_path)
        data = Path(b_path).read_bytes()
        if len(data) > MOST_VOCAB_BYTES:
            raise ValueError(f"{b_path} has more than {MOST_VOCAB_BYTES} bytes")
        self.b = spark.sparkContext.broadcast(data)

    def aligner(self) -> Aligner:
        """This task's aligner."""
        return _aligner(self.a.codec(), self.b.value)


@lru_cache(maxsize=1)
def _aligner(codec: Codec, pieces: bytes) -> Aligner:
    return Aligner(codec, Pieces(pieces))


# --- over a corpus


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else [], kind))


def _aligned(batches: Iterator[pa.RecordBatch], tokenizers: Tokenizers) -> Iterator[pa.RecordBatch]:
    """A row per document, and last one without ``row``: how often each A id was its own group."""
    aligner = tokenizers.aligner()
    row = TaskContext.get().partitionId() << 40
    none = np.empty(0, np.int64)
    total = np.zeros(len(aligner.same), np.int64)
    for batch in text_slices(batches, 1 << 20):
        facts, same, same_n, pairs, pairs_n = [], [], [], [], []
        for found in aligner.tokens(batch.column(1).to_pylist()):
            if found is None:
                facts.append((0, 0, 0, 0, ""))
                ids = ids_n = codes = codes_n = none
            else:
                of = Alignment(aligner, *found)
                digest = hashlib.sha256(of.text().encode()).hexdigest()
                facts.append((len(of.a), len(of.b), len(of.a_cuts), len(of.link_a), digest))
                ids, ids_n = np.unique(of.same, return_counts=True)
                total[ids] += ids_n
                codes, codes_n = np.unique(of.pairs, return_counts=True)
            for kept, new in ((same, ids), (same_n, ids_n), (pairs, codes), (pairs_n, codes_n)):
                kept.append(new)
        aligner.rest()
        n = batch.num_rows
        columns = [pa.array(c, t.type) for c, t in zip(zip(*facts, strict=True), list(_ALIGNED)[2:7], strict=True)]
        lists = [_lists(same, pa.int32()), *(_lists(x, pa.int64()) for x in (same_n, pairs, pairs_n))]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + n)), batch.column(0), *columns, *lists], schema=_ALIGNED)
        row += n
    seen = np.flatnonzero(total)
    if len(seen):
        yield pa.RecordBatch.from_pylist([{"same": seen.tolist(), "same_n": total[seen].tolist()}], schema=_ALIGNED)


def _pair_counts(aligned: DataFrame, tokenizers: Tokenizers, store: TableStore) -> DataFrame:
    """pair, count (links of the whole corpus that hold it) and best (its B id has no pair with more)."""
    spark = aligned.sparkSession
    same = identity_map(tokenizers.a.codec().token_bytes, Pieces(tokenizers.b.value))
    code = spark.createDataFrame([(i, i << _B_BITS | b) for i, b in enumerate(same.tolist()) if b >= 0], "id int, pair long")
    vectors = aligned.where("row is null").select(F.explode(F.arrays_zip("same", "same_n")).alias("v"))
    regular = vectors.groupBy(F.col("v.same").alias("id")).agg(F.sum("v.same_n").alias("n")).join(F.broadcast(code), "id")
    irregular = aligned.where("row is not null").select(F.explode(F.arrays_zip("pairs", "pairs_n")).alias("v"))
    links = irregular.select(F.col("v.pairs").alias("pair"), F.col("v.pairs_n").alias("n")).unionByName(regular.select("pair", "n"))
    counts = store("counts", links.groupBy("pair").agg(F.sum("n").alias("count")))
    b = F.col("pair").bitwiseAND((1 << _B_BITS) - 1)
    most = store("most", counts.groupBy(b.alias("b")).agg(F.max("count").alias("most")))
    with_most = counts.withColumn("b", b).join(most, "b")
    return store("pair_counts", with_most.select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best")))


def _regular_sums(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    count, best = shared.value
    for batch in batches:
        ids, n = batch.column(1), batch.column(2)
        flat, times = ids.values.to_numpy(zero_copy_only=False), n.values.to_numpy(zero_copy_only=False)
        ends = ids.offsets.to_numpy()
        sums = [np.concatenate(([0], np.cumsum(times * v[flat])))[ends] for v in (best, count)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.diff(s), pa.int64()) for s in sums)], ["row", "n_best", "count_sum"])


def align(docs: DataFrame, tokenizers: Tokenizers, store: TableStore) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose pair of ids no other pair of that B id exceeds over the corpus,
    ``count_sum`` adds up the corpus-wide counts of the links' pairs. A null or empty text, and one whose
    tokens do not spell a space and the text on both sides, has no tokens: zeros and an empty
    ``groups_sha256``. Texts count whole. Repeated rows and null ids give a row each, and repeated texts
    count each time; other columns are ignored, and an empty table gives no rows. What goes through the
    driver is bounded by A's vocabulary.
    """
    spark = docs.sparkSession
    texts = pick(docs, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    aligned = store("aligned", texts.mapInArrow(lambda batches: _aligned(batches, tokenizers), _ALIGNED_SQL))
    counts = _pair_counts(aligned, tokenizers, store)

    same = identity_map(tokenizers.a.codec().token_bytes, Pieces(tokenizers.b.value))
    codes = spark.createDataFrame([(i << _B_BITS | b,) for i, b in enumerate(same.tolist()) if b >= 0], "pair long")
    vectors = np.zeros(len(same), np.int64), np.zeros(len(same), np.int64)
    for r in counts.join(F.broadcast(codes), "pair").collect():  # at most one for each A id
        vectors[0][r["pair"] >> _B_BITS], vectors[1][r["pair"] >> _B_BITS] = r["count"], r["best"]
    shared = spark.sparkContext.broadcast(vectors)
    rows = aligned.where("row is not null")
    sums = "row long, n_best long, count_sum long"
    regular = rows.select("row", "same", "same_n").mapInArrow(lambda batches: _regular_sums(batches, shared), sums)

    links = rows.select("row", F.explode(F.arrays_zip("pairs", "pairs_n")).alias("v"))
    links = links.select("row", F.col("v.pairs").alias("pair"), F.col("v.pairs_n").alias("n")).join(counts, "pair")
    irregular = links.groupBy("row").agg(F.sum(F.col("n") * F.col("best")).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    both = store("sums", regular.unionByName(irregular).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return rows.drop("same", "same_n", "pairs", "pairs_n").join(both, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
