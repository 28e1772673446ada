"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A vocabulary is a file: ``.json`` as the tokenizers library reads it, or ``.tiktoken`` ranks. Ranks are
turned into merges: every split of a token into two tokens is a merge with the priority of the token,
so the merges taken are those that taking the lowest rank first takes.

Text is cut into pieces at places where the splitting pattern always cuts, so pieces can be encoded one
by one, which bounds memory for very long texts and lets a task remember the ids of pieces it has seen.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from recon360.llm.common import pick, text_slices

# A vocabulary file is sent to every executor; larger files are refused.
MOST_VOCAB_BYTES = 64 << 20
# Pieces a task remembers; those not met again while it learns half as many new ones are forgotten.
REMEMBERED = 1_000_000

# Longer pieces are not remembered.
REMEMBERED_LENGTH = 64

# The characters with the property White_Space, and the letters of Latin-1.
_SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# A line end before a letter; a word that ends before white space or one of six marks; otherwise all up
# to the next white space. The splitting pattern cuts before white space that follows something else,
# between a single line end and a letter, and between a letter and such a mark, whatever stands around.
PIECES = re.compile(
    rf"\n(?=[{LETTERS}])| ?[{LETTERS}]+(?=[{_SPACES},.;:!?]|\Z)|[{_SPACES}]*[^{_SPACES}]+|[{_SPACES}]+"
)
# Where white space meets a space, pieces do not start at every space.
_SPACES_MEET = re.compile(rf" [{_SPACES}]|[{_SPACES}] ")
_ASCII_SPACES_MEET = tuple(pair for c in " \t\n\x0b\x0c\r" for pair in {" " + c, c + " "})
_WORD = re.compile(rf" ?[{LETTERS}]+\Z")
_LETTER_FIRST = re.compile(rf"[{LETTERS}]")
_MARKED_WORD = re.compile(rf"[{LETTERS}]+([,.;:!?]?)\Z")


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves, the others for U+0100 and up in their order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


BYTE_CHARACTERS = byte_characters()
_TO_CHARACTERS = dict(enumerate(BYTE_CHARACTERS))
_SPACE = BYTE_CHARACTERS[0x20]
_TO_BYTE = {c: b for b, c in enumerate(BYTE_CHARACTERS)}


def as_characters(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARACTERS)


def as_bytes(token: str) -> bytes:
    """The bytes a vocabulary entry stands for; what is not of the byte table is its own UTF-8."""
    if all(c in _TO_BYTE for c in token):
        return bytes(_TO_BYTE[c] for c in token)
    return token.encode()


def load_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def tokenizer_of_ranks(ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN) -> Tokenizer:
    merges = [
        (rank, cut, as_characters(token[:cut]), as_characters(token[cut:]))
        for token, rank in ranks.items()
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    vocab = {as_characters(token): rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=[(a, b) for _, _, a, b in sorted(merges)]))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer


def load_tokenizer(name: str, data: bytes, special_names: bool = False) -> Tokenizer:
    """``special_names``: the name of a special token in a text is that token, and not ordinary text."""
    tokenizer = tokenizer_of_ranks(load_ranks(data)) if name.endswith(".tiktoken") else Tokenizer.from_buffer(data)
    tokenizer.encode_special_tokens = not special_names
    return tokenizer


def spaces_meet(text: str) -> bool:
    if text.isascii():
        return any(pair in text for pair in _ASCII_SPACES_MEET)
    return _SPACES_MEET.search(text) is not None


_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(REMEMBERED_LENGTH)]


def little_endian(ids: list[int]) -> bytes:
    n = len(ids)
    return _PACKERS[n](*ids) if n < REMEMBERED_LENGTH else struct.pack(f"<{n}I", *ids)


class Codec:
    """Encodes and decodes single texts; remembers the ids of pieces."""

    def __init__(self, name: str, data: bytes, special_names: bool = False):
        self.tokenizer = load_tokenizer(name, data, special_names)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.names = tuple(t.content for t in added if t.content and (special_names or not t.special))
        self.model = self.tokenizer.model
        self.known = _Known(self.piece)
        self.spaced = _Known(self.after_space)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.token_bytes = [as_bytes(t) if (t := self.tokenizer.id_to_token(i)) is not None else b"" for i in range(size)]
        self.token_lengths = np.array([len(t) for t in self.token_bytes], np.int64)

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit integers."""
        if self.names and any(name in text for name in self.names):
            # names reach over places where pieces are cut, so such a text goes to the library whole
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        if spaces_meet(text):
            return np.frombuffer(b"".join(map(self.known.__getitem__, PIECES.findall(text))), "<u4")
        first, *rest = text.split(" ")
        start = b"".join(map(self.known.__getitem__, PIECES.findall(first)))
        return np.frombuffer(start + b"".join(map(self.spaced.__getitem__, rest)), "<u4")

    def piece(self, text: str) -> bytes:
        """Ids of one piece."""
        if _WORD.match(text):
            return self.word(text)
        found = _MARKED_WORD.match(text)
        if found:
            return self.known[text[:-1]] + self.known[found[1]]
        return little_endian(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, text: str) -> bytes:
        """Ids of one match of the pattern: straight to the merges."""
        return little_endian([t.id for t in self.model.tokenize(as_characters(text.encode()))])

    def after_space(self, text: str) -> bytes:
        """Ids of a space and what follows it up to the next one."""
        if text.isascii() and text.isalpha():  # these letters stand for themselves
            return little_endian([t.id for t in self.model.tokenize(_SPACE + text)])
        found = _MARKED_WORD.match(text)
        if found:
            mark = found[1]
            return self.spaced[text[:-1]] + self.known[mark] if mark else self.word(" " + text)
        head, *lines = text.split("\n")
        if lines and head and all(map(_LETTER_FIRST.match, lines)):
            return self.spaced[head] + b"".join([self.known["\n"] + self.known[line] for line in lines])
        return b"".join(map(self.known.__getitem__, PIECES.findall(" " + text)))

    def rest(self) -> None:
        """Forget pieces that have not been met for long."""
        self.known, self.spaced = self.known.aged(), self.spaced.aged()

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes the ids stand for; ids outside the vocabulary stand for none."""
        table, size = self.token_bytes, len(self.token_bytes)
        return b"".join([table[i] if 0 <= i < size else b"" for i in ids])

    def offsets(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character and one past the last character that each token's bytes touch.

        A character split over tokens belongs to each of them.
        """
        starts_character = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        characters = np.concatenate(([0], np.cumsum(starts_character)))  # characters begun before a byte
        ends = np.cumsum(self.token_lengths[ids])
        begins = ends - self.token_lengths[ids]
        # inside a character, the one that began before counts
        inside = np.concatenate((~starts_character, [False]))
        return characters[begins] - inside[begins], characters[ends]


class _Known(dict):
    """Ids of pieces, worked out when first asked for."""

    def __init__(self, find: Callable[[str], bytes], older: dict[str, bytes] | None = None):
        self.find, self.older = find, older or {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.find(piece)
        if len(piece) <= REMEMBERED_LENGTH:
            self[piece] = ids
        return ids

    def aged(self) -> _Known:
        """This, or when it is full an empty one that can still look things up here."""
        if len(self) <= REMEMBERED // 2:
            return self
        self.older = {}
        return _Known(self.find, self)


def decode_characters(parts: Iterable[bytes]) -> Iterator[str]:
    """Text of consecutive byte strings; a character split between two of them comes with the second.

    Bytes that are no UTF-8 become U+FFFD.
    """
    import codecs

    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for part in parts:
        yield decoder.decode(part)
    yield decoder.decode(b"", True)


class Vocabulary:
    """A vocabulary file, read by the driver and sent once to each executor."""

    def __init__(self, spark: SparkSession, path: str, special_names: bool = False):
        data = Path(path).read_bytes()
        if len(data) > MOST_VOCAB_BYTES:
            raise ValueError(f"{path} has more than {MOST_VOCAB_BYTES} bytes")
        self.name, self.special_names = Path(path).name, special_names
        self.shared = spark.sparkContext.broadcast(data)

    def codec(self) -> Codec:
        """This task's codec."""
        return _codec(self.name, self.shared.value, self.special_names)


@lru_cache(maxsize=2)
def _codec(name: str, data: bytes, special_names: bool) -> Codec:
    return Codec(name, data, special_names)


ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
OFFSETS = T.StructType(
    [*ENCODED.fields, T.StructField("char_start", T.ArrayType(T.IntegerType(), False)), T.StructField("char_end", T.ArrayType(T.IntegerType(), False))]
)
DECODED = T.StructType([*ENCODED.fields, T.StructField("decoded", T.BinaryType())])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays).astype(np.int32) if arrays else np.empty(0, np.int32)
    item = pa.field("element", pa.int32(), nullable=False)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), type=pa.list_(item))


Batches = Iterator[pa.RecordBatch]


def encode_batches(codec: Callable[[], Codec], batches: Batches, with_offsets: bool = False) -> Batches:
    """(doc_id, text) to (doc_id, ids); with_offsets adds the characters each token touches."""
    codec = codec()
    for batch in text_slices(batches, 1 << 20):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        ids = [codec.encode(t) for t in texts]
        codec.rest()
        columns = {"doc_id": batch.column(0), "ids": _lists(ids)}
        if with_offsets:
            spans = [codec.offsets(i, t.encode()) for i, t in zip(ids, texts, strict=True)]
            columns |= {"char_start": _lists([s for s, _ in spans]), "char_end": _lists([e for _, e in spans])}
        yield pa.RecordBatch.from_pydict(columns)


def decode_batches(codec: Callable[[], Codec], batches: Batches) -> Batches:
    """(doc_id, ids) to the same plus the decoded bytes; null ids are no ids."""
    codec = codec()
    for batch in text_slices(batches, 1 << 20):
        decoded = [codec.decode(i or ()) for i in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch.column(0), "ids": batch.column(1), "decoded": pa.array(decoded, pa.binary())}
        )


def encode(docs: DataFrame, vocabulary: Vocabulary, with_offsets: bool = False) -> DataFrame:
    """doc_id and ids of every text, without special tokens.

    With offsets, also the first and one past the last character (code point) that each token's bytes
    touch; tokens that share a character overlap in it. A null text has no ids. Other columns of
    ``docs`` are ignored; repeated rows and null ids give a row each.
    """
    texts = _typed(docs, "text", "string")
    return texts.mapInArrow(
        lambda batches: encode_batches(vocabulary.codec, batches, with_offsets), OFFSETS if with_offsets else ENCODED
    )


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids and the bytes they stand for.

    Bytes, as the ids may end or begin inside a character; ``decode_characters`` joins such parts to text.
    """
    return _typed(encoded, "ids", "array<int>").mapInArrow(lambda batches: decode_batches(vocabulary.codec, batches), DECODED)


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``decode(encode(docs))`` in one pass over the Arrow batches."""
    return _typed(docs, "text", "string").mapInArrow(
        lambda batches: decode_batches(vocabulary.codec, encode_batches(vocabulary.codec, batches)), DECODED
    )


def _typed(df: DataFrame, column: str, kind: str) -> DataFrame:
    return pick(df, "doc_id", column).selectExpr("cast(doc_id as bigint) doc_id", f"cast({column} as {kind}) {column}")
