"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints of 64 bits link when at most two bits differ. A fingerprint is cut into three segments of
at most 23 bits. By the pigeonhole principle two linked fingerprints agree in one segment, and the
segment after it differs in at most two bits. That segment is decoded with the perfect binary Golay
code of length 23: the vector and its 23 neighbours at one bit decode to one codeword, or to six when
the vector is three bits away from a codeword. Two vectors within two bits share a neighbour, hence a
codeword. So (segment, its value, codeword index of the next segment) are at most 18 keys of a
fingerprint, and linked fingerprints share one. Pairs that share a key are verified by their bits.

A key held by many fingerprints is not joined with itself: those fingerprints are linked through the
vectors at one bit from them, where everything that meets lies within two bits, so one link to the
smallest replaces all pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recon360.llm.common import UPPER, pick, text_hash, text_slices
from recon360.operators.entity import smallest_in_component
from recon360.sources.store import TableStore

SHINGLE_WORDS = 3
SEED = 42
MOST_BITS = 2
SEGMENTS = (22, 21, 21)  # widths, from the lowest bits up
# From here on a key's fingerprints are linked through their neighbours instead of by pairs.
MANY = 64
# Bytes of a text that are cut into words at a time.
_SLICE = 1 << 20

_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


# --- fingerprints


def _word_slices(data: bytes) -> Iterator[list[bytes]]:
    start = 0
    while start < len(data):
        found = _SPACE.search(data, start + _SLICE)
        end = found.start() if found else len(data)
        yield data[start:end].split()  # of bytes: at U+0020 and U+0009 to U+000D
        start = end


def shingle_hashes(text: str | None) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of a text, in arrays."""
    last: list[bytes] = []
    any_shingle = False
    for words in _word_slices((text or "").encode().translate(_LOWER)):
        words = last + words
        if len(words) >= SHINGLE_WORDS:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False))
            yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
            any_shingle = True
        last = words[-(SHINGLE_WORDS - 1) :]
    if last and not any_shingle:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(last), SEED)], np.uint64)


def fingerprint(text: str | None) -> int:
    """Unsigned; 0 for a text without words."""
    n, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text):
        for start in range(0, len(hashes), 4096):
            part = hashes[start : start + 4096].astype(">u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        prints = [_signed(fingerprint(t)) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(prints, pa.int64())], ["doc_id", "_hash", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, _hash (of the text) and fp (the fingerprint as a signed long), one row per document."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), text_hash(F.col("text")).alias("_hash"), "text")
    return rows.mapInArrow(_fingerprints, "doc_id long, _hash long, fp long")


# --- Golay code: systematic, 12 index bits above 11 parity bits

_GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(vector: int) -> int:
    for bit in range(22, 10, -1):
        if vector >> bit & 1:
            vector ^= _GENERATOR << (bit - 11)
    return vector


def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Parity of each index, and the error of each syndrome: one pattern of up to three bits."""
    parity = np.array([_remainder(i << 11) for i in range(1 << 12)], np.int64)
    bits = [1 << i for i in range(23)]
    patterns = [0, *bits, *(a | b for a in bits for b in bits if a < b)]
    patterns += [a | b | c for a in bits for b in bits if a < b for c in bits if b < c]
    errors = np.zeros(1 << 11, np.int64)
    for p in patterns:
        errors[_remainder(p)] = p
    return parity, errors


_PARITY, _ERRORS = _golay_tables()


def golay_index(vectors: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword within three bits of each 23-bit vector."""
    syndrome = _PARITY[vectors >> 11] ^ (vectors & 0x7FF)
    return (vectors ^ _ERRORS[syndrome]) >> 11


def golay_indices(vectors: np.ndarray) -> np.ndarray:
    """Per vector a row of the indices that it and its neighbours at one bit decode to, repeats as -1."""
    flips = np.array([0, *(1 << i for i in range(23))], np.int64)
    found = np.sort(golay_index(vectors[:, None] ^ flips[None, :]), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) for every key of signed 64-bit fingerprints."""
    unsigned = prints.astype(np.int64).view(np.uint64)
    parts, low = [], 0
    for width in SEGMENTS:
        parts.append(((unsigned >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64))
        low += width
    places, keys = [], []
    for i, exact in enumerate(parts):
        indices = golay_indices(parts[(i + 1) % len(parts)])
        place, column = np.nonzero(indices >= 0)
        places.append(place)
        keys.append((i << 40) | (exact[place] << 12) | indices[place, column])
    return np.concatenate(places), np.concatenate(keys)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for start in range(0, len(prints), 8192):
            part = prints[start : start + 8192]
            place, key = fuzzy_keys(part)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[place])], ["key", "fp"])


# --- links and classes


def _close(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= MOST_BITS


def links(prints: DataFrame, store: TableStore) -> DataFrame:
    """(upper, lower) links among distinct fingerprints ``fp`` that give the components of all pairs."""
    keys = store("keys", prints.select("fp").mapInArrow(_keys, "key long, fp long"))
    shared = store("shared_keys", keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = store("members", keys.join(shared, "key"))
    few = members.where(F.col("n") <= MANY)
    a, b = few.select("key", F.col("fp").alias("lower")), few.select("key", F.col("fp").alias("upper"))
    pairs = a.join(b, "key").where((F.col("lower") < F.col("upper")) & _close(F.col("lower"), F.col("upper")))
    # Where many meet: each vector at one bit from several of them links those to the smallest.
    crowded = members.where(F.col("n") > MANY).select("fp").distinct()
    near = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(64)])
    around = crowded.select("fp", F.explode(near).alias("_flip")).select("fp", F.col("fp").bitwiseXOR(F.col("_flip")).alias("near"))
    hubs = store(
        "hubs", around.groupBy("near").agg(F.min("fp").alias("lower"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    stars = around.join(hubs, "near").where("fp > lower")
    return pairs.select("upper", "lower").unionByName(stars.select(F.col("fp").alias("upper"), "lower"))


def near_duplicates(docs: DataFrame, store: TableStore) -> DataFrame:
    """doc_id, _hash, fingerprint (16 hex digits), component_id, component_size: one row per document.

    component_id is the smallest doc_id of the documents that links lead to, itself included; documents
    with the same fingerprint are linked, those without words (null, empty, white space) among them. A
    null doc_id takes part but names a component only where no id is known (null then). Repeated rows
    give a row each. An empty table gives no rows.
    """
    return components(docs, store).drop("first")


def components(docs: DataFrame, store: TableStore) -> DataFrame:
    """``near_duplicates`` with ``first``, the struct of the component's smallest doc_id and, of that
    document's texts, the smallest _hash; null ids come last."""
    prints = store("fingerprints", fingerprints(docs))
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_hash")
    nodes = store("nodes", prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.min(named).alias("first")))
    roots = smallest_in_component(links(nodes, store), store)
    roots = store("roots", roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct()))
    rooted = store("rooted", nodes.join(roots, nodes["fp"] == roots["id"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id", "n", "first"))
    whole = store(
        "components",
        rooted.groupBy("root").agg(
            F.min("first_id").alias("component_id"), F.sum("n").alias("component_size"), F.min("first").alias("first")
        ),
    )
    classes = store("classes", rooted.select("fp", "root").join(whole, "root").drop("root"))
    return prints.join(classes, "fp").select(
        "doc_id", "_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size", "first"
    )
