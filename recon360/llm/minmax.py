"""Near-duplicates by min-max hashing.

A document is the set of its distinct word pairs. Each of ``PERMUTATIONS`` random permutations of the
shingles' hashes gives two values of its signature, the smallest and the largest, so half the hashes
are evaluated; both agree for two sets with the probability of their Jaccard similarity. Six values
make a band: half of the bands hold smallest values and half largest ones, and no band holds two
values of one permutation. Sets that agree in a band are candidates, which are confirmed on the full
sets. Two sets at the threshold of 0.8 share none of the 50 bands with a probability of 2.5e-7.

Equal sets are one node, named by a 64-bit hash, so copies are never compared. In a band key all nodes
first meet one of them only. What confirmed links leave apart in a key is then compared by pairs of
different components; keys of more than ``MANY`` nodes are compared in blocks of sets instead, which give
links and no pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recon360.llm.common import UPPER, pick, text_hash, text_slices
from recon360.operators.entity import smallest_in_component
from recon360.sources.store import TableStore

SEED = 42
# Linked from 80 hundredths on.
SIMILAR = 80
ROWS = 6
BANDS = 50
PERMUTATIONS = ROWS * BANDS // 2
# Of 256 bits of the signatures as many must agree for a candidate to be confirmed on its sets. Sets at
# the threshold agree in 230 on average; fewer than this happens with a probability below 1e-9.
AGREEING_BITS = 197
SKETCH = ["s0", "s1", "s2", "s3"]
# A band key of more nodes than these that links leave apart is compared in blocks, not by pairs.
MANY = 16
# About so many nodes and shingles are in a block.
BLOCK_NODES = 256
BLOCK_SHINGLES = 1 << 19
# Bytes of a text that are cut into words at a time, and shingles that are permuted at a time.
_SLICE = 1 << 20
_CHUNK = 2048
_WORDS_REMEMBERED = 500_000

_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- sets and signatures


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, SEED)
        if len(word) <= 64:
            self[word] = value
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_slices(data: bytes) -> Iterator[list[bytes]]:
    start = 0
    while start < len(data):
        found = _SPACE.search(data, start + _SLICE)
        end = found.start() if found else len(data)
        yield data[start:end].split()  # of bytes: at U+0020 and U+0009 to U+000D
        start = end


def shingle_set(text: str | None, words: dict[bytes, int]) -> np.ndarray:
    """Hashes of the distinct word pairs, ascending; a single word is a shingle of its own."""
    last = np.empty(0, np.uint64)
    found: list[np.ndarray] = []
    for part in _word_slices((text or "").encode().translate(_LOWER)):
        hashes = np.concatenate((last, np.fromiter(map(words.__getitem__, part), np.uint64, len(part))))
        if len(hashes) > 1:
            found.append(np.unique(_mixed(_mixed(hashes[:-1]) * _ODD + hashes[1:])))
        last = hashes[-1:]
    if not found:
        return _mixed(last)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odd factors and summands of x -> a x + b modulo 2^32, and factors that make a band's key."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(0, 1 << 31, PERMUTATIONS, np.uint32) * np.uint32(2) + np.uint32(1)
    summands = rng.integers(0, 1 << 32, PERMUTATIONS, np.uint32)
    return factors[:, None], summands[:, None], rng.integers(0, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest value under each permutation."""
    factors, summands, _ = _permutations()
    x = (shingles >> np.uint64(32)).astype(np.uint32)[None, :]
    low, high = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for start in range(0, x.shape[1], _CHUNK):
        values = x[:, start : start + _CHUNK] * factors + summands
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    _, _, mixers = _permutations()
    rows = np.concatenate((low, high)).astype(np.uint64).reshape(BANDS, ROWS)
    return _mixed((_mixed(rows + _ODD) * mixers).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def sketch(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """256 bits, one of each of as many values."""
    values = np.concatenate((low, high))[:256]
    return np.packbits((values * np.uint32(0x9E3779B1)) >> np.uint32(31)).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in text_slices(batches):
        nodes, sizes, keys, bits = [], [], [], []
        for text in batch.column(2).to_pylist():
            shingles = shingle_set(text, words)
            sizes.append(len(shingles))
            if len(shingles):
                low, high = signature(shingles)
                nodes.append(_node(shingles))
                keys.append(band_keys(low, high).view(np.int64))
                bits.append(sketch(low, high).tolist())
            else:
                nodes.append(None)
                keys.append(np.empty(0, np.int64))
                bits.append([None] * 4)
        ends = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else [], pa.int64())),
                *(pa.array(column, pa.int64()) for column in zip(*bits, strict=True)),
            ],
            ["doc_id", "_hash", "node", "n_shingles", "keys", *SKETCH],
        )
        if len(words) > _WORDS_REMEMBERED:
            words.clear()


def _node(shingles: np.ndarray) -> int:
    value = xxhash.xxh64_intdigest(shingles.tobytes(), SEED)
    return value - (1 << 64) if value >> 63 else value


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in text_slices(batches):
        found = [shingle_set(text, words).view(np.int64) for text in batch.column(1).to_pylist()]
        ends = np.concatenate(([0], np.cumsum([len(s) for s in found]))).astype(np.int32)
        values = pa.array(np.concatenate(found) if found else [], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), values)], ["node", "shingles"])
        if len(words) > _WORDS_REMEMBERED:
            words.clear()


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), text_hash(text).alias("_hash"), text.alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, _hash (of the text), node (name of the set, null if it is empty), n_shingles, the keys of
    the bands and the sketch, one row per document."""
    kinds = ", ".join(f"{s} long" for s in SKETCH)
    return _texts(docs).mapInArrow(_signatures, f"doc_id long, _hash long, node long, n_shingles long, keys array<long>, {kinds}")


# --- links


def _alike(size: Column, other_size: Column, shared: Column) -> Column:
    return 100 * shared >= SIMILAR * (size + other_size - shared)


def _promising(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow the similarity."""

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("n_shingles", *SKETCH)])

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    small, large = F.least("a_n_shingles", "b_n_shingles"), F.greatest("a_n_shingles", "b_n_shingles")
    differing = sum((F.bit_count(F.col(f"a_{s}").bitwiseXOR(F.col(f"b_{s}"))) for s in SKETCH), F.lit(0))
    return both.where((100 * small >= SIMILAR * large) & (256 - differing >= AGREEING_BITS)).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar on their full sets."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set")), "b")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    return both.where(_alike(F.size("a_set"), F.size("b_set"), shared)).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("upper"), F.least("a", "b").alias("lower"))


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``nodes`` with the ``root`` of each, itself where it has none."""
    named = roots.select(F.col("id").alias("node"), "root")
    return nodes.join(named, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block of nodes that are apart against one block of all: a link for each two roots that have one."""
    table = pa.Table.from_batches(batches)
    side, node, root = (table.column(c).to_numpy() for c in ("side", "node", "root"))
    lists = table.column("shingles").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    values, codes = np.unique(lists.values.to_numpy(zero_copy_only=False), return_inverse=True)
    owner = np.repeat(np.arange(len(node)), sizes)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    place = np.empty(len(node), np.int64)
    place[left], place[right] = np.arange(len(left)), np.arange(len(right))
    shared = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    for start in range(0, len(values), 4096):
        low, high = np.searchsorted(codes, (start, start + 4096))
        has = [np.zeros((len(x), 4096), np.float32) for x in (left, right)]
        for which, matrix in enumerate(has):
            mine = side[owner[low:high]] == which
            matrix[place[owner[low:high][mine]], codes[low:high][mine] - start] = 1
        shared += has[0] @ has[1].T
    union = sizes[left][:, None] + sizes[right][None, :] - shared
    alike = (100 * shared.astype(np.float64) >= SIMILAR * union) & (root[left][:, None] != root[right][None, :])
    a, b = np.nonzero(alike)
    a, b = left[a], right[b]
    _, first = np.unique(np.stack((root[a], root[b])), axis=1, return_index=True)
    a, b = node[a[first]], node[b[first]]
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _links_in_crowds(crowded: DataFrame, sets: DataFrame, store: TableStore) -> DataFrame:
    """(a, b) links between nodes of different roots that meet in a crowded key.

    ``crowded`` has hub, node and root. Keys of one hub are one crowd, so nodes that share many keys are
    compared once. Of a crowd the nodes outside its largest component are compared with all, in blocks: a
    task holds two blocks of sets, never a crowd, and only links leave it.
    """
    crowds = crowded.select(F.col("hub").alias("crowd"), "node", F.col("root").alias("component")).distinct()
    crowds = store("crowds", crowds.join(sets.select("node", F.size("shingles").alias("n")), "node"))
    parts = store("crowd_parts", crowds.groupBy("crowd", "component").agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("n")))
    whole = parts.groupBy("crowd").agg(
        F.max_by("component", F.struct("nodes", "component")).alias("largest"), F.sum("nodes").alias("nodes"), F.sum("n").alias("n")
    )
    blocks = F.greatest(F.ceil(F.col("nodes") / BLOCK_NODES), F.ceil(F.col("n") / BLOCK_SHINGLES)).cast("int")
    whole = store("crowd_sizes", whole.select("crowd", "largest", blocks.alias("blocks")))
    placed = crowds.join(whole, "crowd").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    names = ("crowd", "node", F.col("component").alias("root"))
    left = placed.where(F.col("component") != F.col("largest")).select(*names, F.lit(0).alias("side"), F.col("own").alias("i"), others.alias("j"))
    right = placed.select(*names, F.lit(1).alias("side"), others.alias("i"), F.col("own").alias("j"))
    dealt = left.unionByName(right).join(sets, "node").drop("n")
    return dealt.groupBy("crowd", "i", "j").applyInArrow(_compare, "a long, b long")


def components(docs: DataFrame, store: TableStore) -> tuple[DataFrame, DataFrame]:
    """The signatures, and (node, root) for every node that is not the smallest of its component."""
    signed = store("signatures", signatures(docs))
    facts = [F.min(c).alias(c) for c in ("n_shingles", *SKETCH)]
    bearer = F.min(F.struct("doc_id", "_hash")).alias("bearer")
    nodes = signed.where("node is not null").groupBy("node").agg(*facts, bearer, F.first("keys").alias("keys"))
    nodes = store("nodes", nodes.select("*", "bearer.*").drop("bearer"))
    keyed = nodes.select(F.explode("keys").alias("key"), "node")
    shared = store("shared", keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = store("members", keyed.join(shared, "key"))

    met = store("met", members.groupBy("node").agg(F.sum("n").alias("company")))
    bearers = nodes.join(met, "node").select("node", F.col("doc_id").alias("_id"), F.col("_hash").alias("_text"))
    texts = _texts(docs)
    same = texts["doc_id"].eqNullSafe(bearers["_id"]) & (texts["_hash"] == bearers["_text"])
    found = texts.join(bearers, same).select("node", "text").mapInArrow(_sets, "node long, shingles array<long>")
    sets = store("sets", found.dropDuplicates(["node"]))

    # All of a key meet the node that has most company: what copies were made from is closer to each of
    # them than they are to each other.
    busy = store("busy", members.join(met, "node"))
    hubs = store("hubs", busy.groupBy("key").agg(F.max(F.struct("company", "node"))["node"].alias("hub")))
    members = store("met_hub", busy.drop("company").join(hubs, "key"))
    stars = members.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = store("star_links", _confirmed(store("stars", _promising(stars, nodes)), sets))
    # What is linked to one hub is one component; of several hubs the busiest names it.
    busiest = links.join(met.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("id"))
    roots = store("star_roots", busiest.agg(F.max(F.struct("company", "a"))["a"].alias("root")))

    # What the links have left apart in a key.
    rooted = store("rooted", _rooted(members.where("n > 2"), roots))
    spread = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    apart = store("apart", spread.where("low < high").select("key"))
    left = store("left", rooted.join(apart, "key"))
    few = left.where(F.col("n") <= MANY)
    a, b = (few.select("key", "hub", F.col("node").alias(x), F.col("root").alias(f"{x}_root")) for x in "ab")
    pairs = a.join(b.drop("hub"), "key").where("a_root < b_root and a != hub and b != hub").select("a", "b").distinct()
    late = _confirmed(store("pairs", _promising(pairs, nodes)), sets)
    crowded = left.where(F.col("n") > MANY).select("hub", "node", "root")
    late = store("late_links", late.unionByName(_links_in_crowds(crowded, sets, store)))
    return signed, store("roots", smallest_in_component(_ordered(links.unionByName(late)), store))


def near_duplicates(docs: DataFrame, store: TableStore) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document.

    Documents are linked whose sets of word pairs have a Jaccard similarity of 0.8 or more; equal sets
    are, and sets without a shingle (null, empty or white space) are linked with nothing, not with each
    other either. component_id is the smallest doc_id that links lead to, itself included. A null doc_id
    takes part but names a component only where no id is known (null then). ``kept`` tells whether the
    row's doc_id is the component_id, nulls being equal; so rows that repeat the smallest id stay all.
    Repeated rows give a row each, texts of any length count whole, other columns are ignored, and an
    empty table gives no rows.
    """
    signed, roots = components(docs, store)
    named = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    rooted = store("named", _rooted(named, roots))
    first = store("first", rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    classes = store("classes", rooted.select("node", "root").join(first, "root").select(F.col("node").alias("_node"), "component_id"))
    found = signed.join(classes, signed["node"] == classes["_node"], "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
