"""Token ids in fixed-width bit-packed blocks.

Every id takes the minimum number of bits for the vocabulary, most significant bit first, without
padding between ids. A block holds whole documents, closes with the document that brings it to
``block_ids`` ids, and says where each of its documents starts; so a block is unpacked in one numpy
call and a document can be read without the blocks before it.

The files are Parquet tables below one path, so Spark's writer commits them whole on any store:

* ``blocks``: shard, block, first (ids of the shard before the block), n_ids, bits, payload, and docs,
  an array of (doc_id, at, n_tokens), where ``at`` counts ids from the start of the block;
* ``shards``: shard, first (ids of all shards before it), n_ids. Shards follow each other in document
  order, as do the blocks in a shard and the documents in a block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recon360.llm.bpe import Vocabulary
from recon360.llm.common import pick, text_hash, text_slices

BLOCK_IDS = 1 << 16

_DOC = pa.struct([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())])
_BLOCK = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
        ("bits", pa.int32()), ("payload", pa.binary()), ("docs", pa.list_(_DOC)),
    ]
)
BLOCK_SCHEMA = (
    "shard int, block int, first long, n_ids long, bits int, payload binary, "
    "docs array<struct<doc_id: bigint, at: bigint, n_tokens: bigint>>"
)


def bits_for(vocabulary_size: int) -> int:
    """Bits that hold every id below ``vocabulary_size``."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits :]).tobytes()


def unpack(payload: bytes, bits: int, n_ids: int, start: int = 0) -> np.ndarray:
    """``n_ids`` ids from the one at ``start``; reads the bytes that hold them and no others."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f">u{bits // 8}", n_ids, start * bits // 8).astype(np.uint32)
    first, last = start * bits // 8, -(-(start + n_ids) * bits // 8)
    flat = np.unpackbits(np.frombuffer(payload, np.uint8, last - first, first))
    skip = start * bits - first * 8
    wide = np.zeros((n_ids, 32), np.uint8)
    wide[:, 32 - bits :] = flat[skip : skip + n_ids * bits].reshape(n_ids, bits)
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


def _blocks(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, end_id: int, block_ids: int) -> Iterator[pa.RecordBatch]:
    codec = vocabulary.codec()
    bits = bits_for(max(len(codec.token_bytes), end_id + 1))
    shard, block, first = TaskContext.get().partitionId(), 0, 0
    end = np.array([end_id], "<u4")
    held: list[np.ndarray] = []
    docs: list[dict] = []
    n = 0

    def close() -> pa.RecordBatch:
        row = {
            "shard": shard, "block": block, "first": first, "n_ids": n, "bits": bits,
            "payload": pack(np.concatenate(held), bits), "docs": docs,
        }
        return pa.RecordBatch.from_pylist([row], schema=_BLOCK)

    for batch in text_slices(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = codec.encode(text or "")
            held += [ids, end]
            docs.append({"doc_id": doc_id, "at": n, "n_tokens": len(ids) + 1})
            n += len(ids) + 1
            if n >= block_ids:
                yield close()
                block, first, held, docs, n = block + 1, first + n, [], [], 0
        codec.rest()
    if docs:
        yield close()


def write(docs: DataFrame, vocabulary: Vocabulary, path: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Encode the documents in ascending doc_id order, each followed by ``end_id``, into files at ``path``.

    A null text is empty, a null id comes first, rows with the same id follow each other by a hash of
    their text. An empty table gives files without rows. Other columns are ignored.
    """
    texts = pick(docs, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    keyed = texts.withColumn("_hash", text_hash(F.col("text")))
    ordered = keyed.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash").select("doc_id", "text")
    blocks = ordered.mapInArrow(lambda batches: _blocks(batches, vocabulary, end_id, block_ids), BLOCK_SCHEMA)
    blocks.write.mode("errorifexists").parquet(f"{path}/blocks")
    sizes = docs.sparkSession.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    sizes.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"), "n_ids").write.mode(
        "errorifexists"
    ).parquet(f"{path}/shards")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = batch.column(5)
        ends, (doc_id, at, n_tokens) = docs.offsets.to_numpy(), docs.values.flatten()
        at, n_tokens = at.to_numpy(), n_tokens.to_numpy()
        for row in range(batch.num_rows):
            shard, first, n_ids, bits, payload = (c[row].as_py() for c in batch.columns[:5])
            here = slice(int(ends[row]), int(ends[row + 1]))
            data = memoryview(unpack(payload, bits, n_ids).astype("<u4").tobytes())
            begins, sizes = at[here], n_tokens[here]
            sums = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(begins.tolist(), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": doc_id[here.start : here.stop],
                    "shard": pa.array(np.full(len(sums), shard, np.int32)),
                    "at": pa.array(first + begins),
                    "n_tokens": pa.array(sizes),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files."""
    blocks = spark.read.parquet(f"{path}/blocks").select("shard", "first", "n_ids", "bits", "payload", "docs")
    shards = spark.read.parquet(f"{path}/shards").select("shard", F.col("first").alias("shard_first"))
    found = blocks.mapInArrow(_documents, "doc_id long, shard int, at long, n_tokens long, ids_crc32 long")
    return found.join(shards, "shard").select("doc_id", (F.col("shard_first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_range(spark: SparkSession, path: str, start: int, n_ids: int) -> np.ndarray:
    """Ids ``start`` to ``start + n_ids`` of the whole corpus, from the blocks that hold them alone."""
    shards = spark.read.parquet(f"{path}/shards").where(
        (F.col("first") < start + n_ids) & (F.col("first") + F.col("n_ids") > start)
    )
    parts = []
    for shard in shards.orderBy("shard").collect():
        low, high = start - shard["first"], start + n_ids - shard["first"]
        blocks = spark.read.parquet(f"{path}/blocks").where(
            (F.col("shard") == shard["shard"]) & (F.col("first") < high) & (F.col("first") + F.col("n_ids") > low)
        )
        for b in blocks.select("first", "n_ids", "bits", "payload").orderBy("first").toLocalIterator():
            begin, end = max(low - b["first"], 0), min(high - b["first"], b["n_ids"])
            parts.append(unpack(bytes(b["payload"]), b["bits"], end - begin, begin))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)
