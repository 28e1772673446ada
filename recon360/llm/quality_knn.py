"""Quality classification by nearest-neighbour voting over latent-semantic vectors.

Labelled texts become vectors: hashed features, weighted by frequency and rarity, reduced by a truncated
singular value decomposition. These vectors, bounded in number and size, are broadcast; every document
is compared with all of them in blocks, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recon360.llm.common import pick, text_hash, text_slices

BUCKETS = 1 << 13
# Labelled rows the model is fitted on, at most; they are the neighbours that vote.
REFERENCES = 3000
DIMENSIONS = 64
NEIGHBOURS = 15
# Documents compared with all references at a time.
BLOCK = 256
# How much a property of the whole text counts, as if a word came so many times.
PROPERTY_COUNT = 200.0
# Longer words count as consecutive pieces, so texts without spaces are read whole.
LONG_WORD, PIECE = 64, 16

_DIGITS, _LETTERS = re.compile(r"\d+"), re.compile(r"[^\W\d_]+")


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


@lru_cache(maxsize=200_000)
def _word_buckets(word: str) -> tuple[int, int, bool]:
    """Buckets of a word and of its shape, and whether it holds a symbol."""
    shape = _LETTERS.sub("a", _DIGITS.sub("0", word))
    plain = shape.strip(".,;:!?()'\"-")
    return _bucket("w " + word.lower()), _bucket("s " + shape), plain not in ("a", "0", "")


def _words(text: str) -> list[str]:
    """The words of a text, those beyond ``LONG_WORD`` characters in pieces that all count."""
    words = text.split()
    if all(len(w) <= LONG_WORD for w in words):
        return words
    return [
        piece for w in words for piece in ([w] if len(w) <= LONG_WORD else [w[i : i + PIECE] for i in range(0, len(w), PIECE)])
    ]


def _level(share: float) -> int:
    """0 for none, then steps that double: up to 2 %, 4 %, 8 % and so on."""
    return 0 if share <= 0 else 1 + sum(share > s for s in (0.02, 0.04, 0.08, 0.16, 0.32, 0.64))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, weight) of a whole text: its words, their shapes, and four properties of the whole."""
    words = _words(text or "")
    weights: dict[int, float] = {}
    odd = 0
    for word, n in Counter(words).items():
        a, b, symbol = _word_buckets(word)
        weights[a] = weights.get(a, 0.0) + n
        weights[b] = weights.get(b, 0.0) + n
        odd += n * symbol
    size = max(1, len(words))
    again = sum(map(eq, words, words[1:])) / size
    distinct = 1.0 - len(set(words)) / size
    for name in (
        f"length {len(words).bit_length()}", f"odd {_level(odd / size)}", f"again {_level(again)}",
        f"distinct {_level(distinct)}",
    ):
        b = _bucket("p " + name)
        weights[b] = weights.get(b, 0.0) + PROPERTY_COUNT
    index = np.fromiter(weights, np.int32, len(weights))
    order = np.argsort(index)
    return index[order], np.log1p(np.fromiter(weights.values(), np.float32, len(weights)))[order]


@dataclass
class Model:
    idf: np.ndarray  # BUCKETS
    axes: np.ndarray  # BUCKETS x DIMENSIONS
    vectors: np.ndarray  # references x DIMENSIONS, of length one or zero
    labels: np.ndarray  # references

    def project(self, index: np.ndarray, weight: np.ndarray) -> np.ndarray:
        w = weight * self.idf[index]
        w /= max(float(np.linalg.norm(w)), 1e-12)
        return w @ self.axes[index]

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest references, weighted by cosine; all at the last place vote."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(vectors), prior)
        close = _unit(vectors) @ self.vectors.T
        k = min(NEIGHBOURS, close.shape[1])
        last = -np.partition(-close, k - 1, axis=1)[:, k - 1 : k]
        votes = np.where(close >= last, np.maximum(close, 0.0), 0.0).astype(np.float64)
        total = votes.sum(axis=1)
        found = votes @ self.labels / np.where(total > 0, total, 1.0)
        return np.clip(np.where(total > 0, found, prior), 0.0, 1.0)


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 1e-9)


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], dimensions: int = DIMENSIONS, seed: int = 7) -> Model:
    """Model from (bucket, weight, label) of the references: idf, a randomised SVD, reduced vectors."""
    n = len(samples)
    seen = np.zeros(BUCKETS, np.int64)
    for index, _, _ in samples:
        seen[index] += 1
    idf = np.log((1.0 + n) / (1.0 + seen)).astype(np.float32) + 1.0
    matrix = np.zeros((n, BUCKETS), np.float32)
    for row, (index, weight, _) in enumerate(samples):
        w = weight * idf[index]
        matrix[row, index] = w / max(float(np.linalg.norm(w)), 1e-12)
    rank = min(dimensions, n)
    axes = np.zeros((BUCKETS, dimensions), np.float32)
    if n:
        probe = np.random.default_rng(seed).standard_normal((BUCKETS, min(rank + 16, BUCKETS))).astype(np.float32)
        for _ in range(3):
            probe = matrix.T @ np.linalg.qr(matrix @ probe)[0]
        basis = np.linalg.qr(probe)[0]
        _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
        axes[:, :rank] = (basis @ right.T)[:, :rank]
    labels = np.array([label for _, _, label in samples], np.float64)
    return Model(idf, axes, _unit(matrix @ axes), labels)


# --- on Spark


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        found = [features(t) for t in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                batch.column(2),
                pa.array([f[0] for f in found], pa.list_(pa.int32())),
                pa.array([f[1] for f in found], pa.list_(pa.float32())),
            ],
            ["doc_id", "label", "nth", "bucket", "weight"],
        )


def train(docs: DataFrame, labels: DataFrame, references: int = REFERENCES) -> Model:
    """Fit on at most ``references`` rows of ``labels`` (doc_id, quality), chosen by a hash of their id.

    Null ids, null labels and labels without a document are ignored; a document with several labels
    counts by the lowest. A document that comes twice is two references; every document's first row comes
    before a second one, and each of its texts before a repeat, until there are ``2 * references`` rows.
    """
    usable = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = usable.count()
    if not n:
        return fit([])
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    few = usable.where(spread < min(1.0, 2.0 * references / n)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(references)
    most = 2 * references
    rows = pick(docs, "doc_id", "text").join(F.broadcast(few), "doc_id").withColumn("h", text_hash(F.col("text")))
    copy = F.row_number().over(Window.partitionBy("doc_id", "h").orderBy("h"))
    rows = rows.withColumn("copy", copy).where(F.col("copy") <= most)
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("copy", "h"))
    rows = rows.withColumn("nth", nth).where(F.col("nth") <= most).select("doc_id", F.col("quality").cast("int"), "nth", "text")
    made = rows.mapInArrow(_featurise, "doc_id long, label int, nth int, bucket array<int>, weight array<float>")
    found = made.orderBy("nth", "doc_id").limit(most).collect()
    found.sort(key=lambda r: (r["doc_id"], r["bucket"], r["weight"]))
    return fit([(np.array(r["bucket"], np.int32), np.array(r["weight"], np.float32), int(r["label"] == 1)) for r in found])


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        ids, texts = batch.column(0), batch.column(1)
        for start in range(0, batch.num_rows, BLOCK):
            part = texts.slice(start, BLOCK).to_pylist()
            vectors = np.stack([model.project(*features(t)) for t in part])
            yield pa.RecordBatch.from_arrays(
                [ids.slice(start, BLOCK), pa.array(model.scores(vectors), pa.float64())], ["doc_id", "score"]
            )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted of every whole text.

    A null text counts as empty and is scored as such; without labelled rows every score is 0.5. Only
    doc_id and text are read; repeated rows give a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    scored = rows.mapInArrow(lambda batches: _score(batches, shared.value), "doc_id long, score double")
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
