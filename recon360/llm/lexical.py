"""Ranked lexical search over an index stratified by document length.

A document's length enters its score only through the normaliser m. The index groups documents of equal
m into a stratum, and within a stratum a term's postings by tf; so what a term adds to a score, its
impact, is worked out once for each (stratum, term, tf) and holds for the whole list of documents.

A stratum is stored in blocks of bounded size, so a stratum of any size is read by many tasks. The
largest impacts of an item's terms in a block add up to a bound on the scores in it. Blocks are visited
in the order of their bounds: first those with the highest ones, which gives each item a score that its
last result has at least, then every block whose bound reaches that score. No document is left out that
could be among the results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recon360.llm.common import UPPER, pick, text_slices
from recon360.sources.store import TableStore

RESULTS = 20
# A block is closed when it holds so many documents or postings.
BLOCK_DOCS = 1 << 13
BLOCK_POSTINGS = 1 << 20
# Blocks that every item visits first.
FIRST_BLOCKS = 8

# The bytes between terms, and what the normaliser and the impact are made of.
_BETWEEN = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_SPREAD = 25
_SCALE = 1_000_000_000

_TERMS = bytearray(range(256))
_TERMS[ord("A") : ord("Z") + 1] = UPPER.lower().encode()
for _b in _BETWEEN:
    _TERMS[_b] = 0x20
_TERMS = bytes(_TERMS)

_POSTINGS = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("m", pa.int64()), ("term", pa.string()), ("tf", pa.int64()),
        ("places", pa.list_(pa.int32())), ("docs", pa.list_(pa.int64())),
    ]
)
_POSTINGS_SQL = "shard int, block int, m long, term string, tf long, places array<int>, docs array<long>"


def term_counts(text: str | None) -> Counter[bytes]:
    """How often a text has each term, in UTF-8 and in the order of their first occurrence."""
    return Counter((text or "").encode().translate(_TERMS).split())


def normaliser(n: str, n_docs: int, n_terms: int) -> Column:
    """m of a document of ``n`` terms, in integers."""
    return F.expr(f"{100 - _SPREAD}L + ({_SPREAD}L * {n} * {n_docs}L) div {max(n_terms, 1)}L")


def impact(weight: str) -> Column:
    """What one occurrence of a term in an item adds to the score."""
    return F.expr(f"{weight} * (({_SCALE}L * tf) div (1000L * tf + 12L * m))")


# --- the index


class _Block:
    """Documents of one stratum on their way into the index."""

    def __init__(self, m: int):
        self.m = m
        self.docs: list[int | None] = []
        self.ids: dict[bytes, int] = {}
        self.term: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, counts: Counter[bytes]) -> None:
        ids = self.ids
        n = len(counts)
        self.term.append(np.fromiter((ids.setdefault(t, len(ids)) for t in counts), np.int64, n))
        self.tf.append(np.fromiter(counts.values(), np.int64, n))
        self.docs.append(doc_id)
        self.size += n

    def full(self) -> bool:
        return len(self.docs) >= BLOCK_DOCS or self.size >= BLOCK_POSTINGS

    def rows(self, shard: int, block: int) -> Iterator[pa.RecordBatch]:
        """A row for the documents, and one for each term and tf with the places of its documents."""
        term, tf = np.concatenate(self.term), np.concatenate(self.tf)
        place = np.repeat(np.arange(len(self.docs), dtype=np.int32), [len(t) for t in self.term])
        order = np.lexsort((place, tf, term))
        term, tf, place = term[order], tf[order], place[order]
        starts = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1]))))
        names = pa.array([t.decode() for t in self.ids], pa.string())
        n = len(starts)
        nothing = pa.nulls(n, pa.list_(pa.int64()))
        ends = np.append(starts, len(term)).astype(np.int32)
        same = [pa.array(np.full(n, v), t) for v, t in ((shard, pa.int32()), (block, pa.int32()), (self.m, pa.int64()))]
        places = pa.ListArray.from_arrays(pa.array(ends), pa.array(place))
        yield pa.RecordBatch.from_arrays([*same, names.take(pa.array(term[starts])), pa.array(tf[starts]), places, nothing], schema=_POSTINGS)
        yield pa.RecordBatch.from_pylist([{"shard": shard, "block": block, "m": self.m, "docs": self.docs}], schema=_POSTINGS)


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of the task have each number of terms."""
    found: Counter[int] = Counter()
    for batch in text_slices(batches):
        found.update(len((t or "").encode().translate(_TERMS).split()) for t in batch.column(0).to_pylist())
    yield pa.RecordBatch.from_pydict({"n": pa.array(found.keys(), pa.int64()), "docs": pa.array(found.values(), pa.int64())})


def _with_length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        n = [len((t or "").encode().translate(_TERMS).split()) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], ["doc_id", "text", "n"])


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (m, slot, doc_id, text) in this order to index rows."""
    shard, number = TaskContext.get().partitionId(), 0
    block: _Block | None = None
    at = None
    for batch in text_slices(batches):
        for m, slot, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block is not None and ((m, slot) != at or block.full()):
                yield from block.rows(shard, number)
                block, number = None, number + 1
            block, at = block or _Block(m), (m, slot)
            block.add(doc_id, term_counts(text))
    if block is not None:
        yield from block.rows(shard, number)


class Index:
    """The tables of an index below one path, and the counts that scores need.

    ``postings``: shard and block (which name a block), m, term, tf, places (of the documents in their
    block); a row without a term holds the block's ``docs``, their ids. ``size``: n_docs and n_terms.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.rows = spark.read.schema(_POSTINGS_SQL).parquet(f"{path}/postings")
        self.postings = self.rows.where("term is not null").drop("docs")
        self.blocks = self.rows.where("term is null").select("shard", "block", "docs")
        size = spark.read.parquet(f"{path}/size").first()
        self.n_docs, self.n_terms = size["n_docs"], size["n_terms"]


def build(docs: DataFrame, path: str) -> Index:
    """Index every document that has a term.

    The lengths of all documents give the sizes of the strata, and a stratum is dealt out by row to as
    many slots as hold a block each; so a stratum that holds most documents, or one doc_id on very many
    rows, is spread over tasks like anything else. Texts cross the network once.
    """
    spark = docs.sparkSession
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    lengths = texts.select("text").mapInArrow(_lengths, "n long, docs long").where("n > 0")
    lengths.groupBy("n").agg(F.sum("docs").alias("docs")).write.mode("errorifexists").parquet(f"{path}/lengths")
    lengths = spark.read.parquet(f"{path}/lengths")
    sizes = lengths.agg(F.sum("docs").alias("n_docs"), F.sum(F.col("docs") * F.col("n")).alias("n_terms"))
    sizes.na.fill(0).write.mode("errorifexists").parquet(f"{path}/size")
    size = spark.read.parquet(f"{path}/size").first()
    m = normaliser("n", size["n_docs"], size["n_terms"]).alias("m")
    strata = lengths.select(m, "docs").groupBy("m").agg(F.ceil(F.sum("docs") / BLOCK_DOCS).cast("int").alias("slots"))
    counted = texts.mapInArrow(_with_length, "doc_id long, text string, n long").where("n > 0")
    row = F.xxhash64(F.monotonically_increasing_id())
    # One row for each different m, of which there are fewer than lengths.
    dealt = counted.select(m, "doc_id", "text", row.alias("_row")).join(F.broadcast(strata), "m")
    dealt = dealt.withColumn("slot", F.pmod("_row", "slots").cast("int")).select("m", "slot", "doc_id", "text")
    ordered = dealt.repartition("m", "slot").sortWithinPartitions("m", "slot", "doc_id")
    ordered.mapInArrow(_index_rows, _POSTINGS_SQL).write.mode("errorifexists").parquet(f"{path}/postings")
    return Index(spark, path)


# --- search


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        found = [term_counts(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(c) for c in found]), pa.int64()),
                "term": pa.array([t.decode() for c in found for t in c], pa.string()),
                "times": pa.array([k for c in found for k in c.values()], pa.int64()),
            }
        )


def _best_in_block(k: int):
    """Scores of one block: visits (item, terms, times) against the postings (term_id, impact, places)."""

    def score(key, visits: pa.Table, postings: pa.Table) -> pa.Table:
        term = postings.column("term_id").to_numpy()
        places = postings.column("places").combine_chunks()
        lists = places.offsets.to_numpy()
        flat, impact = places.values.to_numpy(zero_copy_only=False), postings.column("impact").to_numpy()
        rows: dict[int, list[int]] = {}
        for row, t in enumerate(term.tolist()):
            rows.setdefault(t, []).append(row)
        n = int(flat.max()) + 1 if len(flat) else 0
        items, found, scores = [], [], []
        for item, names, times in zip(*(visits.column(c).to_pylist() for c in ("item", "term_ids", "times")), strict=True):
            total = np.zeros(n, np.int64)
            for name, often in zip(names, times, strict=True):
                for row in rows.get(name, ()):
                    total[flat[lists[row] : lists[row + 1]]] += often * impact[row]
            best = _best(total, k)
            items.append(np.full(len(best), item, np.int64))
            found.append(best)
            scores.append(total[best])
        n_rows = sum(map(len, found))
        return pa.table(
            {
                "item": np.concatenate(items) if items else pa.array([], pa.int64()),
                "shard": pa.array([key[0].as_py()] * n_rows, pa.int32()),
                "block": pa.array([key[1].as_py()] * n_rows, pa.int32()),
                "place": pa.array(np.concatenate(found) if found else [], pa.int32()),
                "score": pa.array(np.concatenate(scores) if scores else [], pa.int64()),
            }
        )

    return score


def _best(total: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above 0, equal ones by place: a block's documents ascend by id."""
    positive = np.flatnonzero(total)
    if len(positive) > k:
        cut = np.partition(total[positive], len(positive) - k)[len(positive) - k]
        above = positive[total[positive] > cut]
        return np.concatenate((above, positive[total[positive] == cut][: k - len(above)]))
    return positive


def search(index: Index, items: DataFrame, store: TableStore, k: int = RESULTS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest-scoring documents of every row of ``items``.

    ``items`` has item_id and text. A document's score is the sum over the item's terms, repeats included,
    of w * ((10^9 * tf) div (1000 * tf + 12 * m)); documents without a score above 0 are not listed, equal
    scores rank by ascending doc_id, a null doc_id first. Null or empty items, and items whose terms no
    document has, give no rows; every row of ``items`` is ranked for itself, also where item_ids or texts
    repeat. Null and empty documents are in no result, repeated documents each are, texts count whole and
    other columns are ignored. An empty table on either side gives no rows.
    """
    asked = pick(items, "item_id", "text").select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("string"))
    asked = store("items", asked)
    wanted = store("wanted", asked.select("item", "text").mapInArrow(_item_terms, "item long, term string, times long"))
    names = wanted.select("term").distinct()
    met = store("met", index.postings.join(names, "term"))
    df = met.groupBy("term").agg(F.sum(F.size("places")).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.n_docs + 2) / (2.0 * F.col("df") + 1)))
    weights = store("weights", df.select("term", weight.cast("bigint").alias("w"), F.monotonically_increasing_id().alias("term_id")))
    impacts = store(
        "impacts", met.join(weights.where("w > 0"), "term").select("shard", "block", "term_id", impact("w").alias("impact"), "places")
    )
    questions = store("questions", wanted.join(weights.where("w > 0"), "term").select("item", "term_id", "times"))

    # An impact grows with tf, so the largest of a term in a block is that of its largest tf.
    tops = store("tops", impacts.groupBy("shard", "block", "term_id").agg(F.max("impact").alias("top")))
    bounds = store(
        "bounds", tops.join(questions, "term_id").groupBy("item", "shard", "block").agg(F.sum(F.col("top") * F.col("times")).alias("bound"))
    )
    asking = questions.groupBy("item").agg(F.collect_list(F.struct("term_id", "times")).alias("of"))
    lists = store("lists", asking.select("item", F.col("of.term_id").alias("term_ids"), F.col("of.times").alias("times")))

    def visit(name: str, visits: DataFrame) -> DataFrame:
        """The best documents of each visited block."""
        met_there = impacts.join(visits.select("shard", "block").distinct(), ["shard", "block"], "left_semi")
        asked_there = visits.join(lists, "item").groupBy("shard", "block")
        kinds = "item long, shard int, block int, place int, score long"
        return store(name, asked_there.cogroup(met_there.groupBy("shard", "block")).applyInArrow(_best_in_block(k), kinds))

    best = Window.partitionBy("item").orderBy(F.desc("score"))
    turn = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "shard", "block"))
    first = store("first", bounds.withColumn("turn", turn).where(F.col("turn") <= FIRST_BLOCKS).select("item", "shard", "block"))
    early = visit("early", first)
    ranked = early.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    least = ranked.groupBy("item").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    least = store("least", least.where(F.col("n") >= k).drop("n"))
    others = bounds.join(first, ["item", "shard", "block"], "left_anti").join(least, "item", "left")
    late = visit("late", store("rest", others.where("least is null or bound >= least").select("item", "shard", "block")))

    # Those that may be among the results, ties included; then ids settle the ties.
    found = early.unionByName(late).withColumn("rank", F.rank().over(best)).where(F.col("rank") <= k)
    found = store("found", found.drop("rank"))
    ids = found.join(index.blocks, ["shard", "block"]).select("item", "score", F.get("docs", F.col("place")).alias("doc_id"))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    top = ids.withColumn("rank", place).where(F.col("rank") <= k)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
