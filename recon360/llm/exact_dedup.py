"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest, of one file per bucket, and a second one of
the same buckets for what came since. A batch of documents is reduced to one row per digest, deduplicated
against both by sort-merge anti-joins, and its new digests are appended to the second, which is merged
into the first after some appends. The first is neither shuffled nor sorted to be joined, the second is
not shuffled. DataFrame operations only.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recon360.llm.common import Rows, ascii_lower, pick, text_hash
from recon360.sources.store import TableStore


_WRITE = re.compile(r"part-\d+-([0-9a-f-]{36})")


def digest(text: Column) -> Column:
    """SHA-256, as 32 bytes, of the text with A-Z lower-cased; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256))


class DigestIndex:
    """Digests seen so far, with the id of the document that stays for each.

    ``path`` is the index: opening it again, in this or a later session, continues it. It must be
    opened with the number of buckets it was made with. One writer at a time. The tables have names in
    the session's catalogue until ``close``, which leaves the files.
    """

    COLUMNS = "digest BINARY, keep_id BIGINT"
    # Appends before the appended digests are merged into the sorted files.
    MOST_APPENDS = 8

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        self.path = f"{path.rstrip('/')}/buckets_{buckets}"
        self.buckets = buckets
        # a bucket of one file is read in the order it was written in
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._files = hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.version = 0
        while self._whole(self.version + 1):
            self.version += 1
        self._open()

    def _whole(self, version: int) -> bool:
        """Whether a merge was finished; an unfinished one is written again."""
        return self._files.exists(self._path(f"{self.path}/sorted_{version}/_SUCCESS"))

    def _open(self) -> None:
        name = hashlib.md5(self.path.encode()).hexdigest()
        self.tables = {}
        for kind in ("sorted", "recent"):
            self.tables[kind] = f"digests_{name}_{kind}_{self.version}"
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.tables[kind]} ({self.COLUMNS}) USING parquet CLUSTERED BY (digest) "
                f"SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{kind}_{self.version}'"
            )

    def close(self) -> None:
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def _table(self, kind: str) -> DataFrame:
        self.spark.catalog.refreshTable(self.tables[kind])
        return self.spark.table(self.tables[kind])

    def read(self) -> DataFrame:
        return self._table("sorted").unionByName(self._table("recent"))

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (unique by digest) whose digest the index lacks."""
        for kind in self.tables:
            groups = groups.join(self._table(kind).select("digest").hint("merge"), "digest", "left_anti")
        return groups

    def seen(self, groups: DataFrame) -> DataFrame:
        """(digest, index_id) of the digests of ``groups`` that the index has."""
        kinds = [self._table(kind).select("digest", F.col("keep_id").alias("index_id")) for kind in self.tables]
        found = [groups.select("digest").join(rows.hint("merge"), "digest") for rows in kinds]
        return found[0].unionByName(found[1])

    def append(self, groups: DataFrame) -> None:
        """Add new digests, one sorted file per bucket."""
        rows = groups.select("digest", F.col("keep_id").cast("bigint"))
        rows.repartition(self.buckets, "digest").write.insertInto(self.tables["recent"])
        if self._appends() > self.MOST_APPENDS:
            self.merge()

    def _appends(self) -> int:
        """Writes that the appended files come from: a name has that of its write in it."""
        files = self._files.listStatus(self._path(f"{self.path}/recent_{self.version}"))
        names = [str(f.getPath().getName()) for f in files]
        return len({found[1] for found in map(_WRITE.match, names) if found})

    def merge(self) -> None:
        """Write all digests as the next version: one sorted file per bucket, nothing appended."""
        old, new = dict(self.tables), self.version + 1
        rows, where = self.read(), f"{self.path}/sorted_{new}"
        table = self.tables["sorted"].removesuffix(f"_{self.version}") + f"_{new}"
        # Not by the column itself: a bucketed scan seems dealt out by it already, so that Spark drops the
        # exchange and then, as nothing asks for buckets any more, reads files as they come.
        dealt = rows.repartition(self.buckets, F.coalesce("digest", F.lit(b"")))
        writer = dealt.write.mode("overwrite").option("path", where)
        writer.bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(table)
        self.version = new
        self._open()
        for name in old.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def ingest(docs: DataFrame, index: DigestIndex, store: TableStore) -> DataFrame:
    """Deduplicate ``docs`` (doc_id, text) against the index and themselves, and add what is new.

    One row per input row: doc_id, keep_id, group_size (rows of this batch with the text), kept,
    text_sha256. Among equal texts of a batch the largest doc_id stays, unless the index has the
    text already: then none stays and keep_id is the id the index holds. A null text is the empty
    text; a null doc_id is smaller than any; of several rows with the same id and text exactly one is
    kept. An empty batch gives no rows and leaves the index as it was.
    """
    rows = store(
        "rows",
        pick(docs, "doc_id", "text").select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            digest(F.col("text")).alias("digest"),
        ),
    )
    groups = store(
        "groups",
        rows.groupBy("digest")
        .agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("last.doc_id").alias("keep_id"), F.col("last.row").alias("keep_row"), "group_size"),
    )
    new = store("new", index.unseen(groups))
    # Written, so that the join below has a shuffle on both sides and a hot digest can split.
    known = groups.drop("keep_id", "keep_row").join(index.seen(groups), "digest")
    known = known.select("digest", F.col("index_id").alias("keep_id"), F.lit(None).cast("bigint").alias("keep_row"), "group_size")
    resolved = store("resolved", new.select(known.columns).unionByName(known))
    index.append(new)
    return rows.join(resolved, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_documents(docs: DataFrame, index: DigestIndex, store: TableStore) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = Rows(docs)
    verdict = store("verdict", ingest(docs, index, store).where("kept"))
    keepers = verdict.select(F.col("doc_id").alias("_keep_id"), F.unhex("text_sha256").alias("_keep_digest"))
    # Written, so that the text columns below are joined as they are scanned.
    keepers = store("keepers", keepers)
    marked = rows.flat.withColumn("_digest", digest(rows.text))
    same = (marked["_digest"] == keepers["_keep_digest"]) & rows.id.cast("bigint").eqNullSafe(keepers["_keep_id"])
    kept = marked.join(keepers, same, "left_semi")
    if kept_twice(docs, store):
        kept = kept.dropDuplicates(["_digest"])
    return rows.back(kept)


def kept_twice(docs: DataFrame, store: TableStore) -> bool:
    """Whether some (doc_id, text) comes more than once, which no id can tell apart."""
    rows = store.spark.read.parquet(store.path("rows"))
    again = rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return not again.isEmpty()
