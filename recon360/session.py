"""Session settings and the shared folder for tables written between steps."""

from __future__ import annotations

import atexit
import itertools
import shutil
import tempfile

from pyspark.sql import SparkSession

# Results depend on the first; the others only shape the physical plan.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition even where that costs one more shuffle above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort where one side of a shuffled join stays below this in every partition.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Parquet is compressed: judge by its size in memory what is small enough to broadcast.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}

# The same for sessions that say nothing else.
DEFAULTS = {
    # a task that sorts its part of a file before the shuffle holds many times the bytes of a well compressed file
    "spark.sql.files.maxPartitionBytes": "32MB",
    # tables of this size go to every executor
    "spark.sql.autoBroadcastJoinThreshold": "32MB",  # by the size of files
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "96MB",  # by the rows that were seen
}

# Input bytes per shuffle partition, before adaptive execution merges what turns out small. A shuffle holds a few
# times the input, and a task that sorts a partition several times the bytes shuffled.
BYTES_PER_PARTITION = 8 << 20
MOST_PARTITIONS = 20_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_roots: dict[str, str] = {}
_numbers = itertools.count()  # a root that was dropped is not used again


def build_session(app_name: str = "recon360", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the plans rely on to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of files or folders, on any file system Spark can read."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in found)


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle has before small ones are merged."""
    return int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def size_for(spark: SparkSession, n_bytes: int) -> None:
    """Let shuffles begin with partitions in proportion to the input, where the session has fewer.

    A fixed number makes the partitions, and what a task sorts and spills, grow with the input.
    """
    wanted = min(MOST_PARTITIONS, -(-n_bytes // BYTES_PER_PARTITION))
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    else:
        spark.conf.unset(INITIAL_PARTITIONS)
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, below the one ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a temporary folder. What a local session leaves
    on the local disk is removed when the process ends.
    """
    app_id = spark.sparkContext.applicationId
    if app_id in _roots:
        return _roots[app_id]
    local = spark.sparkContext.master.startswith("local")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not local:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = f"{(shared or tempfile.gettempdir()).rstrip('/')}/recon360-{app_id}-{next(_numbers)}"
    if local and "://" not in root:
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    _roots[app_id] = root
    return root


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, wherever they are."""
    root = _roots.pop(spark.sparkContext.applicationId, None)
    if root:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
