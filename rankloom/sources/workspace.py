"""Where intermediate and index tables are written."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one task analyzes and one bucket holds; some 4 million postings.
BUCKET_BYTES = 32 << 20
#: Files that a task keeps open at once instead of sorting its rows by directory.
OPEN_FILES = 32
#: Bytes of text that a posting stands for.
POSTING_TEXT = 8


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may do without: it gets a temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not re.match(r"local(\[|$)", context.master):  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="rankloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _in_store(spark: SparkSession, path: str):
    """A path and its file system, whatever store it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _in_store(spark, path)
    return store.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds."""
    store, at = _in_store(spark, path)
    store.delete(at, True)


#: A task that writes to at most so many directories keeps a file of each open, instead of sorting its rows first.
FILES_KEPT_OPEN = "spark.sql.maxConcurrentOutputFileWriters"
#: Bytes of a batch for Python. Spark looks at them after every row, unless they are ``ANY_BYTES``; where rows are
#: short, their number bounds a batch well enough.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
ANY_BYTES = 2**31 - 1


@contextmanager
def settings(spark: SparkSession, values: dict[str, int]) -> Iterator[None]:
    """What is run inside runs with other settings of the session."""
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Workspace:
    """A fresh sub-folder of the shared root; tables in it survive the loss of executors."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.id = uuid.uuid4().hex[:12]
        self.root = f"{(root or shared_root(spark)).rstrip('/')}/rankloom-{self.id}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table_name(self, name: str) -> str:
        return f"rankloom_{self.id}_{name}"

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write once and read back: cuts the lineage."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def save_bucketed(
        self,
        name: str,
        df: DataFrame,
        buckets: int,
        keys: tuple[str, ...] = ("doc_id",),
        partition_by: tuple[str, ...] = (),
        sort_by: tuple[str, ...] = ("doc_id",),
        directories: int | None = None,
    ) -> DataFrame:
        """As :meth:`save`, hash-bucketed so later joins and groupings on the keys stay local.

        ``directories`` says that a task of ``df`` has rows of one bucket, in at most so many directories. If
        they are few, its rows are sorted by ``sort_by`` alone, and a file in each directory is kept open.
        """
        few = directories is not None and directories <= OPEN_FILES
        if few:
            df = df.sortWithinPartitions(*sort_by)
        writer = (
            df.write.format("parquet")
            .mode("overwrite")
            .option("path", self.path(name))
            .bucketBy(buckets, *keys)
        )
        if not few:
            writer = writer.sortBy(*sort_by)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with settings(self.spark, {FILES_KEPT_OPEN: directories} if few else {}):
            writer.saveAsTable(self.table_name(name))
        return self.spark.table(self.table_name(name))


def bucket_count(df: DataFrame, splits_per_bucket: int = 64) -> int:
    """Buckets for a table of short rows derived from ``df``: one per core at least, up to 64 splits each."""
    spark = df.sparkSession
    splits = df.rdd.getNumPartitions()
    return max(spark.sparkContext.defaultParallelism, -(-splits // splits_per_bucket))


def text_buckets(df: DataFrame, size: Column | str = "text") -> int:
    """Buckets for postings derived from ``df``: one per core at least, about ``BUCKET_BYTES`` of text each.

    ``size`` is the text column or the bytes of a row. They are added up, as a split of a compressed file may
    hold any number of them; so what one task sorts and aggregates doesn't grow with the input.
    """
    size = F.octet_length(size) if isinstance(size, str) else size
    total = df.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-total // BUCKET_BYTES))


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a scan that has fewer splits than there are cores; others stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
