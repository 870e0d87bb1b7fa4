"""Session helpers: settings the library relies on, and lineage cuts that survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings every job here assumes; partition counts stay with the cluster."""
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; a temporary one only where none is named (tests)."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        named = os.path.join(tempfile.gettempdir(), f"feedback_lens_{context.applicationId}")
    context.setCheckpointDir(named)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the plan restarts from files, so a lost executor costs one read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Arrow batches end by bytes, so that long texts and pages cannot pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes started in here remove their shuffle files when they end.

    Otherwise the files stay until the driver has collected what refers to them, while the next phase already writes its own.
    """
    before = spark.conf.get(CLEANUP_KEY)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_KEY, before)


class Written:
    """A table written to the shared folder, to be removed once nothing reads it."""

    def __init__(self, spark: SparkSession, path: str, df: DataFrame, table: str | None = None):
        self.spark, self.path, self.df, self.table = spark, path, df, table

    def remove(self) -> None:
        if self.table is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _new_path(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stages/{name}"


def written(df: DataFrame) -> Written:
    """``df`` as Parquet in the shared folder: plans start from there, and the files go when they have been superseded."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    path = _new_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return Written(spark, path, spark.read.schema(df.schema).parquet(path))


def written_in_buckets(df: DataFrame, keys: Sequence[str], buckets: int, sort: Sequence[str] = ()) -> Written:
    """``df`` as a table in buckets by ``keys``: a join or cogroup on them reads it again and again without a shuffle."""
    spark, name = df.sparkSession, f"feedback_lens_{uuid.uuid4().hex}"
    path = _new_path(spark, name)
    writer = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*sort or keys)
    with shuffles_removed(spark):
        writer.option("path", path).saveAsTable(name)
    return Written(spark, path, spark.table(name), name)


def buckets_for(spark: SparkSession, groups: int) -> int:
    """Buckets for so many groups of rows: a task gets a few of them, but few groups do not meet in one bucket."""
    return max(1, min(4 * groups, max(4 * spark.sparkContext.defaultParallelism, -(-groups // 4))))


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores one split per core; larger scans are left as they are.

    Only the plan is looked at. A corpus of many files has more splits than cores and gets no shuffle here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, df.columns[0]) if df.rdd.getNumPartitions() < cores else df
