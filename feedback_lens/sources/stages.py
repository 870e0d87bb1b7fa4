"""Prepared stages that later runs reuse."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from feedback_lens.session import shuffles_removed


def stage_path(path: str, key: Mapping[str, Any]) -> str:
    digest = hashlib.sha256(json.dumps(key, sort_keys=True, default=str).encode()).hexdigest()[:16]
    return f"{path.rstrip('/')}/stage={digest}"


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` ended: its committer leaves a mark only then."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def stage(
    spark: SparkSession,
    build: Callable[[], DataFrame],
    path: str,
    key: Mapping[str, Any],
    reprocess: bool = False,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """The table at ``path`` for these parameters, built on first use or when ``reprocess`` is set.

    The folder name hashes the parameters, so a changed parameter never reads an old stage.
    """
    target = stage_path(path, key)
    if not reprocess and finished(spark, target):
        return spark.read.parquet(target)
    writer = build().write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_removed(spark):
        writer.parquet(target)
    return spark.read.parquet(target)
