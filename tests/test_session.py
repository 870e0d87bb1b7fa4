import glob
import time

import pytest
from pyspark.sql import functions as F

from feedback_lens.llm.common import saved_table
from feedback_lens.session import CLEANUP_KEY, written, written_in_buckets
from feedback_lens.sources import stage


def shuffles(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for folder in folders for name in glob.glob(f"{folder}/*/shuffle_*.data")}


@pytest.mark.parametrize("write", [lambda df: written(df).df, saved_table, lambda df: written_in_buckets(df, ["k"], 3).df])
def test_written_tables_leave_no_shuffle_files(spark, write):
    rows = spark.range(20_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    before, own = shuffles(spark), spark.conf.get(CLEANUP_KEY)
    found = write(rows)
    for _ in range(50):
        if not shuffles(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffles(spark) - before
    assert spark.conf.get(CLEANUP_KEY) == own
    assert found.count() == rows.count() == 1000
    assert shuffles(spark) - before  # other jobs keep theirs, so the files are looked for at the right place
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|odd"):
        write(rows.withColumn("n", F.when(F.col("n") > 0, F.raise_error(F.lit("odd"))).cast("long")))
    assert spark.conf.get(CLEANUP_KEY) == own


def test_inputs_built_once_leave_no_shuffle_files(spark, tmp_path):
    before = shuffles(spark)
    rows = spark.range(20_000, numPartitions=1).groupBy((F.col("id") % 1000).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    assert stage(spark, lambda: rows, str(tmp_path / "inputs"), {"k": 1}).count() == 1000
    for _ in range(50):
        if len(shuffles(spark) - before) <= 1:
            break
        time.sleep(0.1)
    assert len(shuffles(spark) - before) <= 1  # that of the count
