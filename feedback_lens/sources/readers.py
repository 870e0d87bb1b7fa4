"""Scans. Schemas are declared, never inferred, so column pruning and filters reach the files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedback_lens.schema import LEXICON, PAGE, REVIEW, VECTOR
from feedback_lens.session import spread


def _scan(spark: SparkSession, path: str | Sequence[str], fmt: str, schema: T.StructType) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return spread(reader.format(fmt).load(paths))


def read_reviews(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Review corpus from one or several outputs; missing optional columns come back null."""
    return _scan(spark, path, fmt, REVIEW)


def read_pages(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    return _scan(spark, path, fmt, PAGE)


def read_lexicon(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema: T.StructType = LEXICON
) -> DataFrame:
    """Any lexical table: word classes and lemmas by default, or stop words and synonyms with their own schema."""
    return _scan(spark, path, fmt, schema)


def read_vectors(spark: SparkSession, path: str | Sequence[str], dim: int, fmt: str = "parquet") -> DataFrame:
    """Word vectors ``(word, vec)`` of one width; ``fmt="text"`` reads ``word v1 … vn`` lines.

    The count header of a text file (two fields) is skipped; any other row of another width fails the job.
    """
    if fmt != "text":
        wrong = F.concat(F.lit(f"a vector is not {dim} wide: "), F.col("word"))
        rows = _scan(spark, path, fmt, VECTOR)
        return rows.withColumn("vec", F.when(F.size("vec") == dim, F.col("vec")).otherwise(F.raise_error(wrong)))
    paths = [path] if isinstance(path, str) else list(path)
    parts = F.split(F.rtrim(F.col("value")), " ")
    rows = spark.read.text(paths).select(parts.alias("parts")).filter((F.size("parts") != 2) | F.lit(dim == 1))
    wrong = F.concat(F.lit(f"a vector is not {dim} wide: "), F.get("parts", F.lit(0)))
    vec = F.transform(F.slice("parts", 2, dim), lambda x: x.cast("float"))
    return rows.select(
        F.get("parts", F.lit(0)).alias("word"),
        F.when(F.size("parts") == dim + 1, vec).otherwise(F.raise_error(wrong)).alias("vec"),
    )
