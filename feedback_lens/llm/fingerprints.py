"""SimHash fingerprints, and the search for all within a Hamming radius.

Terms are pairs of neighbouring words (a text of one word has that word, no words no term). Every occurrence of a term votes with its hash,
one vote for each bit; terms weigh as often as they occur. A bit is set where the votes for it prevail. Texts without terms
get the fingerprint of zeros. Equal texts have equal fingerprints.

``neighbours`` cuts fingerprints into more blocks than the radius has bits, so two fingerprints within the radius agree on one block at
least (tables of permuted blocks). Equal fingerprints are one entry first; a crowded block value is dealt over salts, and both sides
meet on (table, block value, salt), so no task gets more than a share of it. Queries are a stated set.

Null texts are empty. Ties and repeated rows keep their own rows. Empty tables give empty results. Only named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_lens.llm.common import arrow_column, arrow_stream, ascii_words, mix, word_hashes

WORDS = 2  # 64-bit words of a fingerprint
BITS = 64 * WORDS
CHUNK = 1 << 16
BUCKET_ROWS = 1000
MOST_BUCKETS = 50_000


def fingerprint(text: str) -> bytes:
    """``BITS`` bits as bytes."""
    words = ascii_words(text)
    if not words:
        return bytes(BITS // 8)
    hashes = word_hashes(words)
    with np.errstate(over="ignore"):
        terms = mix(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) > 1 else mix(hashes)
    votes = np.zeros(BITS, np.int64)
    for start in range(0, len(terms), CHUNK):
        part = terms[start : start + CHUNK]
        lanes = np.stack([mix(part + np.uint64(lane)) for lane in range(WORDS)], axis=1)
        votes += np.unpackbits(lanes.view(np.uint8).reshape(len(part), -1), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > len(terms)).tobytes()


def distance(a: bytes, b: bytes) -> int:
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


def likeness(a: bytes, b: bytes) -> float:
    return 1 - distance(a, b) / BITS


def fingerprint_column(spark):
    """Text to its fingerprint as hexadecimal digits."""

    def make(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(text or "").hex() for text in texts.to_pylist()], pa.string())

    return arrow_column(spark, make, "string")


def _buckets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with ``bucket``: descending ranges of near ids, cut at approximate quantiles; and where each bucket's first row goes as well.

    Borders only even out sizes; at most ``MOST_BUCKETS`` of them are held. Null ids are in the last bucket.
    """
    spark = docs.sparkSession
    n = min(MOST_BUCKETS, max(1, -(-docs.count() // BUCKET_ROWS)))
    cuts = docs.agg(F.percentile_approx("doc_id", [(i + 1) / n for i in range(n)], 50_000).alias("cuts")).first()["cuts"]
    borders = np.unique(np.array(cuts or [], np.int64))

    def place(ids: pa.Array) -> pa.Array:
        values = np.array([borders[0] if i is None else i for i in ids.to_pylist()] if len(borders) else [0] * len(ids), np.int64)
        found = len(borders) - np.searchsorted(borders, values, side="left")
        return pa.array([len(borders) if i is None else int(b) for i, b in zip(ids.to_pylist(), found, strict=True)], pa.int32())

    rows = docs.withColumn("bucket", arrow_column(spark, place, "int")(F.col("doc_id").cast("long")))
    firsts = sorted((r["bucket"], r["first"]) for r in rows.select("bucket", "doc_id").groupBy("bucket").agg(F.max("doc_id").alias("first")).collect())
    goes = [(first, firsts[i - 1][0], bucket) for i, (bucket, first) in enumerate(firsts)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows, spark.createDataFrame(goes, f"first {kind}, target int, origin int")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """For every document its fingerprint, that of its edited text, and how alike these and the next document's are.

    The next document is the one with the next smaller doc_id (equal ids by text; after the last comes the first). The edited text has the
    last half of its characters replaced by as many first ones of the next document, or by all it has.
    """
    rows, goes = _buckets(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")))
    # At most MOST_BUCKETS rows say which documents also close another bucket.
    joined = rows.join(F.broadcast(goes), F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("bucket") == F.col("origin")), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("closing"))
    closes = F.struct(F.col("target").alias("bucket"), F.lit(1).alias("closing"))
    spots = F.explode(F.when(F.col("target").isNull(), F.array(own)).otherwise(F.array(own, closes)))
    dealt = joined.select("doc_id", "text", spots.alias("at")).select("doc_id", "text", "at.bucket", "at.closing").repartition("bucket")
    ordered = dealt.sortWithinPartitions("bucket", "closing", F.col("doc_id").desc_nulls_last(), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    return arrow_stream(ordered, _edit, schema)


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: tuple | None = None  # bucket, doc_id, text, fingerprint of the row whose next one has not come yet
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for batch in batches:
        out = []
        for doc_id, text, bucket, closing in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if closing and (waiting is None or waiting[0] != bucket):
                continue
            own = fingerprint(text)
            if waiting is not None and waiting[0] == bucket:
                _, before, old, print_ = waiting
                half = len(old) // 2
                edited = old[: len(old) - half] + text[:half]
                new = fingerprint(edited)
                digest = hashlib.sha256(edited.encode()).hexdigest()
                out.append((before, len(old), digest, print_.hex(), new.hex(), likeness(print_, new), likeness(print_, own)))
            waiting = None if closing else (bucket, doc_id, text, own)
        types = [batch.column(0).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def neighbours(queries: DataFrame, rows: DataFrame, radius: int, *, id_column: str = "doc_id") -> DataFrame:
    """Pairs query_id, row_id, distance with fingerprints at most ``radius`` bits apart; a row is no neighbour of itself.

    Both frames have the id and ``fingerprint`` (hexadecimal). Different fingerprints meet once per table; ids are joined back last.
    """
    if not 0 <= radius < BITS // 4:
        raise ValueError("the radius must be below the number of hexadecimal digits")
    digits = BITS // 4
    tables = radius + 1
    cuts = [round(i * digits / tables) for i in range(tables + 1)]

    def blocks(prints: DataFrame) -> DataFrame:
        parts = [F.substring("fingerprint", a + 1, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
        return prints.select("fingerprint", F.posexplode(F.array(*parts)).alias("table", "block"))

    left = blocks(queries.select("fingerprint").distinct()).withColumnRenamed("fingerprint", "query_print")
    right = blocks(rows.select("fingerprint").distinct()).withColumnRenamed("fingerprint", "row_print")
    sizes = right.groupBy("table", "block").agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).alias("salts"))
    right = right.join(sizes, ["table", "block"]).withColumn("salt", F.pmod(F.xxhash64("row_print"), "salts")).drop("salts")
    left = left.join(sizes, ["table", "block"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    pairs = left.join(right.withColumn("salt", F.col("salt").cast("long")), ["table", "block", "salt"])
    words = [(i + 1, 16) for i in range(0, digits, 16)]

    def far(a: str, b: str):
        """Bits by which two hexadecimal strings differ."""
        parts = [F.bit_count(F.conv(F.substring(a, s, n), 16, -10).cast("long").bitwiseXOR(F.conv(F.substring(b, s, n), 16, -10).cast("long"))) for s, n in words]
        total = parts[0]
        for part in parts[1:]:
            total = total + part
        return total

    near = pairs.select("query_print", "row_print", far("query_print", "row_print").alias("distance")).where(F.col("distance") <= radius).distinct()
    q = queries.select(F.col(id_column).alias("query_id"), F.col("fingerprint").alias("query_print"))
    r = rows.select(F.col(id_column).alias("row_id"), F.col("fingerprint").alias("row_print"))
    return q.join(near, "query_print").join(r, "row_print").where("query_id <> row_id").select("query_id", "row_id", "distance")
