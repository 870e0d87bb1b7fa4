"""Helpers shared by the operators: table access, bounded Arrow batches, reliable intermediate tables."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from feedback_lens.session import cut_lineage, ensure_checkpoint_dir, shuffles_removed

BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end by bytes, so that very long texts cannot pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_FORGET: dict[str, Callable[[], None]] = {}
_SERVED = [""]


def remembers(module: str, forget: Callable[[], None]) -> None:
    """``forget`` drops what a Python worker remembers for ``module``; it is called when the worker turns to another module."""
    _FORGET[module] = forget


def serving(module: str) -> None:
    """Tell the worker whose function it runs now. Workers outlive stages, so what one stage remembers would lie beside the data of the next."""
    if _SERVED[0] != module:
        _SERVED[0] = module
        for owner, forget in _FORGET.items():
            if owner != module:
                forget()
        pa.default_memory_pool().release_unused()


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch of ``df``."""
    bounded_batches(df.sparkSession)
    module = fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serving(module)
        return (fn(batch) for batch in batches)

    return df.mapInArrow(run, schema)


def arrow_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over the stream of batches of one partition."""
    bounded_batches(df.sparkSession)
    module = fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serving(module)
        return fn(batches)

    return df.mapInArrow(run, schema)


def arrow_column(spark: SparkSession, fn: Callable[..., pa.Array], returns: str) -> Callable[..., Column]:
    """A column function that sees one Arrow array per argument; other columns never leave the JVM."""
    bounded_batches(spark)
    module = fn.__module__

    @arrow_udf(returns)
    def call(values: pa.Array) -> pa.Array:
        serving(module)
        return fn(values)

    return call


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """Membership of the held-out part by the checksum of the id as text; a null id is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def hash_share(column: str, share: float) -> Column:
    """Rows of a fixed pseudo-random share, chosen by a hash of ``column``."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 20)) < int(share * (1 << 20) + 0.5)


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode().lower().split() if text else []


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed public constants of splitmix64), for arrays of unsigned integers."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class Remembered:
    """Values of strings, made in batches and remembered in two generations: what is asked for again outlives a full table."""

    limit, longest = 250_000, 64

    def __init__(self, make: Callable[[list[str]], list]) -> None:
        self.make, self.fresh, self.old = make, {}, {}

    def __call__(self, keys: list[str]) -> list:
        try:
            return list(map(self.fresh.__getitem__, keys))
        except KeyError:
            pass
        found = {key: self.fresh.get(key) for key in set(keys)}
        missing = [key for key, value in found.items() if value is None]
        found.update((key, self.old.get(key)) for key in missing)
        new = [key for key in missing if found[key] is None]
        found.update(zip(new, self.make(new), strict=True))
        if len(self.fresh) + len(missing) > self.limit:
            self.old, self.fresh = self.fresh, {}
        self.fresh.update((key, found[key]) for key in missing if len(key) <= self.longest)
        return list(map(found.__getitem__, keys))


class WordHashes(dict):
    """Word (bytes) to a 64-bit hash, remembered up to a number of entries."""

    limit = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()
remembers("", _HASHES.clear)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` words; a shorter text is one run, no words are no run."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    with np.errstate(over="ignore"):
        if len(hashes) < size:
            total = np.uint64(len(hashes))
            for h in hashes:
                total = mix(np.array([total * np.uint64(0x100000001B3) + h]))[0]
            return np.array([total])
        n = len(hashes) - size + 1
        total = np.full(n, size, np.uint64)
        for i in range(size):
            total = mix(total * np.uint64(0x100000001B3) + hashes[i : i + n])
    return total


def store(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    return cut_lineage(df)


def saved_table(df: DataFrame) -> DataFrame:
    """``df`` written to and read from the shared folder; for wide tables, as Parquet is smaller there than a checkpoint."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/tables/{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(saved: DataFrame) -> None:
    """Delete a table of ``saved_table`` that nothing reads any more."""
    spark = saved.sparkSession
    for file in {name.rpartition("/")[0] for name in saved.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished phases: it does so once the driver has collected what refers to them."""
    gc.collect()
    spark._jvm.System.gc()


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, with their counts."""
    values = np.sort(values)
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    return values[starts], np.diff(np.append(starts, len(values)))


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    every, amounts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, amounts = every[order], amounts[order]
    starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
    return every[starts], np.add.reduceat(amounts, starts) if len(starts) else amounts


class Lookup:
    """Values by 64-bit keys for whole arrays: open addressing, one vector step per probe.

    The open table holds row numbers of 4 bytes only; keys and values stay as dense as they came.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.values = np.append(keys, np.uint64(0)), np.append(values, np.nan)
        self.none = len(keys)
        self.rows = np.full(1 << self.bits, self.none, np.int32)
        places, waiting = self._first(keys), np.arange(len(keys), dtype=np.int32)
        while len(waiting):
            spots = places[waiting]
            free = self.rows[spots] == self.none
            # Of those that want one free spot, the row written last has it.
            self.rows[spots[free]] = waiting[free]
            waiting = waiting[self.rows[spots] != waiting]
            places[waiting] = (places[waiting] + 1) & ((1 << self.bits) - 1)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Values of ``keys``; not a number for a key that is not there."""
        places = self._first(keys)
        rows = self.rows[places]
        wrong = np.flatnonzero((self.keys[rows] != keys) & (rows != self.none))
        while len(wrong):
            places[wrong] = (places[wrong] + 1) & ((1 << self.bits) - 1)
            rows[wrong] = self.rows[places[wrong]]
            wrong = wrong[(self.keys[rows[wrong]] != keys[wrong]) & (rows[wrong] != self.none)]
        return self.values[rows]
