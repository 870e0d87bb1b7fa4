"""Exact top-k search by integer inner product: exhaustive term-at-a-time accumulation.

A vector becomes a sparse row of integers, one per component ``x``: ``floor(scale * x)``, zeros left out. Rows are stored in blocks as
postings: for each component the rows that have it, with their weights. A block of queries scans one stripe of candidate blocks: component
by component it scatters the weighted postings into a dense array of scores, one row per query; the best ``k`` of the block are found by
partition selection and merged with the best so far. The lists of all stripes are merged by rank at the end.

Candidates are copied once per block of queries and queries once per stripe (a fixed number), so that a task holds one block of queries, one
block of candidates and its scores, whatever the size of the table. What leaves the scan is ``k`` rows per query and stripe.

Rows of the same id are never compared (a query's own row is one of them); each row of a repeated id is a query with rows of its own and a
candidate with a row of its own. A candidate without an id ranks last among ties. Null, and empty vectors: null takes no part, an empty one
scores 0 against all. Vectors of different lengths share the components that both have. Vectors with null, infinite or undefined components
take no part. Integers saturate at the range of a long, as do scores; sums are exact. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_lens.llm.common import arrow_stream, saved_table

#: Candidates and queries a block, and stripes of candidates that a block of queries is compared with side by side.
BLOCK, QUERIES, STRIPES = 4096, 512, 12
LONG = np.iinfo(np.int64)
BLOCK_SCHEMA = "block long, ids array<long>, places array<long>, starts array<long>, rows binary, weights binary, width int"


def whole(vectors: list, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors as flat entries (vector, component, integer), without zeros."""
    lengths = np.array([len(v) for v in vectors], np.int64)
    flat = np.concatenate([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else np.empty(0)
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * flat)
    inside = np.abs(scaled) < 2.0**63
    values = np.where(inside, np.where(inside, scaled, 0).astype(np.int64), np.where(scaled > 0, LONG.max, LONG.min))
    owner = np.repeat(np.arange(len(vectors)), lengths)
    component = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    kept = values != 0
    return owner[kept], component[kept], values[kept]


def narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    for kind in (np.int16, np.int32):
        if not len(values) or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return values.astype(kind)
    return values


class Postings:
    """Rows in order of their ids, and for each component the rows that have it with their weights."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, starts: np.ndarray, rows: np.ndarray, weights: np.ndarray):
        self.ids, self.known, self.starts, self.rows, self.weights = ids, known, starts, rows, weights
        self.largest = max((abs(int(weights.min())), abs(int(weights.max())))) if len(weights) else 0

    def __len__(self) -> int:
        return len(self.ids)

    def of(self, component: int) -> tuple[np.ndarray, np.ndarray]:
        if component + 1 >= len(self.starts):
            return self.rows[:0], self.weights[:0]
        span = slice(self.starts[component], self.starts[component + 1])
        return self.rows[span], self.weights[span]

    @property
    def components(self) -> int:
        return len(self.starts) - 1


def invert(n: int, owner: np.ndarray, component: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries by component: borders, rows and weights."""
    order = np.lexsort((owner, component))
    top = int(component.max()) + 1 if len(component) else 0
    starts = np.concatenate([[0], np.cumsum(np.bincount(component, minlength=top))]).astype(np.int64)
    return starts, owner[order].astype(np.uint16 if n <= 1 << 16 else np.int64), values[order]


def accumulate(queries: Postings, block: Postings) -> np.ndarray:
    """Scores of every query against every row of the block, component by component."""
    shared = min(queries.components, block.components)
    bound = queries.largest * block.largest * shared
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 62 else object
    scores = np.zeros((len(queries), len(block)), kind)
    dense = np.zeros(len(block), kind)
    for component in range(shared):
        (asking, amounts), (rows, weights) = queries.of(component), block.of(component)
        if not len(asking) or not len(rows):
            continue
        amounts, weights = amounts.astype(kind), weights.astype(kind)
        if 2 * len(rows) >= len(block):  # a full list is added as it lies
            dense[:] = 0
            dense[rows] = weights
            for query, amount in zip(asking, amounts, strict=True):
                scores[query] += amount * dense
        else:
            for query, amount in zip(asking, amounts, strict=True):
                scores[query, rows] += amount * weights
    return np.clip(scores, LONG.min, LONG.max).astype(np.int64) if kind is object else scores.astype(np.int64)


def select(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest allowed scores; of equal ones the first places."""
    places = np.flatnonzero(allowed)
    values = scores[places]
    if len(places) <= k:
        return places
    least = np.partition(values, len(values) - k)[len(values) - k]
    above = places[values > least]
    level = places[values == least][: k - len(above)]
    return np.concatenate([above, level])


class Best:
    """The best rows so far of each query of a block, merged with those of one candidate block after another."""

    def __init__(self, queries: Postings, places: np.ndarray, k: int):
        self.queries, self.places, self.k = queries, places, k
        self.found = [(np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)) for _ in range(len(queries))]

    def add(self, block: Postings) -> None:
        scores = accumulate(self.queries, block)
        for q in range(len(self.queries)):
            own = block.known & (block.ids == self.queries.ids[q])
            chosen = select(scores[q], ~own, self.k)
            ids, known, values = (
                np.concatenate(pair)
                for pair in zip(self.found[q], (block.ids[chosen], block.known[chosen], scores[q][chosen]), strict=True)
            )
            order = np.lexsort((ids, ~known, values * -1 if values.min(initial=0) > LONG.min else -values.astype(object)))[: self.k]
            self.found[q] = ids[order], known[order], values[order]

    def rows(self) -> pa.RecordBatch:
        sizes = [len(values) for _, _, values in self.found]
        ids, known, values = (np.concatenate(column) for column in zip(*self.found, strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(self.places, sizes)),
                pa.array(np.repeat(self.queries.ids, sizes)),
                pa.array(ids, mask=~known),
                pa.array(values),
            ],
            names=["place", "query_id", "vec_id", "score"],
        )


def _blocks(size: int, scale: float):
    """Blocks of at most ``size`` rows out of the rows of a partition, ordered by id inside a block."""

    def block(columns: list[tuple[list, list, list]]) -> pa.RecordBatch:
        ids, vectors, places = ([x for part in column for x in part] for column in zip(*columns, strict=True))
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        owner, component, values = whole([vectors[i] for i in order], scale)
        starts, rows, weights = invert(len(ids), owner, component, values)
        weights = narrow(weights)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([min(places)], pa.int64()),
                pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
                pa.array([[places[i] for i in order]], pa.list_(pa.int64())),
                pa.array([starts], pa.list_(pa.int64())),
                pa.array([rows.tobytes()], pa.binary()),
                pa.array([weights.tobytes()], pa.binary()),
                pa.array([weights.dtype.itemsize], pa.int32()),
            ],
            names=["block", "ids", "places", "starts", "rows", "weights", "width"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[list, list, list]] = []
        held = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - held)
                vectors = part.column("vector")
                flat = vectors.flatten().to_numpy(zero_copy_only=False)
                cuts = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))[:-1]
                waiting.append((part.column("vec_id").to_pylist(), np.split(flat, cuts), part.column("place").to_pylist()))
                held += part.num_rows
                at += part.num_rows
                if held == size:
                    yield block(waiting)
                    waiting, held = [], 0
        if held:
            yield block(waiting)

    return run


def _postings(row: dict) -> tuple[Postings, np.ndarray]:
    known = np.array([i is not None for i in row["ids"]], bool)
    ids = np.array([0 if i is None else i for i in row["ids"]], np.int64)
    rows = np.frombuffer(row["rows"], np.uint16 if len(ids) <= 1 << 16 else np.int64)
    weights = np.frombuffer(row["weights"], f"i{row['width']}")
    return Postings(ids, known, np.asarray(row["starts"], np.int64), rows, weights), np.asarray(row["places"], np.int64)


def _scan(k: int):
    """Groups of one share of the queries and the candidate blocks of one stripe, in order: queries first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, best = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["asked"], row["stripe"]) != group:
                    yield from (b.rows() for b in best)
                    group, best = (row["asked"], row["stripe"]), []
                postings, places = _postings(row)
                if row["candidate"]:
                    for b in best:
                        b.add(postings)
                else:
                    best.append(Best(postings, places, k))
        yield from (b.rows() for b in best)

    return run


def top_k(vectors: DataFrame, asks: Column, k: int = 20, scale: float = 64.0, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best rows for every row that ``asks`` holds for, ties to smaller ids."""
    real = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks")
    )
    # Numbers of rows are written down once, so that later stages see the same ones whenever they run again.
    rows = saved_table(named.where(F.coalesce(real, F.lit(False))).withColumn("place", F.monotonically_increasing_id()))
    rows, asking = rows.drop("asks"), rows.where("asks").drop("asks")
    n_shares = max(1, -(-asking.count() // QUERIES))
    candidates = arrow_stream(rows, _blocks(BLOCK, scale), BLOCK_SCHEMA)
    # Rows are dealt in turn, so each share holds about QUERIES of them, whatever their ids.
    questions = arrow_stream(asking.repartition(n_shares), _blocks(2 * QUERIES, scale), BLOCK_SCHEMA)
    questions = saved_table(questions.select(F.spark_partition_id().alias("asked"), "*"))
    fields = [field.split()[0] for field in BLOCK_SCHEMA.split(", ")]
    every_stripe = F.explode(F.sequence(F.lit(0), F.lit(STRIPES - 1)))
    every_share = F.explode(F.sequence(F.lit(0), F.lit(n_shares - 1)))
    asks_all = questions.select("asked", every_stripe.alias("stripe"), F.lit(False).alias("candidate"), *fields)
    stripe = F.pmod(F.xxhash64("block"), F.lit(STRIPES)).cast("int")
    copies = candidates.select(every_share.alias("asked"), stripe.alias("stripe"), F.lit(True).alias("candidate"), *fields)
    both = asks_all.unionByName(copies).repartition("asked", "stripe").sortWithinPartitions("asked", "stripe", "candidate", "block")
    found = arrow_stream(both, _scan(k), "place long, query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.expr("row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id ASC NULLS LAST)"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
