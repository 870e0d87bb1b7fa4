"""Near-duplicate vectors through a pivot-permutation index.

``PIVOTS`` reference vectors, taken from a sample of at most ``SAMPLE`` rows, describe a vector by its ``NEAREST`` pivots in
order of closeness. Inverted lists hold, for each label and pivot, the vectors that have it among their first
``PREFIX``. Two vectors of a list are candidates when they share at least ``SHARED`` of their nearest pivots; candidates are verified by
cosine in double precision. A pair that meets in several lists belongs to that of the smallest pivot that both prefixes have.

Equal vectors of a label are one class of copies first and are compared once. Crowded lists are dealt into blocks by a hash; two blocks meet
in a task of their own, so a task holds two blocks, whatever the list's size. Pairs stay inside the tasks: what leaves them are link
counts per class and, for the components, one link per class and block pair that joins trees.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor does a null label. Vectors are
compared within their own dimension. Rows with equal ids are one node of the graph. Empty tables give
empty results. Only id, vector and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_lens.llm.common import arrow_column, arrow_map, arrow_stream, store
from feedback_lens.llm.components import components

PIVOTS = 128
NEAREST = 12
PREFIX = 3
SHARED = 5
SAMPLE = 2048
APART = 0.8
BLOCK = 1024
STEP = 64


def unit_vectors(lists: pa.Array) -> pa.Array:
    """Vectors of length 1; null where a vector is null, empty, zero, or holds a null or non-finite component.

    Rows of one dimension are a matrix, and squares are added up column by column, so equal vectors stay equal bit by bit.
    """
    lists = lists.cast(pa.list_(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    good, out = np.zeros(len(lists), bool), np.zeros(len(flat))
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        places = starts[rows][:, None] + np.arange(size)
        values = flat[places]
        # Scaled by the greatest component first, so that no square overflows or vanishes.
        top = np.abs(values).max(axis=1)
        fine = np.isfinite(top) & (top > 0)
        scaled = values[fine] / top[fine][:, None]
        squares = np.zeros(len(scaled))
        for column in range(size):
            squares += scaled[:, column] * scaled[:, column]
        out[places[fine]] = scaled / np.sqrt(squares)[:, None]
        good[rows] = fine
    borders = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(out), mask=pa.array(~good))


def directions(vectors: DataFrame) -> DataFrame:
    """Rows vec_id, label, dimension, unit (array of doubles, null for vectors that link with nothing)."""
    units = arrow_column(vectors.sparkSession, unit_vectors, "array<double>")
    unit = F.when(F.col("label").isNotNull(), units(F.col("embedding").cast("array<double>")))
    return vectors.select("vec_id", "label", unit.alias("unit"), F.size("embedding").alias("dimension"))


def choose_pivots(heads: DataFrame, pivots: int = PIVOTS) -> dict[int, np.ndarray]:
    """Pivots by dimension, out of the ``SAMPLE`` rows of least hash: one after another, if far enough from those before.

    Without that, a crowd of like vectors would supply most pivots, whose order tells its members apart by noise.
    """
    dimensions = [r["dimension"] for r in heads.select("dimension").distinct().collect()]
    out = {}
    for dimension in sorted(dimensions):
        rows = heads.where(F.col("dimension") == dimension).orderBy(F.xxhash64("unit"), "vec_id").limit(SAMPLE).select("unit").collect()
        units = np.array([r["unit"] for r in rows], np.float64)
        chosen = [0]
        for row in range(1, len(units)):
            if len(chosen) < pivots and (units[chosen] @ units[row]).max() < APART:
                chosen.append(row)
        out[dimension] = units[chosen]
    return out


def nearest(units: np.ndarray, pivots: np.ndarray, count: int = NEAREST) -> np.ndarray:
    """Numbers of the nearest pivots, closest first; ties by number."""
    return np.argsort(-(units @ pivots.T), axis=1, kind="stable")[:, : min(count, len(pivots))].astype(np.int32)


def _list_pairs(rows: list, same: bool, cosine: float, pivot: int, shared: int, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs between the two halves of ``rows`` (or within, if ``same``): tuples (id, permutation, unit, half)."""
    halves = [[r for r in rows if r[3] == h] for h in sorted({r[3] for r in rows})]
    left = halves[0] if halves else []
    right = left if same else (halves[1] if len(halves) > 1 else [])
    if not left or not right:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    perms = [np.array([r[1] for r in part]) for part in (left, right)]
    units = [np.array([r[2] for r in part]) for part in (left, right)]
    width = int(max(p.max() for p in perms)) + 1
    marks, first = [], []
    for p in perms:
        m = np.zeros((len(p), width), np.float32)
        np.put_along_axis(m, p, 1, axis=1)
        marks.append(m)
        f = np.zeros((len(p), width), bool)
        np.put_along_axis(f, p[:, :prefix], True, axis=1)
        first.append(f)
    ids = [np.array([r[0] for r in part], np.int64) for part in (left, right)]
    least, out = min(shared, perms[0].shape[1]), []
    for start in range(0, len(left), STEP):
        i, j = np.nonzero(marks[0][start : start + STEP] @ marks[1].T >= least)
        i += start
        if same:
            i, j = i[i < j], j[i < j]
        # The list of the smallest pivot that both prefixes have counts the pair.
        mine = (first[0][i] & first[1][j]).argmax(axis=1) == pivot
        i, j = i[mine], j[mine]
        hit = np.einsum("ij,ij->i", units[0][i], units[1][j]) >= cosine
        out.append((ids[0][i[hit]], ids[1][j[hit]]))
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _trees(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Links that join different trees."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for x, y in zip(a, b, strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def near_vectors(vectors: DataFrame, *, cosine: float = 0.98, shared: int = SHARED, prefix: int = PREFIX) -> DataFrame:
    """Rows vec_id, n_links, component_id, kept for every row of ``vectors``."""
    spark = vectors.sparkSession
    rows = store(directions(vectors.select("vec_id", "embedding", "label")))
    usable = rows.where("unit is not null and vec_id is not null")
    # Copies of a vector are one class; its members link with each other and share all links of the class.
    classes = store(usable.groupBy("label", "unit").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")))
    heads = classes.withColumn("dimension", F.size("unit"))
    pivots = spark.sparkContext.broadcast(choose_pivots(heads))
    kind, label = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        units, dims = batch["unit"].to_pylist(), batch["dimension"].to_pylist()
        permutations: list = [None] * len(units)
        for dimension, own in pivots.value.items():
            at = [i for i, d in enumerate(dims) if d == dimension]
            if at:
                found = nearest(np.array([units[i] for i in at]), own)
                for i, p in zip(at, found.tolist(), strict=True):
                    permutations[i] = p
        lists = pa.array(permutations, pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "permutation"])

    schema = f"label {label}, unit array<double>, vec_id {kind}, copies long, dimension int, permutation array<int>"
    described = store(arrow_map(heads.select("label", "unit", "vec_id", "copies", "dimension"), describe, schema))
    entries = described.withColumn("pivot", F.explode(F.slice("permutation", 1, prefix)))
    sizes = entries.groupBy("label", "dimension", "pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    entries = entries.join(sizes, ["label", "dimension", "pivot"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    entries = entries.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    key = ["label", "dimension", "pivot", "i", "j"]
    ordered = entries.select(*key, "block", "vec_id", "copies", "unit", "permutation").repartition(*key).sortWithinPartitions(*key, "block", "vec_id")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (id, other, links): links of a class to others' members, and (with ``other``) links that join trees."""
        now, group = None, []

        def solve() -> list[tuple[int, int | None, int]]:
            if now is None or len(group) < 2:
                return []
            a, b = _list_pairs(group, now[3] == now[4], cosine, now[2], shared, prefix)
            if not len(a):
                return []
            copies = {r[0]: r[4] for r in group}
            links: dict[int, int] = {}
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                links[x] = links.get(x, 0) + copies[y]
                links[y] = links.get(y, 0) + copies[x]
            return [(x, None, n) for x, n in links.items()] + [(x, y, 0) for x, y in _trees(a.tolist(), b.tolist())]

        def table(out: list) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "other", "links"])

        for batch in batches:
            out = []
            names = (*key, "block", "vec_id", "copies", "unit", "permutation")
            for *at, block, id_, copies, unit, permutation in zip(*(batch[n].to_pylist() for n in names), strict=True):
                if at != now:
                    out += solve()
                    now, group = at, []
                group.append((id_, permutation, unit, block, copies))
            yield table(out)
        yield table(solve())

    found = store(arrow_stream(ordered, link, "id long, other long, links long"))
    counts = found.where("other is null").groupBy(F.col("id").alias("head")).agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    joined = joined.select(F.col("id").alias("head"), "component")
    heads = classes.select("label", "unit", F.col("vec_id").cast("long").alias("head"), "copies")
    solved = heads.join(counts, "head", "left").join(joined, "head", "left")
    out = rows.join(solved, ["label", "unit"], "left")
    linkless = F.col("head").isNull() | F.col("vec_id").isNull()
    n_links = F.when(linkless, F.lit(0)).otherwise(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long")
    component = F.when(linkless, F.col("vec_id")).otherwise(F.coalesce("component", "head")).cast(kind)
    out = out.select("vec_id", n_links.alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
