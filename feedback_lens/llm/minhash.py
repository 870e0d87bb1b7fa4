"""MinHash near-duplicates with sequential Bayesian verification.

A document's set holds its distinct word shingles as 64-bit hashes. Documents with the same word sequence form one class first, so copies
meet once per class. The class representatives (smallest id) get ``BANDS * ROWS`` MinHash values; those that agree on a whole band are
candidates. At the threshold 0.85 a pair misses all bands with probability (1 - 0.85**4)**24, about 2e-8.

Candidates are never expanded into all pairs of a bucket at once. First each document meets one pivot: the member of its buckets with the
fewest shingles of its own. What is linked then shares a component; only buckets that still hold several components are compared fully,
block against block: pairs whose components differ and whose shared shingles can suffice are verified in the task where they meet, and only
links that join components leave it. So no link between components is lost, and no row is made per pair, also in groups that miss the
threshold.

Pairs are compared batch by batch of their signatures. With a uniform prior on the similarity, m matches among n leave the posterior
probability P(Bin(n + 1, t) <= m) that it reaches the threshold t; a pair is dropped once that is below ``MISS``. Survivors are verified
exactly on full sets, made from whole texts.

Null or wordless texts have an empty set and are linked with nothing. A null id takes no part: its component is null and it is kept. Ids are
meant to be unique: rows that share an id are linked each by its own text. Empty tables give empty results. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_lens.llm.common import arrow_column, arrow_map, arrow_stream, ascii_words, mix, release, saved_table, shingle_hashes, store
from feedback_lens.llm.components import components

BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
BATCH = 16
MISS = 1e-9
SHINGLE = 5
BLOCK = 1024
BLOCK_SHINGLES = 1 << 22
PIVOT_ROWS = 256
CHUNK = 1 << 12
_WORDS = mix(np.arange(2 * HASHES, dtype=np.uint64) + np.uint64(0x5EED))
_FACTORS, _SHIFTS = _WORDS[:HASHES] | np.uint64(1), _WORDS[HASHES:]


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(ascii_words(text), size))


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits each) of a set."""
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for start in range(0, len(hashes), CHUNK):
            part = hashes[start : start + CHUNK, None] * _FACTORS[None, :] + _SHIFTS[None, :]
            least = np.minimum(least, (part >> np.uint64(32)).min(axis=0).astype(np.uint32))
    return least


def least_matches(percent: int, miss: float = MISS) -> list[tuple[int, int]]:
    """After n values, the fewest matches whose posterior does not rule the threshold out yet."""
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, 0
        while True:
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def may_reach(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of two signature matrices the sequential test lets through."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for n, least in least_matches(percent):
        part = slice(n - BATCH, n)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def reaches(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test on two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """Rows doc_id, digest of the word sequence, n_shingles, signature."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1).to_pylist():
            words = ascii_words(text)
            hashes = np.unique(shingle_hashes(words, size))
            digest = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
            rows.append((digest, len(hashes), signature(hashes).tobytes() if len(hashes) else None))
        columns = list(zip(*rows, strict=True)) or [()] * 3
        types = (pa.binary(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["doc_id", "digest", "n_shingles", "signature"]
        )

    return arrow_map(docs.select("doc_id", "text"), sketch, f"doc_id {kind}, digest binary, n_shingles long, signature binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _let_through(spark, percent: int) -> Callable:
    def test(pairs: pa.Array) -> pa.Array:
        a, b = (_matrix(c) for c in pairs.flatten())
        return pa.array(may_reach(a, b, percent), pa.bool_())

    column = arrow_column(spark, test, "boolean")
    return lambda a, b: column(F.struct(F.col(a).alias("a"), F.col(b).alias("b")))


def _full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """Rows id, set (sorted hashes) of the documents named in ``ids``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [shingle_set(text, size).tobytes() for text in batch["text"].to_pylist()]
        return pa.RecordBatch.from_arrays([batch["id"], pa.array(values, pa.binary())], ["id", "set"])

    return arrow_map(docs.select(F.col("doc_id").alias("id"), "text").join(ids, "id"), sets, f"id {kind}, set binary")


def _own_shingles(sets: DataFrame) -> DataFrame:
    """Rows id, n, own: the size of each set, and how many of its shingles no other set has."""
    kind = sets.schema["id"].dataType.simpleString()

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch["set"].to_pylist()
        rows = np.repeat(np.arange(len(values)), [len(v) // 8 for v in values])
        hashes = np.frombuffer(b"".join(values), np.int64)
        return pa.RecordBatch.from_arrays([batch["id"].take(pa.array(rows)), pa.array(hashes)], ["id", "hash"])

    once = arrow_map(sets, spread, f"id {kind}, hash long").groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    own = once.where("n = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    sizes = sets.select("id", (F.octet_length("set") / 8).cast("long").alias("n"))
    return sizes.join(own, "id", "left").select("id", "n", F.coalesce("own", F.lit(0)).alias("own"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (pivot, id) whose full sets reach the threshold. A pivot's set goes once to each share of its partners."""
    counts = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PIVOT_ROWS).alias("salts"))
    members = pairs.join(counts, "pivot").select("id", "pivot", F.pmod(F.xxhash64("id"), "salts").alias("salt"), F.lit(1).alias("member"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    pivots = counts.select(F.col("pivot").alias("id"), "pivot", salts, F.lit(0).alias("member"))
    joined = sets.join(members.union(pivots), "id").select("id", "pivot", "salt", "member", "set")
    ordered = joined.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "member")
    kind = pairs.schema["id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, []
        for batch in batches:
            a, b = [], []
            for id_, pivot, salt, member, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (pivot, salt):
                    key, own = (pivot, salt), []
                values = np.frombuffer(data, np.uint64)
                if not member:
                    own.append(values)
                elif any(reaches(values, other, percent) for other in own):
                    a.append(pivot)
                    b.append(id_)
            kinds = batch.schema.field("id").type
            yield pa.RecordBatch.from_arrays([pa.array(a, kinds), pa.array(b, kinds)], ["a", "b"])

    return arrow_stream(ordered, compare, f"a {kind}, b {kind}")


MARKS = ("key", "i", "j", "block", "id", "label", "signature", "n", "own", "pivot", "band")


class _Meeting:
    """Members of one bucket that meet in one task: block i with block j, or a block with itself."""

    def __init__(self, key: tuple, rows: list[tuple], percent: int) -> None:
        columns = dict(zip(MARKS[3:], zip(*rows, strict=False), strict=False))
        self.within, self.percent = key[1] == key[2], percent
        self.block, self.ids, self.labels, self.pivots, self.band = (np.array(columns[c]) for c in ("block", "id", "label", "pivot", "band"))
        self.marks = np.frombuffer(b"".join(columns["signature"]), np.uint32).reshape(-1, HASHES)
        self.sizes = np.array(columns["n"], np.int64)
        self.common = self.sizes - np.array(columns["own"], np.int64)

    def partners(self, at: int, labels: np.ndarray) -> np.ndarray:
        """Later members that member ``at`` may reach; ``labels`` tell whose components are the same by now."""
        # Pairs within a block belong to the task of that block alone; pairs with a pivot were tested before.
        later = slice(at + 1, None)
        fresh = (labels[later] != labels[at]) & (self.ids[later] != self.pivots[at]) & (self.pivots[later] != self.ids[at])
        other = np.flatnonzero(fresh) + at + 1
        if not self.within:
            other = other[self.block[other] != self.block[at]]
        most = np.minimum(self.common[other], self.common[at])
        other = other[100 * most >= self.percent * (self.sizes[other] + self.sizes[at] - most)]
        hit = other[may_reach(np.broadcast_to(self.marks[at], (len(other), HASHES)), self.marks[other], self.percent)]
        # A pair that meets in several bands belongs to the first of them.
        agree = (self.marks[hit].reshape(-1, BANDS, ROWS) == self.marks[at].reshape(BANDS, ROWS)).all(axis=2)
        return hit[agree.argmax(axis=1) == self.band[at]]

    def asked(self) -> np.ndarray:
        """Members with a partner that they may reach."""
        wanted = np.zeros(len(self.ids), bool)
        if len(set(self.labels.tolist())) > 1:
            for at in range(len(self.ids) - 1):
                hit = self.partners(at, self.labels)
                wanted[hit] = True
                wanted[at] |= len(hit) > 0
        return np.flatnonzero(wanted)

    def links(self, sets: list[bytes]) -> list[tuple]:
        """Verified pairs that join components; a pair whose members were joined here before adds nothing."""
        labels, found = np.unique(self.labels, return_inverse=True)[1], []
        values = [np.frombuffer(data, np.uint64) for data in sets]
        for at in range(len(self.ids) - 1):
            for other in self.partners(at, labels):
                if labels[at] != labels[other] and reaches(values[at], values[other], self.percent):
                    labels[labels == labels[other]] = labels[at]
                    found.append((self.ids[at], self.ids[other]))
        return found


def _grouped(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of one (key, i, j) after another, without these three columns."""
    key, group = None, []
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in names), strict=True):
            if key != row[:3]:
                if group:
                    yield key, group
                key, group = row[:3], []
            group.append(row[3:])
    if group:
        yield key, group


def _cross_links(shared: DataFrame, labels: DataFrame, known: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links (a, b) between components, enough to join all that a pair of one bucket joins; none where no pair can reach the threshold.

    Blocks of a bucket meet pairwise in tasks of their own. Shingles that no other set has cannot be shared, which bounds the similarity of a
    pair exactly; what the bound lets through takes the signature test. Pairs never leave their task: a first pass names the members with a
    partner, the second gets the full sets of these, verifies in place and gives at most one link per member. ``known`` has signature, n, own
    and the pivot that an id was tested against.
    """
    rows = shared.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).join(known.select("id", "n"), "id")
    ends = F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles")
    mixed = rows.groupBy("key").agg(*ends).where("low <> high")
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK, F.col("shingles") / BLOCK_SHINGLES))
    rows = rows.drop("n").join(mixed, "key").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.withColumn("other", meets).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    rows = rows.select("key", "i", "j", "band", "block", "id", "label").join(known, "id").select(*MARKS)
    kind = shared.schema["id"].dataType.simpleString()

    def ordered(df: DataFrame) -> DataFrame:
        return df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "block", "id")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in _grouped(batches, MARKS):
            meeting = _Meeting(key, group, percent)
            wanted = [group[at] for at in meeting.asked()]
            if wanted:
                ids = pa.array([row[1] for row in wanted])
                columns = [*(pa.repeat(pa.scalar(k, pa.int64()), len(wanted)) for k in key), pa.array([row[0] for row in wanted], pa.int64()), ids]
                columns += [pa.array([row[2] for row in wanted], ids.type), pa.array([row[-1] for row in wanted], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "i", "j", "block", "id", "label", "band"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in _grouped(batches, (*MARKS, "set")):
            found = _Meeting(key, [row[:-1] for row in group], percent).links([row[-1] for row in group])
            if found:
                ids = [pa.array([pair[n] for pair in found]) for n in (0, 1)]
                yield pa.RecordBatch.from_arrays(ids, ["a", "b"])

    asked = arrow_stream(ordered(rows), ask, f"key long, i long, j long, block long, id {kind}, label {kind}, band int")
    asked = store(asked)
    release(shared.sparkSession)
    if asked.isEmpty():
        return None
    return arrow_stream(ordered(asked.join(known, "id").join(sets, "id").select(*MARKS, "set")), verify, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, *, percent: int = 85, size: int = SHINGLE) -> DataFrame:
    """Rows doc_id, n_shingles, component_id, kept for every row of ``docs``; linked are sets with at least ``percent`` % in common."""
    spark = docs.sparkSession
    sketched = store(sketches(docs, size))
    used = sketched.where("doc_id is not null and n_shingles > 0")
    classes = store(used.groupBy("digest").agg(F.min("doc_id").alias("id")))
    heads = classes.select("digest", F.col("id").alias("doc_id"))
    signatures = used.join(heads, ["doc_id", "digest"], "left_semi").select(F.col("doc_id").alias("id"), "signature").dropDuplicates()
    width = 4 * ROWS
    keys = [F.xxhash64(F.substring("signature", 1 + i * width, width), F.lit(i)) for i in range(BANDS)]
    buckets = signatures.select("id", F.posexplode(F.array(*keys)).alias("band", "key"))
    crowded = buckets.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("key")
    shared = store(buckets.join(crowded, "key").select("key", "band", "id"))
    sets = saved_table(_full_sets(docs, shared.select("id").distinct(), size))
    release(spark)
    known = store(_own_shingles(sets).join(signatures, "id"))
    passes = _let_through(spark, percent)
    # The pivot of a bucket is its least peculiar member: an original is nearer to its edited copies than they are to each other.
    weighed = shared.join(known.select("id", "own"), "id")
    pivots = weighed.groupBy("key").agg(F.min(F.struct("own", "id")).alias("pivot"))
    stars = weighed.join(pivots, "key").groupBy("id").agg(F.min("pivot").alias("pivot")).select(F.col("pivot.id").alias("pivot"), "id")
    stars = store(stars.where("pivot <> id"))
    del weighed, pivots
    release(spark)
    own = known.select("id", F.col("signature").alias("own_signature"))
    head = known.select(F.col("id").alias("pivot"), F.col("signature").alias("head_signature"))
    tested = stars.join(own, "id").join(head, "pivot").where(passes("own_signature", "head_signature")).select("pivot", "id")
    links = store(_verified(tested, sets, percent))
    labels = store(components(links))
    del tested
    release(spark)
    # Pairs of one component need no test; star pairs that failed theirs fail again, so they are left out.
    pivot = F.coalesce("pivot", "id").alias("pivot")
    more = _cross_links(shared, labels, known.join(stars, "id", "left").select("id", "signature", "n", "own", pivot), sets, percent)
    if more is not None:
        labels = store(components(store(links.union(more))))
        release(spark)
    found = classes.join(labels, "id", "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    out = sketched.select("doc_id", "n_shingles", "digest").join(found, "digest", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", component)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
