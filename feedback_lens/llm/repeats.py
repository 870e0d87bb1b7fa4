"""Removal of repeated byte strings with suffix arrays.

A byte goes when a string of ``WINDOW`` bytes covers it that also starts earlier: in a document with a smaller id, or earlier in the same
one. Strings never cross documents, overlaps count, and all strings are judged on the input.

Shards. Every window has an anchor: the gram of ``GRAM`` bytes with the least hash in it, the leftmost of equals. Equal windows have
equal anchors at the same place, so windows are shared out by their anchor's hash and every pair of equal windows meets. The windows of one
anchor are consecutive; their text is one short context of fewer than 2 * WINDOW bytes. Only anchors that occur in two different
places matter (exact copies of a document are one place; all but the first go whole). Equal contexts are one after partial aggregation: all
but the first are repeats. Different contexts of one anchor go to the shard's suffix array (``suffixes.Shard``): neighbours with a common
prefix of WINDOW bytes or more are equal windows, of which all but the first are repeats.

Null is the empty text. Ids are meant to be unique: rows that share id and text are one document; those that share only the id are in
order of their strings' starts. A null id comes last. Empty tables give empty results. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_lens.llm.common import arrow_column, arrow_map, arrow_stream, discard, mix, release, saved_table
from feedback_lens.llm.suffixes import Shard

WINDOW = 100
GRAM = 32
SHARD_BYTES = 8 << 20
SORT_MEMORY = 128 << 20
PART = 8 << 20  # a longer text is searched for anchors in overlapping parts
LAST = (1 << 63) - 1


def _anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor, with the first and last start of its windows."""
    with np.errstate(over="ignore"):
        b = data.astype(np.uint64)
        two = b[:-1] << np.uint64(8) | b[1:]
        four = two[:-2] << np.uint64(16) | two[2:]
        eight = four[:-4] << np.uint64(32) | four[4:]
        n = len(data) - GRAM + 1
        hashes = np.zeros(n, np.uint64)
        for k in range(0, GRAM, 8):
            hashes = (hashes ^ hashes >> np.uint64(29)) + eight[k : k + n]
            hashes *= np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(32)
    least = hashes & ~np.uint64(0xFFFFFF) | np.arange(n, dtype=np.uint64)
    width, step = WINDOW - GRAM + 1, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    rest = width - step
    least = np.minimum(least[: len(least) - rest], least[rest:])
    places = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    return mix(hashes[places[first]]), first, np.append(first[1:], len(places)) - 1


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a whole text; one that lies across two parts is given once for each."""
    line = np.frombuffer(data, np.uint8)
    found = []
    for start in range(0, len(line) - WINDOW + 1, PART):
        hashes, first, last = _anchors(line[start : start + PART + WINDOW - 1])
        found.append((hashes, first + start, last + start))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _place(start, tag, span):
    """Start, text tag and number of further windows of a context in one number."""
    return (start << 24) + (tag << 8) + span


def _anchor_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows, hashes, places = [], [], []
    for row, (text, tag) in enumerate(zip(batch["text"].to_pylist(), batch["tag"].to_pylist(), strict=True)):
        h, first, last = anchors((text or "").encode())
        rows.append(np.full(len(h), row))
        hashes.append(h.view(np.int64))
        places.append(_place(first, tag, last - first))
    at = pa.array(np.concatenate([*rows, np.empty(0)]).astype(np.int64))
    columns = [pa.array(np.concatenate([*c, np.empty(0, np.int64)])) for c in (hashes, places)]
    return pa.RecordBatch.from_arrays([batch["id"].take(at), *columns], ["id", "anchor", "place"])


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Context of every hit with its hash; its bytes only where the task has not sent them yet."""
    sent: set[tuple[int, int]] = set()
    for batch in batches:
        rows, anchor_, context, place_, data_ = [], [], [], [], []
        for row, (text, hits) in enumerate(zip(batch["text"].to_pylist(), batch["hits"].to_pylist(), strict=True)):
            data = (text or "").encode()
            for hit in hits:
                anchor, place = hit["anchor"], hit["place"]
                start = place >> 24
                part = data[start : start + (place & 0xFF) + WINDOW]
                value = int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little", signed=True)
                new = (anchor, value) not in sent
                if new:
                    sent.add((anchor, value))
                rows.append(row)
                anchor_.append(anchor)
                context.append(value)
                place_.append(place)
                data_.append(part if new else None)
            if len(sent) > 500_000:
                sent.clear()
        columns = [pa.array(c, t) for c, t in ((anchor_, pa.int64()), (context, pa.int64()), (place_, pa.int64()), (data_, pa.binary()))]
        yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(rows, pa.int64())), *columns], ["id", "anchor", "context", "place", "data"])


def _repeated_windows(strings: list[bytes], owners: list[tuple[int, int]], window: int) -> Iterator[tuple[int, int, int]]:
    """For different contexts of common anchors: (context, first, behind the last) of bytes that a repeated window covers.

    ``owners`` holds document and place of each context's first occurrence.
    """
    shard = Shard(window, SORT_MEMORY)
    try:
        begins = np.concatenate([shard.add(strings[i : i + 4096]) for i in range(0, len(strings), 4096)])
        lengths = np.array([len(s) for s in strings])
        docs, starts = np.array([o[0] for o in owners], np.int64), np.array([o[1] >> 24 for o in owners], np.int64)
        marks = np.zeros(shard.size + 1, np.int8)
        for positions, shared in shard.sorted():
            of = np.searchsorted(begins, positions, side="right") - 1
            inside = positions - begins[of]
            groups = np.cumsum(shared < window)
            whole = np.flatnonzero((of >= 0) & (lengths[of] - inside >= window))
            if not len(whole):
                continue
            groups, of, inside, positions = groups[whole], of[whole], inside[whole], positions[whole]
            order = np.lexsort((starts[of] + inside, docs[of], groups))
            repeated = order[1:][groups[order][1:] == groups[order][:-1]]
            marks[positions[repeated]] = 1
    finally:
        shard.close()
    edges = np.diff(np.concatenate([[0], marks, [0]]))
    for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
        k = int(np.searchsorted(begins, a, side="right")) - 1
        yield k, a - int(begins[k]), b - 1 - int(begins[k]) + window


def _sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by anchor and context: bytes from some tasks, and the first occurrence. Whole anchors are sorted together."""
    strings: list[bytes] = []
    owners: list[tuple[int, int]] = []
    size, key, data, owner = 0, None, None, None

    def solved() -> pa.RecordBatch:
        found = []
        for k, a, b in _repeated_windows(strings, owners, WINDOW) if strings else ():
            id_, place = owners[k]
            found.append((id_, place >> 8 & 0xFFFF, (place >> 24) + a << 32 | (place >> 24) + b))
        strings.clear()
        owners.clear()
        columns = list(zip(*found, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "tag", "span"])

    for batch in batches:
        for anchor, context, id_, place, bytes_ in zip(*(batch[n].to_pylist() for n in ("anchor", "context", "id", "place", "data")), strict=True):
            if key != (anchor, context):
                if key is not None:
                    strings.append(data)
                    owners.append(owner)
                    size += len(data)
                    if size >= SHARD_BYTES and key[0] != anchor:
                        yield solved()
                        size = 0
                key, data, owner = (anchor, context), None, None
            if bytes_ is not None:
                data = bytes_
            else:
                owner = (id_, place)
    if key is not None:
        strings.append(data)
        owners.append(owner)
    yield solved()


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows id, tag, text; the tag tells texts apart that share an id."""
    tag = F.coalesce(F.xxhash64("text").bitwiseAND(0xFFFF), F.lit(0))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), tag.alias("tag"), "text")


def _copies(texts: DataFrame) -> DataFrame:
    """Rows id, tag of documents that equal an earlier one."""
    long = texts.where(F.octet_length("text") >= WINDOW).select("id", "tag", F.sha2("text", 256).alias("digest"))
    heads = long.groupBy("digest").agg(F.min("id").alias("head"))
    return saved_table(long.join(heads, "digest").where("id <> head").select("id", "tag").distinct())


def _hits(texts: DataFrame, copies: DataFrame) -> DataFrame:
    """Rows id, tag, hits: for each document the anchors that occur elsewhere too (at most one per few bytes of its text)."""
    found = saved_table(arrow_map(texts, _anchor_rows, "id long, anchor long, place long"))
    common = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    tag = F.shiftright("place", 8).bitwiseAND(0xFFFF).alias("tag")
    hits = found.join(common.hint("shuffle_hash"), "anchor").select("id", tag, "anchor", "place").join(copies, ["id", "tag"], "left_anti")
    hits = saved_table(hits.groupBy("id", "tag").agg(F.collect_set(F.struct("anchor", "place")).alias("hits")))
    discard(found)
    return hits


def _contexts(texts: DataFrame, copies: DataFrame) -> DataFrame:
    hits = _hits(texts, copies)
    release(texts.sparkSession)
    joined = texts.join(hits, ["id", "tag"]).select("id", "text", "hits")
    contexts = saved_table(arrow_stream(joined, _cut_contexts, "id long, anchor long, context long, place long, data binary"))
    discard(hits)
    return contexts


def _repeated(contexts: DataFrame) -> DataFrame:
    """Rows id, tag, span: bytes that go, as first << 32 | behind the last; spans may overlap."""
    own = F.struct("id", "place")
    firsts = contexts.groupBy("anchor", "context").agg(F.min(own).alias("first"))
    mixed = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    bytes_ = contexts.where("data is not null").select("anchor", "context", "id", "place", "data")
    owners = firsts.select("anchor", "context", "first.id", "first.place", F.lit(None).cast("binary").alias("data"))
    shards = bytes_.union(owners).join(mixed, "anchor").repartition("anchor").sortWithinPartitions("anchor", "context")
    different = arrow_stream(shards.select("anchor", "context", "id", "place", "data"), _sort_shards, "id long, tag long, span long")
    later = contexts.drop("data").join(firsts, ["anchor", "context"]).where(own != F.col("first"))
    start = F.shiftright("place", 24)
    span = F.shiftleft(start, 32) + start + F.col("place").bitwiseAND(0xFF) + WINDOW
    equal = later.select("id", F.shiftright("place", 8).bitwiseAND(0xFFFF).alias("tag"), span.alias("span"))
    return different.union(equal)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Rows id, tag, spans (as in ``_repeated``), whole (all of the document goes) for documents that lose bytes.

    Phases end in saved tables, so that the shuffle files of one can go before the next one writes its own.
    """
    texts = _keyed(docs)
    copies = _copies(texts)
    contexts = _contexts(texts, copies)
    release(docs.sparkSession)
    lists = _repeated(contexts).groupBy("id", "tag").agg(F.collect_list("span").alias("spans"))
    marks = lists.join(copies.withColumn("whole", F.lit(True)), ["id", "tag"], "full_outer")
    marks = saved_table(marks.select("id", "tag", "spans", F.coalesce("whole", F.lit(False)).alias("whole")))
    discard(contexts)
    del lists, contexts
    release(docs.sparkSession)
    return marks


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__repeats_spans`` (packed, may overlap) and ``__repeats_whole``."""
    marks = repeated_spans(docs).withColumnsRenamed({name: f"__repeats_{name}" for name in ("id", "tag", "spans", "whole")})
    tag = F.coalesce(F.xxhash64("text").bitwiseAND(0xFFFF), F.lit(0))
    key = (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)) == F.col("__repeats_id")) & (tag == F.col("__repeats_tag"))
    return docs.join(marks, key, "left").drop("__repeats_id", "__repeats_tag")


def _kept(text: str | None, spans: list[int] | None, whole: bool | None) -> tuple[bytes, list[tuple[int, int]], bytes]:
    data = (text or "").encode()
    runs = [(0, len(data))] if whole else merged_spans([(s >> 32, s & 0xFFFFFFFF) for s in spans or []])
    cuts = [0, *(x for run in runs for x in run), len(data)]
    return data, runs, b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Rows doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``spans`` of removed bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, spans, whole in zip(*(batch[n].to_pylist() for n in ("text", "__repeats_spans", "__repeats_whole")), strict=True):
            data, runs, kept = _kept(text, spans, whole)
            rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), [list(r) for r in runs]))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    return arrow_map(_with_spans(docs.select("doc_id", "text")), digest, schema)


def kept_text(spark) -> Callable:
    """Column of what is left of a text; characters cut in half go with the bytes removed."""

    def cut(rows: pa.Array) -> pa.Array:
        values = zip(*(c.to_pylist() for c in rows.flatten()), strict=True)
        return pa.array([None if t is None else _kept(t, s, w)[2].decode(errors="ignore") for t, s, w in values], pa.string())

    return arrow_column(spark, cut, "string")


def texts_without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``; other columns stay."""
    cut = kept_text(docs.sparkSession)
    rest = cut(F.struct("text", "__repeats_spans", "__repeats_whole"))
    return _with_spans(docs).withColumn("text", rest).select(*docs.columns)
