"""Language-model scores by prediction by partial matching over bytes, beside a unigram base.

The model is a trie of byte contexts up to ``ORDER`` bytes, kept as a table with one row for each context and following byte. A text starts
in a context of start marks and ends with an end mark (bytes that UTF-8 never has). A byte is predicted in its longest context; a byte
that was not seen there escapes to the next shorter one, where all bytes seen in the longer context are excluded. Escape estimation
is method D: with T occurrences of d different bytes in a context, a byte seen c times has (2c - 1) / 2T, the escape d / 2T, both over
what is not excluded. Below the empty context all bytes not seen yet are alike. For a trained trie each of these is a fixed number for a
context with its byte, so the code length of every run of ``ORDER + 1`` bytes is worked out once.

Documents are dealt into blocks of about ``BLOCK_BYTES``. A block counts its different words and byte runs; the counts of all blocks are
added up, turned into code lengths, and sent back to the blocks that asked for them, where the texts are scored. So what moves is
the different keys of each block, never a row per byte, and no table is broadcast but the two shortest orders (at most 65,792 rows).
A task holds the keys of one block, or the runs of about ``CONTEXT_KEYS`` keys or one context of two bytes, whichever is more.

Words are compared by 64-bit hashes. Null is the empty text. Without training documents all bytes are alike and all counts 0. Rows with
the same id are scored each by itself; a null id is learned from. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_lens.llm.common import Lookup, arrow_stream, ascii_words, bounded_batches, counted, merged, saved_table, store, word_hashes

ORDER = 5
START, END = 0xFE, 0xFF
BLOCK_BYTES = 32 << 20
PART_BYTES = 2 << 20
MERGE_KEYS = 2_000_000
CONTEXT_KEYS = 500_000
WORD, RUN = 0, 1
#: The end token among words: the hash of no letters.
STOP = b""


def byte_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ORDER + 1 bytes packed into integers, the predicted byte lowest, and the number of predictions of each text."""
    data = [text.encode() for text in texts]
    lead, tail = bytes([START]) * ORDER, bytes([END])
    line = np.frombuffer(b"".join(lead + part + tail for part in data), np.uint8).astype(np.uint64)
    lengths = np.array([len(part) + 1 for part in data], np.int64)
    codes = np.zeros(max(0, len(line) - ORDER), np.uint64)
    for i in range(ORDER + 1):
        codes = (codes << np.uint64(8)) | line[i : i + len(codes)]
    # A text takes ORDER places for its start marks, whose runs belong to two texts.
    firsts = np.cumsum(lengths + ORDER) - (lengths + ORDER)
    keep = np.ones(len(codes), bool)
    for i in range(1, ORDER + 1):
        spots = firsts[1:] - i
        keep[spots[spots >= 0]] = False
    return codes[keep], lengths


def _words(text: str) -> np.ndarray:
    return word_hashes([*ascii_words(text), STOP])


def _parts(texts: list[str], most: int) -> Iterator[list[int]]:
    """Rows in groups of about ``most`` characters."""
    rows, size = [], 0
    for row, text in enumerate(texts):
        rows.append(row)
        size += len(text)
        if size >= most:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different words and byte runs of each block with their training counts, from texts in the order of blocks."""
    now, found = None, {RUN: ([], []), WORD: ([], [])}

    def add(kind: int, values: np.ndarray, learn: bool) -> None:
        keys, counts = found[kind]
        distinct, amounts = counted(values)
        keys.append(distinct)
        counts.append(amounts if learn else np.zeros_like(amounts))
        if sum(map(len, keys)) > MERGE_KEYS + 2 * len(keys[0]) and len(keys) > 1:
            one, total = merged(keys, counts)
            keys[:], counts[:] = [one], [total]

    def finished() -> Iterator[pa.RecordBatch]:
        for kind, lists in found.items():
            keys, counts = merged(*lists)
            for held in lists:
                held.clear()
            for start in range(0, len(keys), 1 << 18):
                part = slice(start, start + (1 << 18))
                n = len(keys[part])
                columns = [pa.array(np.full(n, now, np.int32)), pa.array(np.full(n, kind, np.int32)), pa.array(keys[part].view(np.int64)), pa.array(counts[part])]
                yield pa.RecordBatch.from_arrays(columns, ["block", "kind", "key", "n"])

    for batch in batches:
        groups: dict[tuple[int, bool], list[str]] = {}
        for block, learn, text in zip(*(batch[n].to_pylist() for n in ("block", "learn", "text")), strict=True):
            groups.setdefault((block, learn), []).append(text)
        for (block, learn), texts in groups.items():
            if block != now:
                yield from finished()
                now = block
            for rows in _parts(texts, PART_BYTES):
                add(RUN, byte_runs([texts[r] for r in rows])[0], learn)
                add(WORD, np.concatenate([_words(texts[r]) for r in rows]), learn)
    yield from finished()


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over equal neighbours of sorted keys, and for every entry the number of its sum."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return np.add.reduceat(values, starts), np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))


def log_probabilities(runs: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of the probability of each run's last byte after the others.

    ``runs`` holds all runs that share their last two context bytes with any of them; ``pairs[a, b]`` counts byte b after byte a in
    all of the training text, which gives the orders 1 and 0.
    """
    runs = runs.astype(np.uint64)
    symbol = (runs & np.uint64(0xFF)).astype(np.int64)
    last = (runs >> np.uint64(8) & np.uint64(0xFF)).astype(np.int64)
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # per run, orders 0, 1, 2, ...: own count, total, different bytes
    singles = pairs.sum(axis=0)
    levels.append((singles[symbol], np.full(len(runs), singles.sum()), np.full(len(runs), (singles > 0).sum())))
    levels.append((pairs[last, symbol], pairs.sum(axis=1)[last], (pairs > 0).sum(axis=1)[last]))
    shadows = {}  # order: per run, what the context's bytes count in the next shorter context
    shadows[1] = ((pairs > 0) * singles[None, :]).sum(axis=1)[last]
    for order in range(2, ORDER + 1):
        key = runs & np.uint64((1 << 8 * (order + 1)) - 1)
        by = np.argsort(key, kind="stable")
        total, place = _sums(key[by], counts[by])
        first = np.flatnonzero(np.concatenate([[True], np.diff(place) > 0]))
        context = key[by][first] >> np.uint64(8)
        shorter = levels[order - 1][0][by][first]
        sums, of = _sums(context, total)
        seen, _ = _sums(context, (total > 0).astype(np.int64))
        shadow, _ = _sums(context, np.where(total > 0, shorter, 0))
        back = np.empty(len(by), np.int64)
        back[by] = place
        levels.append((total[back], sums[of][back], seen[of][back]))
        shadows[order] = shadow[of][back]
    out, open_ = np.zeros(len(runs)), np.ones(len(runs), bool)
    gone, kinds = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)  # excluded occurrences and bytes
    for order in range(ORDER, -1, -1):
        own, total, different = levels[order]
        whole = 2 * (total - gone)
        hit = open_ & (own > 0)
        out[hit] += np.log10((2 * own[hit] - 1) / whole[hit])
        escape = open_ & (own == 0) & (different - kinds > 0)
        out[escape] += np.log10((different - kinds)[escape] / whole[escape])
        open_ &= own == 0
        known = total > 0
        kinds = np.where(known, different, 0)
        gone = np.where(known, shadows[order], 0) if order else gone
    out[open_] -= np.log10(256 - kinds[open_])
    return out


def _code_lengths(runs: DataFrame) -> DataFrame:
    """Rows key, value: log10 probabilities of all runs (columns key, n)."""
    pairs = np.zeros((256, 256), np.int64)
    for row in runs.groupBy(F.col("key").bitwiseAND(0xFFFF).alias("pair")).agg(F.sum("n").alias("n")).collect():  # at most 65,536 rows
        pairs[row["pair"] >> 8, row["pair"] & 0xFF] = row["n"]
    shared = runs.sparkSession.sparkContext.broadcast(pairs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        enough = CONTEXT_KEYS

        def solved(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            values = log_probabilities(keys.view(np.uint64), counts, shared.value)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values)], ["key", "value"])

        # Whole contexts at a time: all rows but those of the last context seen, which may go on in the next batch.
        for batch in batches:
            held.append((batch["key"].to_numpy(), batch["n"].to_numpy()))
            if sum(len(keys) for keys, _ in held) < enough:
                continue
            keys, counts = (np.concatenate([part[i] for part in held]) for i in (0, 1))
            contexts = keys >> 8 & 0xFFFF
            upto = int(np.argmax(contexts == contexts[-1]))
            held = [(keys[upto:], counts[upto:])]
            enough = max(CONTEXT_KEYS, 2 * (len(keys) - upto))
            if upto:
                yield solved(keys[:upto], counts[:upto])
        keys, counts = (np.concatenate([np.empty(0, np.int64), *(part[i] for part in held)]) for i in (0, 1))
        if len(keys):
            yield solved(keys, counts)

    context = F.shiftrightunsigned("key", 8).bitwiseAND(0xFFFF)
    ordered = runs.withColumn("context", context).repartition("context").sortWithinPartitions("context")
    return arrow_stream(ordered.select("key", "n"), work, "key long, value double")


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """Rows doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document, learned from those not held out."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), held_out.alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    asked = saved_table(
        arrow_stream(
            rows.select("block", (~F.col("held_out")).alias("learn"), "text").repartition("block").sortWithinPartitions("block"),
            _count_blocks,
            "block int, kind int, key long, n long",
        )
    )
    totals = asked.groupBy("kind", "key").agg(F.sum("n").alias("n"))
    words = totals.where(F.col("kind") == WORD).select("key", "n")
    train = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0))).first()
    lengths = _code_lengths(store(totals.where(F.col("kind") == RUN).select("key", "n")))
    value = words.select(F.lit(WORD).alias("kind"), "key", F.col("n").cast("double").alias("value"))
    answers = value.union(lengths.select(F.lit(RUN).alias("kind"), "key", "value"))
    answered = asked.select("block", "kind", "key").join(answers, ["kind", "key"]).select("block", "kind", "key", "value")
    tokens, different = int(train[0]), int(train[1])
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        kinds, keys, values = (known[n].to_numpy() for n in ("kind", "key", "value"))
        tables = {k: Lookup(keys[kinds == k].view(np.uint64), values[kinds == k]) for k in (WORD, RUN)}
        out = []
        for batch in texts.to_batches(max_chunksize=2048):
            lines = batch["text"].to_pylist()
            for at in _parts(lines, PART_BYTES):
                codes, lengths_ = byte_runs([lines[r] for r in at])
                byte_scores = np.add.reduceat(tables[RUN](codes), np.cumsum(lengths_) - lengths_)
                for r, whole in zip(at, byte_scores, strict=True):
                    seen = tables[WORD](_words(lines[r]))
                    base = float(np.log10(seen + 1).sum() - len(seen) * np.log10(tokens + different + 1))
                    out.append((len(seen), int((seen > 0).sum()), tokens, base, float(whole)))
        tables.clear()
        pa.default_memory_pool().release_unused()
        columns = list(zip(*out, strict=True)) or [()] * 5
        types = [pa.int64()] * 3 + [pa.float64()] * 2
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        return pa.table([texts["doc_id"], texts["held_out"], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    bounded_batches(spark)
    return rows.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(score, schema)
