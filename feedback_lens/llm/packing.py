"""Best-fit packing by length-histogram planning.

Documents become token pieces; only the number of pieces of each length reaches the driver (at most ``capacity`` rows). The driver
plans best fit decreasing over these counts: all bins with the same free space and the same length to place are handled in one step,
so the plan has a few runs per length, however many documents there are. Pieces then take their planned slots by joining on their
rank within their length.

Nulls and empty texts give the end token alone; repeated rows are packed once each; an empty table gives an empty result; only the
id and text columns are read, so other columns of any name are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedback_lens.llm.common import Remembered, arrow_map, remembers, store

ROWS_PER_SALT = 2048
_ENCODERS: dict[str, ChunkEncoder] = {}
remembers(__name__, _ENCODERS.clear)


class ChunkEncoder:
    """Token ids of texts by the ``tokenizers`` library, remembered for each run of characters between white space.

    A tokenizer whose pre-tokenizer drops white space never merges across it, so the ids of a text are the ids of its runs in order.
    Runs of plain letters with plain punctuation behind are known to be lower-cased and split there, so their word goes straight to the
    library's model; every other run takes the library's whole path.
    """

    plain = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)")

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        visible = set(ByteLevel.alphabet())
        hidden = iter(range(256, 512))
        self.letters = {b: chr(b) if chr(b) in visible else chr(next(hidden)) for b in range(256)}  # the library's byte alphabet
        self.runs, self.words = Remembered(self._code_runs), Remembered(self._code_words)
        self.tails: dict[str, bytes] = {}

    @staticmethod
    def of(path: str) -> ChunkEncoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = ChunkEncoder(path)
        return _ENCODERS[path]

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return b"".join(self.runs(text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))

    def _whole(self, runs: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)
        return [b"".join(i.to_bytes(4, "little") for i in c.ids) for c in coded]

    def _code_words(self, words: list[str]) -> list[bytes]:
        tokenize, letters = self.tokenizer.model.tokenize, self.letters
        rows = (tokenize(word.encode().decode("latin-1").translate(letters)) for word in words)
        return [b"".join(token.id.to_bytes(4, "little") for token in row) for row in rows]

    def _code_runs(self, runs: list[str]) -> list[bytes]:
        out, matches = dict.fromkeys(runs, b""), {run: m for run in runs if (m := self.plain.fullmatch(run))}
        other = [run for run in runs if run and run not in matches]
        out.update(zip(other, self._whole(other), strict=True))
        for tail in {m[2] for m in matches.values()} - self.tails.keys():
            self.tails[tail] = self._whole([tail])[0]
        words = self.words([m[1].lower() for m in matches.values()])
        out.update((run, word + self.tails[m[2]]) for (run, m), word in zip(matches.items(), words, strict=True))
        if len(self.tails) > 10_000:
            self.tails.clear()
        return list(out.values())


def token_pieces(
    docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32: every document as pieces of at most ``capacity`` tokens, its end token included."""
    kind = docs.schema[id_column].dataType.simpleString()
    end, width = end_id.to_bytes(4, "little"), 4 * capacity

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = ChunkEncoder.of(tokenizer)
        rows, pieces, starts, lengths, sums = [], [], [], [], []
        for row, text in enumerate(batch.column(1).to_pylist()):
            ids = encode(text or "") + end
            for piece, at in enumerate(range(0, len(ids), width)):
                part = ids[at : at + width]
                rows.append(row)
                pieces.append(piece)
                starts.append(at // 4)
                lengths.append(len(part) // 4)
                sums.append(zlib.crc32(part))
        columns = [pa.array(pieces, pa.int32()), *(pa.array(c, pa.int64()) for c in (starts, lengths, sums))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), *columns], ["doc_id", "piece", "start", "length", "ids_crc32"]
        )

    source = docs.select(F.col(id_column), F.col(text_column))
    return arrow_map(source, cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def plan_counts(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts. Runs: length, first rank, ranks, pieces per sequence, first sequence, offset.

    ``open_bins`` holds ranges of sequences by free space. A piece goes to the smallest free space that takes it; what is left of that
    space is smaller still, so the next pieces of the same length follow into the same sequence for as long as they fit.
    """
    runs: list[tuple[int, int, int, int, int, int]] = []
    open_bins: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []
    sequences = 0

    def put(space: int, first: int, number: int) -> None:
        if space and number:
            if space not in open_bins:
                bisect.insort(spaces, space)
                open_bins[space] = []
            open_bins[space].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, number = open_bins[space].pop()
                if not open_bins[space]:
                    del open_bins[space], spaces[at]
            else:
                space, first = capacity, sequences
                number = -(-left // (capacity // length))
                sequences += number
            each = min(space // length, left)
            filled = min(number, left // each)
            runs.append((length, rank, filled * each, each, first, capacity - space))
            put(space, first + filled, number - filled)
            put(space - each * length, first, filled)
            rank, left = rank + filled * each, left - filled * each
    return runs


def ranked(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds ``rank`` from 0 within each length. Frequent lengths are dealt over salts, which are ranked on their own and offset."""
    salted = pieces.join(F.broadcast(counts), "length").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece"), F.ceil(F.col("n") / ROWS_PER_SALT))
    )
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        salted.groupBy("length", "salt")
        .agg(F.count(F.lit(1)).alias("in_salt"))
        .withColumn("base", F.coalesce(F.sum("in_salt").over(before), F.lit(0)))
        .drop("in_salt")
    )
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return (
        salted.drop("n")
        .withColumn("inside", F.row_number().over(inside) - 1)
        .join(bases, ["length", "salt"])
        .withColumn("rank", F.col("base") + F.col("inside"))
        .drop("salt", "base", "inside")
    )


def pack_pieces(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {row["length"]: row["n"] for row in counts.collect()}  # at most `capacity` rows
    small = spark.createDataFrame(list(histogram.items()), "length long, n long")
    plan = spark.createDataFrame(
        plan_counts(histogram, capacity), "length long, first_rank long, ranks long, each long, first_sequence long, base long"
    )
    within = F.col("rank") - F.col("first_rank")
    return (
        ranked(pieces, small)
        .join(F.broadcast(plan), "length")  # a few runs for each of at most `capacity` lengths
        .where((within >= 0) & (within < F.col("ranks")))
        .withColumn("sequence_id", F.col("first_sequence") + F.floor(within / F.col("each")).cast("long"))
        .withColumn("offset", F.col("base") + (within % F.col("each")) * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 1, save: Callable[[DataFrame], DataFrame] = store) -> DataFrame:
    """All documents as pieces in sequences of at most ``capacity`` tokens. The pieces (no ids, no texts) are saved once before planning."""
    return pack_pieces(save(token_pieces(docs, tokenizer, capacity=capacity, end_id=end_id)), capacity)
