r"""Phrase collocation mining by best-first growth with admissible bounds.

Texts are split at ``[.,;:!?\n-\r]`` into pieces and those at spaces and tabs into words, A-Z in lower case; everything counts per language.
A phrase of two words and more scores by its worst cut into two parts: ``floor(10^6 * a * a / (l * r))`` with the counts of the phrase and
of the parts. A phrase inside a longer candidate that occurs at least half as often gives way to it.

Growth goes from words to pairs to longer phrases. A phrase p that goes on at its end scores at most ``floor(10^6 * f(p) / f(first word))``,
since the whole occurs no more than p, and the part after the first word no less than the whole; by the same token one that goes on at its
front scores at most ``floor(10^6 * f(p) / f(last word))``. Each language has a threshold, first a score that about twice the wanted number
of pairs reach. Only phrases whose two parts can lead to that score, and those around a phrase that has it, are grown and counted. When
enough phrases at or above the threshold survive, no other can come before them and the language is settled, ties with the last one
included. Other languages go on with a threshold that more pairs reach, down to 0, where all phrases are counted.

Which phrases may grow is told to the tasks by bit tables of a fixed size (``FILTER_BITS``). A bit that is set by chance costs a row, no
result: exact counts are joined later by the phrases themselves. Tasks count in bounded blocks of text before the shuffle. Joins on parts
that many phrases share ("the") are salted.

Null text is empty, null language is ``und``. Repeated rows count as often as they come. Very long texts are read in slices. An empty table
gives no rows; other columns are ignored. Ties rank by count, then by phrase in byte order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_lens.llm.common import arrow_stream, saved_table

FILTER_BITS = 1 << 25
#: Bytes of text a task counts together, and bytes of a text that it splits at a time.
BLOCK_BYTES, SLICE_BYTES = 12 << 20, 2 << 20
SALTS = 16
#: Pairs whose score sets the first threshold, per phrase wanted; further thresholds take this many times as many.
GUESS, FURTHER = 2, 8
SCALE = 1_000_000
COUNTS = "lang string, phrase string, n long"
SHOWN = ["lang", "phrase", "a", "l", "r", "score"]

ENDS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(ENDS + bytes(range(65, 91)), b"." * len(ENDS) + bytes(range(97, 123)))


def split_words(text: bytes) -> list[bytes]:
    """Words, and a full stop wherever a piece ends."""
    return text.translate(TABLE).replace(b".", b" . ").split()


def slices(text: str) -> Iterator[bytes]:
    """A long text in parts that end between words."""
    at, data = 0, text.encode("utf-8", "surrogatepass")
    while len(data) - at > SLICE_BYTES:
        cut = max(data.rfind(b" ", at, at + SLICE_BYTES), data.rfind(b"\n", at, at + SLICE_BYTES), data.rfind(b".", at, at + SLICE_BYTES))
        if cut < at:
            cut = min((c for c in (data.find(b" ", at), data.find(b"\n", at), data.find(b".", at)) if c >= 0), default=len(data) - 1)
        yield data[at : cut + 1]
        at = cut + 1
    yield data[at:]


class Numbered(dict):
    """Words in order of their appearance; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def spread(hashes: np.ndarray, place: int) -> np.ndarray:
    """Hashes of words at a place of the phrase: turned left by 11 bits a place, as ``bit_of`` does."""
    turn = np.uint64(11 * place % 64)
    return (hashes << turn) | (hashes >> ((np.uint64(64) - turn) % np.uint64(64))) if turn else hashes


def bit_of(phrase: Column, lang: Column) -> Column:
    """Place of a phrase in the bit tables."""

    def turned(word: Column, place: Column) -> Column:
        n = (place * 11 % 64).cast("int")
        h = F.xxhash64(word)
        return F.when(n == 0, h).otherwise(F.call_function("shiftleft", h, n).bitwiseOR(F.call_function("shiftrightunsigned", h, 64 - n)))

    words = F.transform(F.split(phrase, " "), turned)
    return F.aggregate(words, F.xxhash64(lang), lambda acc, h: acc.bitwiseXOR(h)).bitwiseAND(F.lit(FILTER_BITS - 1))


@dataclass
class Filters:
    """Bit tables of words or phrases that may grow: frequent ones, and where they may grow to."""

    frequent: np.ndarray
    wanted: np.ndarray | None = None  # scores that reach the threshold: everything around them counts
    forward: np.ndarray | None = None  # may reach it by going on at the end
    backward: np.ndarray | None = None  # or at the front


def _has(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0


def _bit_table(phrases: DataFrame) -> np.ndarray:
    """Bits of ``(lang, phrase)`` rows, put together in the cluster; the driver sees FILTER_BITS at most."""
    place = phrases.select((bit_of(F.col("phrase"), F.col("lang")) + 1).alias("p"))
    parts = place.groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits"))
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in parts.collect():
        at = (row["bucket"] - 1) * 4096
        table[at : at + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return table


class Block:
    """Words of some texts by language, and the phrases of one length that count."""

    def __init__(self, longest: int):
        import xxhash

        self.hash, self.longest = xxhash.xxh64_intdigest, longest
        self.words, self.texts, self.size = Numbered(), {}, 0

    def add(self, lang: str, text: str) -> None:
        numbers = self.texts.setdefault(lang, [])
        for part in slices(text):
            words = split_words(part)
            numbers.append(np.fromiter(map(self.words.__getitem__, words), np.int32, len(words)))
            self.size += len(part)
        numbers.append(np.zeros(1, np.int32))

    def counts(self, size: int, filters: Filters | None) -> Iterator[pa.RecordBatch]:
        names = list(self.words)
        listed = pa.array(names, pa.binary()).cast(pa.string(), safe=False)
        if filters is not None:
            hashes = np.fromiter((self.hash(name, 42) for name in names), np.uint64, len(names))
        for lang, parts in self.texts.items():
            numbers = np.concatenate(parts)
            if filters is None:
                yield from self._words(lang, numbers, listed)
            else:
                yield from self._phrases(lang, numbers, listed, hashes, size, filters)

    def _words(self, lang: str, numbers: np.ndarray, listed: pa.Array) -> Iterator[pa.RecordBatch]:
        """Counts of words, and under a null phrase that of all."""
        found = np.bincount(numbers, minlength=len(listed))
        found[0] = 0
        seen = np.flatnonzero(found)
        phrases = pa.concat_arrays([pa.nulls(1, pa.string()), listed.take(pa.array(seen))])
        yield self._rows(lang, phrases, np.concatenate([[found.sum()], found[seen]]))

    def _phrases(self, lang, numbers, listed, hashes, size: int, filters: Filters) -> Iterator[pa.RecordBatch]:
        n = len(numbers) - size + 1
        if n <= 0:
            return
        mask = np.uint64(8 * len(filters.frequent) - 1)
        start = np.uint64(self.hash(lang.encode(), 42))
        if size == 2:
            may = np.zeros(len(hashes), bool)
            seen = np.flatnonzero(np.bincount(numbers, minlength=len(hashes)))
            may[seen] = _has(filters.frequent, ((hashes[seen] ^ start) & mask).astype(np.int64))
            may[0] = False
            at = np.flatnonzero(may[numbers[:-1]] & may[numbers[1:]])
        else:
            at = self._grown(numbers, hashes, start, mask, size, filters)
        if not len(at):
            return
        code, shorter = numbers[at].astype(np.int64), []
        for place in range(1, size):  # pairs, then numbers of pairs with the next word, and so on
            if place > 1:
                known, code = np.unique(code, return_inverse=True)
                shorter.append(known)
            code = code << 32 | numbers[at + place]
        del at
        code, found = np.unique(code, return_counts=True)
        for low in range(0, len(code), 1 << 17):
            part, words = code[low : low + (1 << 17)], []
            for known in reversed([None, *shorter]):
                words.append(listed.take(pa.array(part & 0xFFFFFFFF)))
                part = part >> 32
                part = known[part] if known is not None else part
            words.append(listed.take(pa.array(part)))
            yield self._rows(lang, pc.binary_join_element_wise(*reversed(words), " "), found[low : low + (1 << 17)])

    def _grown(self, numbers, hashes, start, mask, size: int, filters: Filters) -> np.ndarray:
        """Places where a phrase of ``size`` words may count, by its two parts of one word less."""
        n = len(numbers) - size + 1
        inside = np.ones(n, bool)
        for place in range(size):
            inside &= numbers[place : place + n] > 0
        at = np.flatnonzero(inside)
        chosen = []
        for low in range(0, len(at), 1 << 20):
            part = at[low : low + (1 << 20)]

            def places(first: int, part: np.ndarray = part) -> np.ndarray:
                total = np.full(len(part), start)
                for place in range(size - 1):
                    total ^= spread(hashes[numbers[part + first + place]], place)
                return (total & mask).astype(np.int64)

            front, back = places(0), places(1)
            often = _has(filters.frequent, front) & _has(filters.frequent, back)
            forward, backward = _has(filters.forward, front), _has(filters.backward, back)
            grows = often & (forward & backward if size == self.longest else forward | backward)
            around = _has(filters.wanted, front) | _has(filters.wanted, back)
            if size == 3:  # all frequent pairs are known; of longer phrases, only those that could matter
                around &= often
            chosen.append(part[grows | around])
        return np.concatenate(chosen) if chosen else at

    @staticmethod
    def _rows(lang: str, phrases: pa.Array, found: np.ndarray) -> pa.RecordBatch:
        columns = [pa.repeat(pa.scalar(lang, pa.string()), len(phrases)), phrases, pa.array(found.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "n"])


def _count(docs: DataFrame, size: int, longest: int, filters: Filters | None) -> DataFrame:
    """``(lang, phrase, n)`` of words or of the phrases of ``size`` words that the filters let pass, summed over all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(longest)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                block.add(lang, text)
                if block.size >= BLOCK_BYTES:
                    yield from block.counts(size, shared.value)
                    block = Block(longest)
        yield from block.counts(size, shared.value)

    found = arrow_stream(docs, run, COUNTS)
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _with_counts(rows: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
    """Counts of a part that many rows may share: the counts are copied to ``SALTS`` places, the rows dealt over them."""
    copies = counts.select(F.col("lang"), F.col("phrase").alias(part), F.col("a").alias(name), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).join(copies, ["lang", part, "salt"]).drop("salt")


def score_of(a: str, l: str, r: str) -> Column:  # noqa: E741
    """``floor(10^6 * a * a / (l * r))`` with whole numbers of 38 digits."""
    wide = "CAST({} AS DECIMAL(19, 0))".format
    return F.expr(f"CAST(({wide(a)} * {wide(a)} * {SCALE}BD) DIV ({wide(l)} * {wide(r)}) AS LONG)")


def scored(phrases: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """Candidates of ``size`` words ``(lang, phrase, a)`` with their lowest-scoring cut and the bounds of what they may grow to."""
    words = F.split("phrase", " ")
    cuts = F.explode(F.sequence(F.lit(1), F.lit(size - 1))).alias("k")
    rows = phrases.select("lang", "phrase", "a", cuts).withColumns(
        {
            "left": F.concat_ws(" ", F.slice(words, F.lit(1), F.col("k"))),
            "right": F.concat_ws(" ", F.slice(words, F.col("k") + 1, F.lit(size) - F.col("k"))),
        }
    )
    rows = _with_counts(_with_counts(rows, counts, "left", "l"), counts, "right", "r").withColumn("score", score_of("a", "l", "r"))
    lowest = F.min(F.struct("score", "k", "l", "r"))
    first, last = F.max(F.when(F.col("k") == 1, F.col("l"))), F.max(F.when(F.col("k") == size - 1, F.col("r")))
    best = rows.groupBy("lang", "phrase", "a").agg(lowest.alias("c"), first.alias("first"), last.alias("last"))
    wide = f"CAST(a AS DECIMAL(19, 0)) * {SCALE}BD"
    return best.select(
        "lang", "phrase", "a", "c.l", "c.r", "c.score", F.lit(size).alias("size"),
        F.expr(f"CAST({wide} DIV first AS LONG)").alias("forward"),
        F.expr(f"CAST({wide} DIV last AS LONG)").alias("backward"),
    )


def _thresholds(pairs: DataFrame, languages: DataFrame, wanted: int) -> DataFrame:
    """``(lang, least)``: a score that about ``wanted`` pairs of the language reach; 0 where there are fewer."""
    step = SCALE // 2000
    steps = pairs.groupBy("lang", F.floor(F.col("score") / step).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    reached = steps.withColumn("n", F.expr("sum(n) OVER (PARTITION BY lang ORDER BY step DESC)"))
    least = reached.where(F.col("n") >= wanted).groupBy("lang").agg((F.max("step") * step).alias("least"))
    return languages.join(least, "lang", "left").select("lang", F.coalesce("least", F.lit(0)).alias("least"))


def mine(
    docs: DataFrame, top: int = 2000, longest: int = 3, least: int = 10, share: int = 50, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language of 2 to ``longest`` words, seen ``least`` times.

    A phrase gives way to a longer candidate around it that occurs in ``share`` percent of its places or more.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = saved_table(_count(texts, 1, longest, None).where(F.col("phrase").isNull() | (F.col("n") >= least)))
    sizes = words.where(F.col("phrase").isNull()).select("lang", "n")
    frequent = words.where(F.col("phrase").isNotNull()).withColumnRenamed("n", "a")
    pairs = _count(texts, 2, longest, Filters(_bit_table(frequent))).where(F.col("n") >= least).withColumnRenamed("n", "a")
    pairs = saved_table(scored(pairs, frequent, 2))
    open_languages, wanted, settled = sizes.select("lang"), GUESS * top, None
    while True:
        thresholds = saved_table(_thresholds(pairs, open_languages, wanted))
        surviving = saved_table(_survivors(texts, frequent, pairs, thresholds, longest, least, share))
        enough = surviving.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
        state = thresholds.join(enough, "lang", "left").withColumn("done", (F.col("least") == 0) | (F.coalesce("found", F.lit(0)) >= top))
        done = surviving.join(state.where("done").select("lang"), "lang")
        settled = done if settled is None else settled.unionByName(done)
        open_languages = saved_table(state.where("NOT done").select("lang"))
        if open_languages.isEmpty():
            break
        wanted *= FURTHER
    order = "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)"
    ranked = settled.withColumn("rank", F.expr(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _survivors(texts: DataFrame, words: DataFrame, pairs: DataFrame, thresholds: DataFrame, longest: int, least: int, share: int) -> DataFrame:
    """Phrases at or above the threshold of their language that no longer candidate replaces."""
    now = pairs.join(thresholds, "lang")
    counts = words.select("lang", "phrase", "a").unionByName(pairs.select("lang", "phrase", "a"))
    kept = []
    for size in range(3, longest + 1):
        high = F.col("score") >= F.col("least")
        tables = [_bit_table(now.where(condition)) for condition in (F.lit(True), high, F.col("forward") >= F.col("least"), F.col("backward") >= F.col("least"))]
        # Settled languages have no bits in the tables, so their texts add nothing here.
        grown = saved_table(_count(texts, size, longest, Filters(*tables)).where(F.col("n") >= least).withColumnRenamed("n", "a"))
        kept.append(_not_replaced(now.where(high), grown, size, share))
        rated = saved_table(scored(grown, counts, size))
        counts = counts.unionByName(grown)
        now = rated.join(thresholds, "lang")
    out = now.where(F.col("score") >= F.col("least")).select(*SHOWN)
    for shorter in kept:
        out = out.unionByName(shorter)
    return out


def _not_replaced(phrases: DataFrame, longer: DataFrame, size: int, share: int) -> DataFrame:
    """Phrases without a longer candidate, of ``size`` words, that is around them in ``share`` percent of their places or more.

    Candidates of more words need not be looked at: what is inside one of them is inside its part of ``size`` words, which occurs as often.
    """
    parts = F.array(F.substring_index("phrase", " ", size - 1), F.substring_index("phrase", " ", 1 - size))
    around = longer.select("lang", F.explode(parts).alias("phrase"), F.col("a").alias("longer"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    joined = phrases.join(around, ["lang", "phrase"], "left")
    return joined.where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True))).select(*SHOWN)
