"""Noun, verb and prepositional phrases from tagged words.

A review is held as its words and a string with one tag letter per word. Patterns run on the letters, so they never
nest groups over words, and the match borders cut the words in Arrow batches: no explode, no join, linear in the review.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedback_lens.session import buckets_for, written_in_buckets

# Phrase patterns over tag letters. The loop of the prepositional pattern is possessive, which
# matches the same strings as the plain one and keeps the regex engine from recursing on long reviews.
NOUN_PATTERN = "D?A*N+"
VERB_PATTERN = "V?[RD]*V+"
PREP_PATTERN = "D?N(?:P?N)*+"
PATTERNS = {"noun": NOUN_PATTERN, "verb": VERB_PATTERN, "prep": PREP_PATTERN}

# Phrase kinds by priority when a hypothesis has equally many of two kinds.
PHRASE_TYPES = ("noun", "verb", "prep")

#: Reviews, and characters of their texts, that are tagged as one block; blocks of fewer reviews are not made for the sake of more tasks.
BLOCK_REVIEWS, BLOCK_CHARS, FEWEST_REVIEWS = 2_048, 8 << 20, 256


def _one_letter() -> Column:
    wrong = F.concat(F.lit("a tag must be one capital letter: "), F.col("tag"))
    return F.when(F.rlike("tag", F.lit("^[A-Z]$")), F.col("tag")).otherwise(F.raise_error(wrong)).alias("tag")


def gather_tagged(tagged: DataFrame, id_col: str = "review_id", word: str = "lemma") -> DataFrame:
    """``words`` and ``tags`` per review, in order; a group is one review."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", F.col(word).alias("word"), _one_letter())))
    return (
        tagged.groupBy(id_col)
        .agg(ordered.alias("t"))
        .select(
            id_col,
            F.transform("t", lambda s: s["word"]).alias("words"),
            F.array_join(F.transform("t", lambda s: s["tag"]), "").alias("tags"),
        )
    )


def tagged_in_blocks(
    texts: DataFrame, text: str, tokens: Column, tag: Callable[[DataFrame], DataFrame], id_col: str = "review_id", word: str = "lemma"
) -> DataFrame:
    """``gather_tagged`` for many texts: each block of them asks once for every distinct word, so words do not travel one by one.

    ``tokens`` cuts the column ``text``. ``tag`` turns rows with a column ``w`` into rows with ``tag`` and ``word``: none for a word that is left
    out, and more than one where the lexicon lists it so often. The tokens are written once, in buckets of blocks.
    """
    spark = texts.sparkSession
    n, chars = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(text)), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_REVIEWS), -(-chars // BLOCK_CHARS), min(n // FEWEST_REVIEWS, 4 * spark.sparkContext.defaultParallelism))
    block = F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("block")
    placed = written_in_buckets(texts.select(id_col, block, tokens.alias("tokens")), ["block"], buckets_for(spark, blocks)).df
    words = placed.select("block", F.explode_outer("tokens").alias("w")).filter(F.col("w").isNotNull()).distinct()
    known = tag(words).select(F.col("block").alias("of_block"), F.col("w").alias("token"), F.col(word).alias("word"), _one_letter())
    schema = T.StructType([texts.schema[id_col], T.StructField("words", T.ArrayType(T.StringType())), T.StructField("tags", T.StringType())])

    def gather(ours: pa.Table, known: pa.Table) -> pa.Table:
        return _gathered(ours, known, id_col)

    return placed.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(gather, schema)


def _gathered(ours: pa.Table, known: pa.Table, id_col: str) -> pa.Table:
    """Words and tag letters of each review of a block, in order of place, word and tag; reviews without a tagged word have no row."""
    known = known.take(pc.sort_indices(known, sort_keys=[("word", "ascending"), ("tag", "ascending")]))
    listed = known.column("token").combine_chunks().dictionary_encode()
    by_token = np.argsort(listed.indices.to_numpy(), kind="stable")
    times = np.bincount(listed.indices.to_numpy(), minlength=len(listed.dictionary))
    starts = np.cumsum(times) - times
    tokens = ours.column("tokens").combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    ids = ours.column(id_col).combine_chunks().dictionary_encode(null_encoding="encode")
    review = np.repeat(ids.indices.to_numpy(), lengths)
    pos = np.arange(len(review)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = pc.fill_null(pc.index_in(tokens.flatten(), value_set=listed.dictionary), -1).to_numpy(zero_copy_only=False)
    held = at >= 0
    review, pos, at = review[held], pos[held], at[held]
    many = times[at] if len(at) else np.zeros(0, np.int64)
    review, pos, first = np.repeat(review, many), np.repeat(pos, many), np.repeat(starts[at] if len(at) else many, many)
    entry = by_token[first + np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)]
    if len(ids.dictionary) < len(ids) or len(times) < len(known):
        order = np.lexsort((entry, pos, review))
        review, entry = review[order], entry[order]
    present, begin = np.unique(review, return_index=True)
    borders = np.append(begin, len(review)).astype(np.int32)
    letters = np.frombuffer("".join(known.column("tag").to_pylist()).encode(), np.uint8)[entry]
    tags = pa.StringArray.from_buffers(len(present), pa.py_buffer(borders), pa.py_buffer(letters.tobytes()))
    words = pa.ListArray.from_arrays(pa.array(borders), known.column("word").combine_chunks().take(pa.array(entry)))
    return pa.table({id_col: ids.dictionary.take(pa.array(present)), "words": words, "tags": tags})


def match_phrases(words: Column, tags: Column, pattern: str) -> Column:
    """Longest left-to-right matches of a tag pattern as phrases; a match cuts the words at its borders, in one step per match."""
    compiled = re.compile(pattern)

    def found(words: list[str | None] | None, tags: str | None) -> list[str]:
        if not words or not tags:
            return []
        return [" ".join([w for w in words[m.start() : m.end()] if w is not None]) for m in compiled.finditer(tags)]

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def phrases(words: pa.Array, tags: pa.Array) -> pa.Array:
        return pa.array(map(found, words.to_pylist(), tags.to_pylist()), pa.list_(pa.string()))

    return phrases(words, tags)


def noun_phrases(words: Column, tags: Column) -> Column:
    return match_phrases(words, tags, NOUN_PATTERN)


def verb_phrases(words: Column, tags: Column) -> Column:
    return match_phrases(words, tags, VERB_PATTERN)


def prep_phrases(words: Column, tags: Column) -> Column:
    return match_phrases(words, tags, PREP_PATTERN)


def with_phrases(df: DataFrame) -> DataFrame:
    """The three phrase columns."""
    words, tags = F.col("words"), F.col("tags")
    return df.withColumns(
        {
            "noun_phrases": noun_phrases(words, tags),
            "verb_phrases": verb_phrases(words, tags),
            "prep_phrases": prep_phrases(words, tags),
        }
    )


def long_phrases(df: DataFrame, id_col: str = "review_id") -> DataFrame:
    """Distinct ``(review, phrase_type, phrase)`` rows."""
    kinds = F.array(
        *[F.struct(F.lit(kind).alias("phrase_type"), F.col(f"{kind}_phrases").alias("ps")) for kind in PHRASE_TYPES]
    )
    rows = df.select(id_col, F.explode(kinds).alias("k"))
    return rows.select(id_col, "k.phrase_type", F.explode(F.array_distinct("k.ps")).alias("phrase"))
