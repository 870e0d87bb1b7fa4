"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, derived from its code point. A trigram binds its three letters: the first vector is
permuted twice (rotated by two places), the second once, and the three are multiplied. A text bundles the vectors of all its trigrams
into a sum; a language bundles the unit vectors of its texts. What all languages share is taken from both sides, then a text gets the
language whose prototype has the greatest cosine.

Letters are in lower case, all else is one blank between words. A text that is null or has no letter gets ``und`` and score 0. Ties go to
the language first in the alphabet. Without any labelled row everything is ``und``. Repeated rows are treated alike; an empty table gives
an empty result. Prototypes are learned from at most about ``max_labelled`` labelled rows, chosen by a hash of their id; their size is
the number of languages times the dimension.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_lens.llm.common import arrow_column, arrow_stream, hash_share, mix

DIMENSION = 1024
MAX_LABELLED = 20_000
BLOCK_CHARS = 150_000
BLOCK_TEXTS = 512
BLOCK_GRAMS = 2048
NOT_LETTERS = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"


def letter_vectors(points: np.ndarray, dimension: int = DIMENSION) -> np.ndarray:
    """One row of +1 and -1 for each code point."""
    words = np.arange(dimension // 64, dtype=np.uint64)
    seeds = mix(points.astype(np.uint64))[:, None] + words[None, :]
    bits = np.unpackbits(mix(seeds).view(np.uint8).reshape(len(points), -1), axis=1)
    return (bits.astype(np.int8) << 1) - 1


def bundles(texts: list[str], dimension: int = DIMENSION) -> np.ndarray:
    """Sum of trigram vectors of each text; zeros where it has no letter. Long texts are added up in parts that overlap by two."""
    out = np.zeros((len(texts), dimension), np.float32)
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        letters = NOT_LETTERS.sub(" ", text.lower()).strip(" ")
        if not letters:
            continue
        letters = f" {letters} "
        for start in range(0, len(letters) - 2, BLOCK_CHARS):
            rows.append(row)
            parts.append(letters[start : start + BLOCK_CHARS + 2])
            size += len(parts[-1])
            if size >= BLOCK_CHARS or len(parts) >= BLOCK_TEXTS:
                _bundle(rows, parts, out)
                rows, parts, size = [], [], 0
    if parts:
        _bundle(rows, parts, out)
    return out


def _bundle(rows: list[int], parts: list[str], out: np.ndarray) -> None:
    dimension = out.shape[1]
    points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
    alphabet, letters = np.unique(points, return_inverse=True)
    a = len(alphabet)
    owner = np.repeat(np.arange(len(parts)), [len(part) for part in parts])
    inside = owner[2:] == owner[:-2]
    codes = ((letters[:-2] * a + letters[1:-1]) * a + letters[2:])[inside]
    both, times = np.unique(owner[2:][inside] * a**3 + codes, return_counts=True)
    part, grams = both // a**3, both % a**3
    distinct, place = np.unique(grams, return_inverse=True)
    base = letter_vectors(alphabet, dimension)
    turned = [np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base]
    sums = np.zeros((len(parts), dimension), np.float32)
    for start in range(0, len(distinct), BLOCK_GRAMS):
        grams = distinct[start : start + BLOCK_GRAMS]
        vectors = (turned[0][grams // a**2] * turned[1][grams // a % a] * turned[2][grams % a]).astype(np.float32)
        here = (place >= start) & (place < start + len(grams))
        counts = np.zeros((len(parts), len(grams)), np.float32)
        counts[part[here], place[here] - start] = times[here]
        sums += counts @ vectors
    np.add.at(out, rows, sums)


def unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


class Prototypes:
    """Names of languages with their unit prototypes."""

    def __init__(self, names: list[str], vectors: np.ndarray) -> None:
        order = np.argsort(np.array(names, object)) if names else []
        self.names = [names[i] for i in order]
        whole = unit(vectors.astype(np.float32)) if names else np.zeros((0, DIMENSION), np.float32)
        self.common = whole.mean(axis=0) if len(names) > 1 else np.zeros(DIMENSION, np.float32)
        self.vectors = unit(whole[order] - self.common) if names else whole

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and cosine, the latter cut off at 0."""
        sums = bundles(texts)
        blank = ~sums.any(axis=1)
        if not self.names:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        # Only the direction within the span of the prototypes tells languages apart.
        cosines = unit(unit(sums) - self.common) @ self.vectors.T
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(len(texts)), best].astype(np.float64), 0, 1)
        score[blank] = 0
        return [UNDETERMINED if b else self.names[i] for b, i in zip(blank, best, strict=True)], score


def learn(docs: DataFrame, *, max_labelled: int = MAX_LABELLED) -> Prototypes:
    """Prototypes from rows with doc_id, text and a language."""
    labelled = docs.where("text is not null and lang is not null").select("doc_id", "text", F.col("lang").alias("name"))
    share = min(1.0, max_labelled / max(1, labelled.count()))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            vectors = unit(bundles(batch.column(0).to_pylist()))
            for name in set(names):
                rows = [i for i, n in enumerate(names) if n == name]
                sums[name] = sums.get(name, 0) + vectors[rows].sum(axis=0, dtype=np.float64)
        columns = [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["name", "sums"])

    sampled = labelled.where(hash_share("doc_id", share)).select("text", "name")
    parts = arrow_stream(sampled, add, "name string, sums array<double>")
    places = parts.select("name", F.posexplode("sums").alias("place", "value")).groupBy("name", "place").agg(F.sum("value").alias("value"))
    rows = places.collect()  # languages times dimension
    names = sorted({r["name"] for r in rows})
    vectors = np.zeros((len(names), DIMENSION))
    index = {name: i for i, name in enumerate(names)}
    for r in rows:
        vectors[index[r["name"]], r["place"]] = r["value"]
    return Prototypes(names, vectors)


def predict_column(spark: SparkSession, prototypes: Prototypes) -> Callable[..., Column]:
    """Text to struct<lang_pred, score>."""
    shared = spark.sparkContext.broadcast(prototypes)

    def predict(texts: pa.Array) -> pa.Array:
        names, scores = shared.value.predict([text or "" for text in texts.to_pylist()])
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return arrow_column(spark, predict, "struct<lang_pred:string,score:double>")


def lettered_column(spark: SparkSession) -> Callable[..., Column]:
    """Text to whether it has a letter."""
    return arrow_column(spark, lambda texts: pa.array([bool(NOT_LETTERS.sub("", (t or "").lower())) for t in texts.to_pylist()], pa.bool_()), "boolean")
