"""Toxicity by maximum-scoring segments.

Tokens are runs of letters in lower case; each stands for its first 4, 5 and 6 letters and for itself. Labelled texts without their copies
give every such feature a log-odds ratio between toxic and clean documents under an informative Dirichlet prior of ``PRIOR_DOCS`` documents
(with the feature's share in both classes together). A feature whose signed root of the likelihood ratio is below ``ROOT_LEAST`` counts
as zero; a token takes the value of its most significant feature, less a drift that makes clean text score below zero on average.

A linear scan finds all maximal scoring segments of a text. Scores of clean text follow an extreme-value law: ``lambda`` solves
``sum(p * exp(lambda * s)) = 1`` over the smoothed token scores of clean text, ``K`` is the maximum-likelihood value over the clean
training documents. The expected number of chance segments, ``K * n * exp(-lambda * s)``, rates each passage; the r best passages
together are rated by a Poisson tail, for every r up to the number of segments, in logarithms. The document's p-value becomes a probability through the least Bayes factor ``-e p ln p``
and the share of toxic documents.

Features live in ``2 ** BUCKET_BITS`` hashed buckets, which bounds the model whatever the corpus. The labelled sample used for fitting
is bounded by ``max_labelled``. Null or letterless texts have no segment and get the base rate. Ties between segments keep text order.
Repeated rows are scored alike; duplicate labels of one id count once each; an empty table gives an empty result. Without a toxic or a
clean label, every text gets the base rate.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_lens.llm.common import arrow_column, arrow_stream, ascii_words, hash_share, mix, shingle_hashes, store

BUCKET_BITS = 20
PRIOR_DOCS = 20.0
ROOT_LEAST = 5.0
#: Tokens were picked as the most telling ones, which the law of chance segments does not know; p-values are raised by this factor.
SELECTION = 30.0
DRIFT = 1.0
SIGNIFICANT = 0.05
MAX_LABELLED = 30_000
LETTERS = re.compile(r"[^\W\d_]+")


def features(token: str) -> list[int]:
    """Buckets of a token: its beginnings, then the whole."""
    names = [token[:n] for n in (4, 5, 6) if len(token) > n] + [token + "$"]
    return [zlib.crc32(name.encode()) & ((1 << BUCKET_BITS) - 1) for name in names]


class _Buckets(dict):
    limit = 300_000

    def __missing__(self, token: str) -> list[int]:
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = features(token)
        return value


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, start, end) in one pass; runs of equal sign are joined first."""
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    cuts = np.flatnonzero(np.diff(positive) > 1)
    starts, ends = positive[np.concatenate([[0], cuts + 1])], positive[np.concatenate([cuts, [len(positive) - 1]])] + 1
    stack: list[tuple[float, float, int, int]] = []  # sum before, sum after, start, end
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        left, right = float(total[start]), float(total[end])
        while True:
            below = len(stack) - 1
            while below >= 0 and stack[below][0] >= left:
                below -= 1
            if below < 0 or stack[below][1] >= right:
                break
            left, start = stack[below][0], stack[below][2]
            del stack[below:]
        stack.append((left, right, start, end))
    return [(right - left, start, end) for left, right, start, end in stack]


def log_least(means: np.ndarray) -> float:
    """Logarithm of the least ``2 ** r * P(N >= r)`` over all ranks r, N a Poisson number of mean ``means[r - 1]``; at most 0.

    Where the mean is r or more, the tail is at least one half and the product at least 1. Elsewhere the tail is its first term times
    ``1 + m / (r + 1) + m ** 2 / ((r + 1) * (r + 2)) + ...``; the series is added up for ranks whose first term may still be the least.
    """
    rank = np.arange(1, len(means) + 1, dtype=np.float64)
    mean = np.maximum(means, 1e-300)
    first = rank * np.log(2 * mean) - mean - np.cumsum(np.log(rank))
    open_ = (mean < rank) & (first < 0)
    if not open_.any():
        return 0.0
    rank, mean, first = rank[open_], mean[open_], first[open_]
    kept = first <= (first - np.log1p(-mean / (rank + 1))).min()  # the geometric series bounds the other one
    rank, mean, first = rank[kept], mean[kept], first[kept]
    total, term, step = np.ones_like(mean), np.ones_like(mean), 0
    while term.max() > 1e-17:
        step += 1
        term = term * mean / (rank + step)
        total += term
    return min(0.0, float((first + np.log(total)).min()))


@dataclass
class Model:
    """Token scores, the extreme-value law of clean text, and the share of toxic documents."""

    weights: dict[int, tuple[float, float]] = field(default_factory=dict)  # bucket: signed root, log-odds
    decay: float = 1.0
    scale: float = 1.0
    share: float = 0.1
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def token_score(self, token: str) -> float:
        _, value = max((self.weights.get(b, (0.0, 0.0)) for b in features(token)), key=lambda x: abs(x[0]))
        return value - DRIFT

    def scores(self, text: str) -> np.ndarray:
        tokens = LETTERS.findall(text.lower())
        known = self.known
        for token in set(tokens).difference(known):
            known[token] = self.token_score(token)
        out = np.fromiter(map(known.__getitem__, tokens), np.float64, len(tokens))
        if len(known) > 300_000:
            known.clear()
        return out

    def expected(self, score: float, tokens: int) -> float:
        """Segments of at least that score that a clean text of so many tokens has by chance."""
        return self.scale * tokens * math.exp(-min(self.decay * score, 700.0))

    def passages(self, text: str) -> list[tuple[int, int, float, float]]:
        """Significant passages: first and last character, score, expected number by chance."""
        spans = [m.span() for m in LETTERS.finditer(text)]
        scores = self.scores(text)
        if len(spans) != len(scores):  # lower case moved letter borders
            spans = [m.span() for m in LETTERS.finditer(text.lower())]
        found = [(s, a, b, self.expected(s, len(scores))) for s, a, b in segments(scores)]
        return [(spans[a][0], spans[b - 1][1], s, e) for s, a, b, e in found if e <= SIGNIFICANT]

    def p_value(self, text: str) -> float:
        scores = self.scores(text)
        best = np.sort([s for s, _, _ in segments(scores)])[::-1]
        means = self.scale * len(scores) * np.exp(-np.minimum(self.decay * best, 700.0))
        return math.exp(min(0.0, max(math.log(SELECTION) + log_least(means), math.log(1e-300))))

    def score(self, text: str) -> float:
        """Probability that the text is toxic."""
        p = self.p_value(text)
        factor = -math.e * p * math.log(p) if p < 1 / math.e else 1.0
        return self.share / (self.share + (1 - self.share) * factor)


def _labelled(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """Text and label of a bounded share of the labelled rows, chosen by a hash of the id; of texts that share a least shingle, one stays.

    Without that, the rare words of one toxic document with many edited copies would count as toxic.
    """
    marks = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", "toxic")
    share = min(1.0, max_labelled / max(1, marks.count()))
    marks = marks.where(hash_share("doc_id", share))

    def least(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            hashes = shingle_hashes(ascii_words(text), 5)
            rows.append([int(h.min() >> np.uint64(1)) for h in (hashes, mix(hashes))] if len(hashes) else [0, 0])
        return pa.array(rows, pa.list_(pa.int64()))

    keys = arrow_column(docs.sparkSession, least, "array<long>")
    # The labelled sample is bounded by max_labelled, hence the hint.
    sample = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(marks), "doc_id").withColumn("keys", keys("text"))
    for place in (0, 1):
        row = F.struct("doc_id", "text", "toxic", "keys")
        sample = sample.groupBy(F.col("keys")[place].alias("key"), "toxic").agg(F.min_by(row, "doc_id").alias("row")).select("row.*")
    return store(sample.select("text", "toxic"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clean and toxic texts of one task that have each bucket; bucket -1 counts texts."""
    totals = np.zeros((2, 1 << BUCKET_BITS), np.int64)
    docs = np.zeros(2, np.int64)
    buckets = _Buckets()
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            hit = {b for token in set(LETTERS.findall(text.lower())) for b in buckets[token]}
            totals[toxic, list(hit)] += 1
            docs[toxic] += 1
    used = np.flatnonzero(totals.sum(axis=0))
    columns = [np.append(used, -1), *(np.append(totals[i, used], docs[i]) for i in (0, 1))]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "clean", "toxic"])


def _times_log(count: Column, expected: Column) -> Column:
    return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)


def fit(docs: DataFrame, labels: DataFrame, *, max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from labelled rows: ``docs`` has doc_id and text, ``labels`` doc_id and toxic."""
    sample = _labelled(docs, labels, max_labelled)
    counts = (
        arrow_stream(sample, _count, "bucket long, clean long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    counts = store(counts)
    totals = [(r["clean"], r["toxic"]) for r in counts.where("bucket < 0").collect()]
    n0, n1 = totals[0] if totals else (0, 0)
    share = min((n1 + 1) / (n0 + n1 + 2), 0.5)
    if not n0 or not n1:
        return Model(share=share)
    clean, toxic, n = F.col("clean"), F.col("toxic"), float(n0 + n1)
    prior = (clean + toxic) / n * PRIOR_DOCS
    odds = F.log((toxic + prior) / (n1 + PRIOR_DOCS - toxic - prior)) - F.log((clean + prior) / (n0 + PRIOR_DOCS - clean - prior))
    ratio = 2 * (
        _times_log(toxic, (clean + toxic) * n1 / n)
        + _times_log(clean, (clean + toxic) * n0 / n)
        + _times_log(n1 - toxic, (n - clean - toxic) * n1 / n)
        + _times_log(n0 - clean, (n - clean - toxic) * n0 / n)
    )
    weighed = (
        counts.where("bucket >= 0")
        .select("bucket", odds.alias("odds"), (F.signum(odds) * F.sqrt(F.greatest(ratio, F.lit(0.0)))).alias("root"))
        .where(F.abs("root") >= ROOT_LEAST)
    )
    weights = {r["bucket"]: (r["root"], r["odds"]) for r in weighed.collect()}  # at most 2 ** BUCKET_BITS rows
    return _calibrated(sample, Model(weights, share=share))


def _calibrated(sample: DataFrame, model: Model) -> Model:
    """Fit the extreme-value law to the clean rows of the sample."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Token scores in steps of 1/16, and per document its best score (steps of 1/16) with its number of tokens."""
        own, scores, best = shared.value, {}, {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                values = own.scores(text)
                for step, n in zip(*np.unique(np.round(values * 16).astype(np.int64), return_counts=True), strict=True):
                    scores[int(step)] = scores.get(int(step), 0) + int(n)
                top = round(16 * max((s for s, _, _ in segments(values)), default=0.0))
                n, d = best.get(top, (0, 0))
                best[top] = (n + len(values), d + 1)
        rows = [(0, s, n, 0) for s, n in scores.items()] + [(1, s, n, d) for s, (n, d) in best.items()]
        kind, step, tokens, docs = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (kind, step, tokens, docs)], ["kind", "step", "tokens", "docs"])

    clean = sample.where("toxic = 0").select("text")
    rows = (
        arrow_stream(clean, histogram, "kind long, step long, tokens long, docs long")
        .groupBy("kind", "step")
        .agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
        .collect()  # one row per score step
    )
    scores = {r["step"] / 16: r["tokens"] for r in rows if r["kind"] == 0}
    best = {r["step"] / 16: (r["tokens"], r["docs"]) for r in rows if r["kind"] == 1}
    # Weights that clean text of the sample never showed keep one pseudo-token each.
    top = max((value for _, value in model.weights.values()), default=0.0) - DRIFT
    if top > 0:
        scores[top] = scores.get(top, 0) + 1
    else:
        scores[1.0] = scores.get(1.0, 0) + 1
    values, tokens = np.array(list(scores)), np.array(list(scores.values()), float)
    share = tokens / tokens.sum()
    low, high = 1e-6, 1.0
    rise = lambda x: float((share * np.exp(np.minimum(x * values, 600))).sum()) - 1
    if rise(low) >= 0:  # clean text scores above zero on average: no law holds
        model.decay = low
    else:
        while rise(high) < 0 and high < 1e3:
            high *= 2
        for _ in range(80):
            middle = (low + high) / 2
            low, high = (middle, high) if rise(middle) < 0 else (low, middle)
        model.decay = low
    seen = sum(d for s, (_, d) in best.items() if s > 0)
    weight = sum(n * math.exp(-model.decay * s) for s, (n, _) in best.items())
    model.scale = (seen + 1) / max(weight, 1.0)
    model.known.clear()
    return model


def score_column(spark: SparkSession, model: Model) -> Callable[..., Column]:
    """Text to its probability of being toxic."""
    shared = spark.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        own = shared.value
        return pa.array([own.score(text or "") for text in texts.to_pylist()], pa.float64())

    return arrow_column(spark, score, "double")


def passages_column(spark: SparkSession, model: Model) -> Callable[..., Column]:
    """Text to its significant passages in text order."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    def find(texts: pa.Array) -> pa.Array:
        rows = [shared.value.passages(text or "") for text in texts.to_pylist()]
        return pa.array([[dict(zip(("start", "end", "score", "expected"), p, strict=True)) for p in row] for row in rows], kind)

    return arrow_column(spark, find, "array<struct<start:int,end:int,score:double,expected:double>>")
