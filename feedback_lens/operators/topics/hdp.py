"""Online variational hierarchical Dirichlet process for all segments (Wang, Paisley and Blei 2011)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedback_lens.operators.topics.engine import (
    MODEL,
    TERM,
    TOTAL,
    Chunk,
    ChunkedDocs,
    Statistics,
    blocks,
    chunk_docs,
    digamma,
    learn_online,
    uniforms,
)
from feedback_lens.schema import TOPIC_SEGMENT

# Truncations, priors and learning settings of the original models.
TOPICS, DOC_TOPICS = 150, 15
ALPHA, GAMMA, ETA = 1.0, 1.0, 0.01
DECAY, OFFSET, BATCH_SIZE = 1.0, 64.0, 256
DOC_STEPS, DOC_TOLERANCE, WARM_UP = 100, 1e-4, 3


def log_sticks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Expected log weights of broken sticks along the last axis; one more weight than sticks."""
    both = digamma(a + b)
    broken, kept = digamma(a) - both, digamma(b) - both
    zero = np.zeros(a.shape[:-1] + (1,))
    return np.concatenate([broken, zero], axis=-1) + np.concatenate([zero, np.cumsum(kept, axis=-1)], axis=-1)


def _softmax(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = x.max(axis=-1, keepdims=True)
    log_norm = top + np.log(np.exp(x - top).sum(axis=-1, keepdims=True))
    return np.exp(x - log_norm), x - log_norm


class HdpStep:
    """Expected topic words and expected stick use of a batch, all reviews of about the same length side by side."""

    def __init__(self, doc_topics: int, alpha: float, gamma: float, eta: float):
        self.doc_topics, self.alpha, self.gamma, self.eta = doc_topics, alpha, gamma, eta

    def __call__(self, chunk: Chunk) -> Statistics:
        topics = chunk.vecs.shape[1]
        log_beta = digamma(self.eta + chunk.vecs) - digamma(self.eta * chunk.n_terms + chunk.total)
        use = chunk.model if chunk.model is not None else np.zeros(topics)
        later = np.cumsum(use[::-1])[::-1]
        corpus = log_sticks(use[:-1] + 1.0, later[1:] + self.gamma)
        words = np.zeros_like(chunk.vecs)
        sticks = np.zeros(topics)
        for _, index, values in blocks(chunk, topics):
            to_corpus, to_doc = self._fit(log_beta[index], values, corpus)
            sticks += to_corpus.sum(axis=(0, 1))
            inside = values > 0
            expected = ((to_doc * values[:, :, None]) @ to_corpus)[inside]
            order = np.argsort(index[inside], kind="stable")
            present, first = np.unique(index[inside][order], return_index=True)
            if len(present):
                words[present] += np.add.reduceat(expected[order], first, axis=0)
        return [(TERM, chunk.terms, words), (TOTAL, None, words.sum(axis=0)[None, :]), (MODEL, None, sticks[None, :])]

    def _fit(self, log_beta: np.ndarray, values: np.ndarray, corpus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinate ascent ``[review, …]``: topics of a review onto corpus topics, its words onto its topics.

        Reviews are independent; each stops when its own bound has settled, and only the others go on.
        """
        n, k = len(values), self.doc_topics
        all_to_corpus = np.zeros((n, k, len(corpus)))
        all_to_doc = np.zeros((n, values.shape[1], k))
        active = np.arange(n)
        to_doc = np.full((n, values.shape[1], k), 1.0 / k)
        own = np.repeat(log_sticks(np.ones(k - 1), np.full(k - 1, self.alpha))[None, :], n, axis=0)
        weighted = log_beta * values[:, :, None]
        last = np.full(n, np.inf)
        for step in range(DOC_STEPS):
            settled = step >= WARM_UP
            to_corpus, log_to_corpus = _softmax(to_doc.transpose(0, 2, 1) @ weighted + (corpus if settled else 0.0))
            to_doc, log_to_doc = _softmax(log_beta @ to_corpus.transpose(0, 2, 1) + (own[:, None, :] if settled else 0.0))
            load = (values[:, None, :] @ to_doc)[:, 0, :]
            later = np.cumsum(load[:, ::-1], axis=1)[:, ::-1]
            own = log_sticks(1.0 + load[:, :-1], self.alpha + later[:, 1:])
            present = (values > 0)[:, :, None]
            bound = (
                np.sum((corpus - log_to_corpus) * to_corpus, axis=(1, 2))
                + np.sum((own[:, None, :] - log_to_doc) * to_doc * present, axis=(1, 2))
                + np.sum(to_doc.transpose(0, 2, 1) * (to_corpus @ weighted.transpose(0, 2, 1)), axis=(1, 2))
            )
            all_to_corpus[active], all_to_doc[active] = to_corpus, to_doc
            moving = ~(np.abs(bound - last) <= DOC_TOLERANCE * np.abs(last)) if settled and step else np.ones(len(active), bool)
            last = bound
            if not moving.any():
                break
            if not moving.all():
                active, last = active[moving], last[moving]
                log_beta, values, weighted, to_doc, own = (x[moving] for x in (log_beta, values, weighted, to_doc, own))
        return all_to_corpus, all_to_doc


def fit_hdp(
    counts: DataFrame,
    seg: Sequence[str] = TOPIC_SEGMENT,
    topics: int = TOPICS,
    doc_topics: int = DOC_TOPICS,
    passes: int = 1,
    seed: int = 0,
    batch_size: int = BATCH_SIZE,
) -> tuple[ChunkedDocs, DataFrame]:
    """Fit every segment; the state holds topic words and one row of stick use per segment."""
    docs = chunk_docs(counts, seg, batch_size=batch_size)
    seg = docs.seg

    def draw(hashes: np.ndarray, width: int, n_docs: float, n_terms: float) -> np.ndarray:
        return -np.log(uniforms(hashes, width)) * (n_docs * 100.0 / (topics * n_terms)) - ETA

    design = docs.sizes.select(
        *seg, F.array_repeat(F.lit(DECAY), topics).alias("decay"), F.array_repeat(F.lit(0.0), topics).alias("eta")
    )
    step = HdpStep(doc_topics, ALPHA, GAMMA, ETA)
    return docs, learn_online(docs, seed, draw, [step], passes, OFFSET, design, with_model=True).drop("part")


def _contenders(seg: Sequence[str], n: int, names: list[str]):
    """Rows of Arrow batches as ``(seg…, term, i, v)`` without the numbers that ``n`` others of segment and topic exceed in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for name in seg]
            other = np.any([code[1:] != code[:-1] for code in codes], axis=0) if batch.num_rows > 1 else np.zeros(0, bool)
            cuts = [0, *(np.flatnonzero(other) + 1), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                values = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(b - a, -1)
                last = np.partition(values, -n, axis=0)[-n] if b - a > n else values.min(axis=0)
                # Division may make numbers equal that are not; those go by term later on.
                row, topic = np.nonzero(values >= last - 1e-12 * np.abs(last + ETA))
                kept = [part.column(name).take(pa.array(row)) for name in (*seg, "term")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(topic, pa.int32()), pa.array(values[row, topic])], names=names)

    return run


def hdp_topics(docs: ChunkedDocs, state: DataFrame, n: int | None = None) -> DataFrame:
    """``(seg…, topic, term, weight)`` with weights that sum to 1 over the vocabulary of each topic.

    With ``n``, weights that are surely not among the ``n`` largest of their topic are left out before rows are made of the state.
    """
    seg = docs.seg
    # The mass of every topic is kept in the state, so weights need no sum over the exploded rows.
    total = state.filter(F.col("kind") == TOTAL).select(*seg, F.col("vec").alias("total")).join(docs.sizes.select(*seg, "n_terms"), seg)
    words = state.filter(F.col("kind") == TERM).select(*seg, "term", "vec")
    if n is None:
        rows = words.select(*seg, "term", F.posexplode("vec").alias("i", "v"))
    else:
        fields = [T.StructField("i", T.IntegerType()), T.StructField("v", T.DoubleType())]
        schema = T.StructType([*[words.schema[name] for name in (*seg, "term")], *fields])
        rows = words.mapInArrow(_contenders(seg, n, schema.names), schema)
    weight = (F.col("v") + ETA) / (F.get("total", F.col("i")) + ETA * F.col("n_terms"))
    rows = rows.join(docs.per_segment(total), seg)
    return rows.select(*seg, (F.col("i") + 1).alias("topic"), "term", weight.alias("weight"))
