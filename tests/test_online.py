import uuid

import numpy as np
from pyspark.sql import functions as F

from feedback_lens.operators.bow import bow
from feedback_lens.operators.rows import top_keywords
from feedback_lens.operators.topics import lda
from feedback_lens.operators.topics.engine import Spool, chunk_docs
from feedback_lens.operators.topics.hdp import fit_hdp, hdp_topics


def reviews(spark, n=90, words=30):
    rng = np.random.default_rng(7)
    rows = [("ab"[i % 2], i, [f"t{w}" for w in rng.choice(words, 1 + rng.integers(12))]) for i in range(n)]
    return spark.createDataFrame(rows, "seg string, review_id long, tokens array<string>")


def jobs_of(spark, action):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_online_steps_are_not_jobs(spark):
    """A model of many mini-batches and passes takes as many Spark jobs as one of a single step."""
    counts = bow(reviews(spark), ["seg"])
    few, many = chunk_docs(counts, ["seg"], batch_size=1000), chunk_docs(counts, ["seg"], batch_size=5)
    steps = [jobs_of(spark, lambda d=docs, p=passes: lda.train(d, [(2, 0.7)], passes=p)) for docs, passes in ((few, 1), (many, 3))]
    assert steps[0] == steps[1]


def test_grid_equals_models_fitted_fold_by_fold(spark):
    """The perplexity of a grid point is that of a model learned without the fold, whose parts and mini-batches come out the same."""
    counts = bow(reviews(spark), ["seg"])
    found = {(r.seg, r.k, r.decay): r.perplexity for r in lda.grid_scores(counts, ["seg"], [2, 3], [0.5, 0.9], folds=2, passes=2, batch_size=8).collect()}
    expected = {}
    fold = F.col("fold")
    for held in range(2):
        dealt = counts.withColumn("own", lda.fold_of("review_id", 2)).withColumn("fold", F.lit(held))
        vocabulary = dealt.select("seg", "fold", "term").distinct()
        docs = chunk_docs(dealt.filter(fold != F.col("own")).drop("own"), ["seg", "fold"], batch_size=8, vocabulary=vocabulary)
        models = lda._grid([2, 3], [0.5, 0.9])
        rows = lda.train(docs, models, passes=2).filter("kind = 0").collect()
        for seg in "ab":
            state = {r.term: np.array(r.vec) for r in rows if r.seg == seg}
            terms = sorted(state)
            lam = np.array([state[t] for t in terms])
            texts = {}
            for r in dealt.filter((fold == F.col("own")) & (F.col("seg") == seg)).collect():
                texts.setdefault(r.review_id, []).append((terms.index(r.term), float(r.tf)))
            at = 0
            for k, decay in models:
                expected.setdefault((seg, k, decay), []).append(perplexity(lam[:, at : at + k], list(texts.values())))
                at += k
    assert found.keys() == expected.keys()
    assert all(np.isclose(found[key], np.mean(values), rtol=1e-6) for key, values in expected.items())


def perplexity(lam, texts):
    """The bound as it is published, one review after another."""
    k, n_terms = lam.shape[1], len(lam)
    alpha, total = 1 / k, lam.sum(axis=0)
    beta = np.exp(lda.digamma(lam) - lda.digamma(total))
    bound = tokens = 0.0
    for text in texts:
        index, counts = [i for i, _ in text], np.array([c for _, c in text])
        gamma = np.ones(k)
        for _ in range(lda.E_STEPS):
            theta = lda.expected(gamma)
            new = alpha + theta * ((counts / (beta[index] @ theta)) @ beta[index])
            change, gamma = np.abs(new - gamma).mean(), new
            if change < lda.E_TOLERANCE:
                break
        log_theta = lda.digamma(gamma) - lda.digamma(gamma.sum())
        bound += counts @ np.log(beta[index] @ np.exp(log_theta)) + ((alpha - gamma) * log_theta + lda.log_gamma(gamma) - lda.log_gamma(alpha)).sum()
        bound += float(lda.log_gamma(alpha * k) - lda.log_gamma(gamma.sum()))
        tokens += counts.sum()
    log_beta = lda.digamma(lam) - lda.digamma(total)
    bound += ((alpha - lam) * log_beta + lda.log_gamma(lam) - lda.log_gamma(alpha)).sum()
    bound += (lda.log_gamma(alpha * n_terms) - lda.log_gamma(total)).sum()
    return np.exp(-bound / tokens)


def test_spool_cuts_batches_and_parts(monkeypatch):
    """Mini-batches have their size whatever pieces reviews come in; parts hold bounded entries, a longer review alone."""
    monkeypatch.setattr("feedback_lens.operators.topics.engine.MAX_ENTRIES", 10)
    lengths = np.array([3, 4, 2, 25, 1, 0, 6, 6, 2, 9, 1])
    index, values = np.arange(lengths.sum()) % 13, np.arange(lengths.sum()) + 0.5
    for cuts in ([0, 11], [0, 1, 2, 3, 7, 11], [0, 4, 8, 11]):
        spool, ends = Spool(4), np.concatenate([[0], np.cumsum(lengths)])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            spool.add(lengths[a:b], index[ends[a] : ends[b]], values[ends[a] : ends[b]])
        spool.close()
        parts = list(spool.read())
        assert [sum(len(p[0]) for b, p in parts if b == batch) for batch in range(3)] == [4, 4, 3]
        assert all(p[0].sum() <= 10 or len(p[0]) == 1 for _, p in parts)
        assert np.array_equal(np.concatenate([p[0] for _, p in parts]), lengths)
        assert np.array_equal(np.concatenate([p[1][p[2]] for _, p in parts]), index)
        assert np.array_equal(np.concatenate([p[3] for _, p in parts]), values)


def test_hdp_keywords_without_the_light_weights(spark):
    docs, state = fit_hdp(bow(reviews(spark), ["seg"]), ["seg"], topics=6, doc_topics=3)
    few = hdp_topics(docs, state, 4)
    key = lambda df: sorted(map(tuple, top_keywords(df, ["seg"], 4).collect()))
    assert key(few) == key(hdp_topics(docs, state))
    assert few.count() < hdp_topics(docs, state).count()
