import math
import random
from decimal import Decimal, localcontext

import numpy as np

from feedback_lens.llm import toxicity as tox


def brute_segments(scores):
    """Best segment first, then left and right of it."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            value = sum(scores[a:b])
            if value > 0 and (best is None or value > best[0] + 1e-9 or (abs(value - best[0]) <= 1e-9 and b - a < best[2] - best[1])):
                best = (value, a, b)
    if best is None:
        return []
    _, a, b = best
    right = [(v, x + b, y + b) for v, x, y in brute_segments(scores[b:])]
    return brute_segments(scores[:a]) + [best] + right


def test_segments_equal_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        scores = [rng.choice([-1, 1]) * rng.randrange(1, 1000) / 7 for _ in range(rng.randrange(0, 14))]
        got = [(round(v, 6), a, b) for v, a, b in tox.segments(np.array(scores))]
        assert got == [(round(v, 6), a, b) for v, a, b in brute_segments(scores)]
    assert tox.segments(np.array([])) == []


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abdefgilmnorstu") for _ in range(rng.randrange(2, 8))) for _ in range(600)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 120))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), "grumph" + rng.choice(["", "ing", "ex", "olo", "a"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic), 1.0))
    return docs, labels


def test_held_out_accuracy_and_edge_cases(spark):
    docs, labels = corpus(900, 1)
    frame = spark.createDataFrame([*docs, (None, "grumph"), (5000, None)], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (5000, 1, 0.0), (None, 1, 0.0), (1, None, 0.0)], "doc_id long, toxic int, score double")
    model = tox.fit(frame.where("doc_id % 3 <> 1"), marks.where("doc_id % 3 <> 1"))
    held = frame.where("doc_id % 3 = 1 or doc_id is null or text is null")
    got = {r.doc_id: r.s for r in held.select("doc_id", tox.score_column(spark, model)("text").alias("s")).collect()}
    truth = {i: t for i, t, _ in labels}
    right = [(s >= 0.7) == bool(truth[i]) for i, s in got.items() if i in truth]
    assert sum(right) >= 0.98 * len(right) and got[None] >= 0.7
    assert math.isclose(got[5000], model.share) and all(0 <= s <= 1 for s in got.values())
    odd = spark.createDataFrame([("",), ("123 !!",), ("grumphing " * 50_000,), ("x" * 100_000,)], "text string")
    scores = [r.s for r in odd.select(tox.score_column(spark, model)("text").alias("s")).collect()]
    assert scores[0] == scores[1] == model.share and scores[2] > 0.99 and scores[3] == model.share
    text = "the lamb Grumphing grumph nods"
    found = spark.createDataFrame([(text,)], "text string").select(tox.passages_column(spark, model)("text").alias("p")).first().p
    assert [text[p.start : p.end] for p in found] == ["Grumphing grumph"]


def test_all_segments_count():
    word = "grumph"
    for chance, times in ((1e-3, (1, 100)), (1e-4, (1, 100, 1000))):
        weights = {tox.features(word)[-1]: (9.0, 4.0 + tox.DRIFT)}
        model = tox.Model(weights, decay=1.0, scale=chance * math.exp(4.0))
        text = " ".join(word if i % 42 == 1 else "the" for i in range(300)).replace(word, "the", 1)
        assert len(tox.segments(model.scores(text))) == 7
        p = [model.p_value(" ".join([text] * n)) for n in times]
        assert p[0] < 1e-3 and all(math.isclose(x, 1e-300) for x in p[1:])
        assert model.score(" ".join([text] * times[-1])) > 0.99


def test_least_tail_equals_exact_sums():
    rng = random.Random(4)
    for _ in range(40):
        means = sorted(rng.choice([0.02, 0.5, 3, 40]) * (0.01 + rng.random()) for _ in range(rng.randrange(1, 70)))
        want = Decimal(0)
        with localcontext(prec=450):
            for r, mean in enumerate(map(Decimal, means), 1):
                term, below = (-mean).exp(), Decimal(0)
                for k in range(1, r + 1):
                    below += term
                    term *= mean / k
                want = min(want, (2**r * (1 - below)).ln())
        assert math.isclose(tox.log_least(np.array(means)), want, rel_tol=1e-9, abs_tol=1e-12)
    assert tox.log_least(np.array([])) == 0.0


def test_no_labels(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = tox.fit(frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert frame.select(tox.score_column(spark, model)("text").alias("s")).first().s == model.share
    assert frame.limit(0).select(tox.score_column(spark, model)("text").alias("s")).count() == 0
