import random
import re

import numpy as np
import pytest

from feedback_lens.llm import minhash as mh
from feedback_lens.llm.components import components


def brute(rows, percent=85):
    sets = {}
    for i, text in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        shingles = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
        sets[i] = shingles
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def corpus(rng):
    vocabulary = [f"w{i}É" for i in range(300)]
    texts = ["", None, "  \n", "a b", "A  b", "one two three four five", "é" * 5000]
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(rng.randrange(1, 14)):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n"]).join(words))
            if rng.random() < 0.3:
                base = words  # chains of edits
    rng.shuffle(texts)
    return [(i * 3 - 40, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("block", [512, 2])
def test_equal_to_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(mh, "BLOCK", block)
    monkeypatch.setattr(mh, "PIVOT_ROWS", 3)
    rows = corpus(random.Random(block))
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, component_id int")
    assert sorted(map(tuple, mh.near_duplicates(df).collect())) == brute(rows)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, mh.near_duplicates(df).collect())) == brute(rows)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted(map(tuple, mh.near_duplicates(df).collect()), key=str)
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True)]
    assert mh.near_duplicates(df.limit(0)).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**32, (4000, mh.HASHES), np.uint32)
    for similarity, share in ((0.85, 1.0), (0.3, 0.0)):
        b = np.where(rng.random(a.shape) < similarity, a, a + 1)
        assert abs(mh.may_reach(a, b.astype(np.uint32), 85).mean() - share) < 0.002


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (300, 299)]
    df = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, components(df).collect()))
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in [100, *range(200, 250)]} | {299: 299, 300: 299}


def test_no_row_for_each_pair_of_a_group(spark, monkeypatch):
    """Copies with edits of their own that miss the threshold: candidates are verified where they meet, and only joining links leave the task."""
    rng = random.Random(9)
    base = [f"v{i}" for i in range(150)]
    texts = []
    for _ in range(70):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(150)] = f"x{rng.random()}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    made, cross = [], mh._cross_links

    def counted(*args):
        links = cross(*args)
        made.append(0 if links is None else (links := mh.store(links)).count())
        return links

    monkeypatch.setattr(mh, "_cross_links", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, mh.near_duplicates(df, percent=82).collect())) == brute(rows, 82)
    assert len(made) == 1 and made[0] <= len(rows)
