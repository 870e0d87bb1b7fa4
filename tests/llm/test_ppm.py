import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedback_lens.llm import ppm
from feedback_lens.llm.common import Lookup, held_out


def train(texts):
    trie = defaultdict(Counter)
    for text in texts:
        data = bytes([ppm.START]) * ppm.ORDER + text.encode() + bytes([ppm.END])
        for i in range(ppm.ORDER, len(data)):
            for k in range(ppm.ORDER + 1):
                trie[data[i - k : i]][data[i]] += 1
    return trie


def log_p(trie, context, byte):
    """One byte, step by step: escape through shorter contexts, bytes seen in longer ones excluded."""
    excluded, total = set(), 0.0
    for k in range(len(context), -1, -1):
        counts = {b: c for b, c in trie.get(context[len(context) - k :], {}).items() if b not in excluded}
        if not counts:
            continue
        whole = 2 * sum(counts.values())
        if byte in counts:
            return total + math.log10((2 * counts[byte] - 1) / whole)
        total += math.log10(len(counts) / whole)
        excluded |= set(counts)
    return total - math.log10(256 - len(excluded))


def brute(rows, out):
    learned = [t or "" for (_, t), o in zip(rows, out, strict=True) if not o]
    trie = train(learned)

    def tokens(text):
        return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w] + [None]

    counts = Counter(w for t in learned for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    result = []
    for (i, text), o in zip(rows, out, strict=True):
        words = tokens(text or "")
        data = bytes([ppm.START]) * ppm.ORDER + (text or "").encode() + bytes([ppm.END])
        score = sum(log_p(trie, data[k - ppm.ORDER : k], data[k]) for k in range(ppm.ORDER, len(data)))
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        result.append((i, o, len(words), sum(counts[w] > 0 for w in words), n, base, score))
    return result


@pytest.mark.parametrize("block_bytes", [400, 1 << 20])
def test_equal_to_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(ppm, "PART_BYTES", 60)
    rng = random.Random(block_bytes)
    words = ["the", "The", "éa", "an", "banana", "x\0y", "\n", "ba", "漢"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 14)))) for i in range(60)] + [(60, None), (61, ""), (62, "zzzz q" * 30), (None, "an")]
    df = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, held_out boolean")
    part = held_out(7, 2)
    out = [r.o for r in df.select(part.alias("o")).collect()]
    assert any(out) and not all(out)
    got = sorted(map(tuple, ppm.score_documents(df, part).collect()), key=str)
    for a, b in zip(got, sorted(brute(rows, out), key=str), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-9) and a[6] == pytest.approx(b[6], abs=1e-8)


def test_probabilities_add_up_to_one():
    runs, _ = ppm.byte_runs(["abracadabra", "aba", "ac"])
    keys, counts = np.unique(runs, return_counts=True)
    for context in {int(k) >> 8 for k in keys} | {0x7878787878}:
        every = np.array([context << 8 | b for b in range(256)], np.uint64)
        missing = np.setdiff1d(every, keys)
        everything = np.concatenate([keys, missing])
        amounts = np.concatenate([counts, np.zeros(len(missing), np.int64)])
        pairs = np.zeros((256, 256), np.int64)
        np.add.at(pairs, ((keys >> np.uint64(8) & np.uint64(0xFF)).astype(int), (keys & np.uint64(0xFF)).astype(int)), counts)
        values = ppm.log_probabilities(everything, amounts, pairs)
        mine = dict(zip(everything.tolist(), values, strict=True))
        assert sum(10 ** mine[int(k)] for k in every) == pytest.approx(1.0)


def test_nothing_learned_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    row = ppm.score_documents(df, F.lit(True)).first()
    assert (row.train_tokens, row.n_known) == (0, 0) and row.score == pytest.approx(-3 * math.log10(256))
    assert ppm.score_documents(df.limit(0), F.lit(False)).count() == 0


def test_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    table = Lookup(keys, np.arange(len(keys), dtype=float))
    assert (table(keys) == np.arange(len(keys))).all() and np.isnan(table(np.array([7, 8], np.uint64))).all()


def test_code_lengths_by_contexts_do_not_depend_on_the_cut(spark, monkeypatch):
    texts = ["abracadabra " * 40, "banana bandana", "", "x" * 300]
    codes = np.concatenate([ppm.byte_runs([t])[0] for t in texts])
    keys, counts = np.unique(codes.view(np.int64), return_counts=True)
    runs = spark.createDataFrame([(int(k), int(n)) for k, n in zip(keys, counts, strict=True)], "key long, n long")
    whole = {r.key: r.value for r in ppm._code_lengths(runs).collect()}
    monkeypatch.setattr(ppm, "CONTEXT_KEYS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        cut = {r.key: r.value for r in ppm._code_lengths(runs).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert whole.keys() == cut.keys() == set(keys.tolist())
    assert all(cut[k] == pytest.approx(v, abs=1e-12) for k, v in whole.items())
