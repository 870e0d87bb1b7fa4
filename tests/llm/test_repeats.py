import hashlib
import random

import numpy as np
import pytest

from feedback_lens.llm import repeats as rp
from feedback_lens.llm.suffixes import Shard


def brute(rows, window=rp.WINDOW):
    seen, out = {}, []
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - window + 1):
            part = data[k : k + window]
            if part in seen:
                gone[k : k + window] = True
            else:
                seen[part] = (i, k)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def text_of(rng, n):
    return " ".join(rng.choice(["the", "éa", "ing", "ou", "x"]) + rng.choice(["", "a", "b", "ß"]) for _ in range(n))


def corpus(rng):
    passages = [text_of(rng, 60) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [text_of(rng, rng.randrange(0, 40)) for _ in range(3)]
        if rng.random() < 0.5:
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            parts.insert(1, p[a : a + rng.randrange(50, 300)])
        if rng.random() < 0.1:
            parts.append("ab" * 200)
        if rng.random() < 0.1:
            parts += parts
        rows.append(("".join(parts)))
    rows += [rows[3], rows[3], rows[5] + "x", "y" + rows[5], None, "", "z" * 99, "z" * 100, "z" * 101, "漢" * 80, "漢" * 80]
    rng.shuffle(rows)
    return [(i * 7 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_brute_force(spark, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(rp, "SHARD_BYTES", 3000)
        monkeypatch.setattr(rp, "PART", 150)
        monkeypatch.setattr(rp, "SORT_MEMORY", 2000)
    rows = corpus(random.Random(seed))
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, spans string")
    got = sorted(tuple(r)[:5] for r in rp.without_repeats(df).collect())
    assert got == brute(rows)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(tuple(r)[:5] for r in rp.without_repeats(df).collect()) == brute(rows)


def test_texts_and_edge_cases(spark):
    long = "q w e r t y " * 40_000 + "end"
    rows = [(1, "a" * 150), (2, "b" + "a" * 120 + "c"), (None, "a" * 150), (3, long), (3, None), (4, "short"), (5, "short"), (5, "short")]
    df = spark.createDataFrame([(*r, "s", 3) for r in rows], "doc_id long, text string, source string, n_chars int")
    got = rp.texts_without_repeats(df)
    assert got.columns == df.columns
    texts = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert [t for i, t in texts if i == 3 and t] == [brute_text(long)]
    assert [x for x in texts if x[0] != 3] == sorted([(1, brute_text("a" * 150)), (2, "bc"), (None, ""), (4, "short"), (5, "short"), (5, "short")], key=str)
    assert (3, None) in texts and rp.without_repeats(df.limit(0)).count() == 0


def brute_text(text, window=rp.WINDOW):
    seen, gone = set(), [False] * len(text)
    for k in range(len(text) - window + 1):
        if text[k : k + window] in seen:
            gone[k : k + window] = [True] * window
        seen.add(text[k : k + window])
    return "".join(c for c, g in zip(text, gone, strict=True) if not g)


def sorted_brute(strings, limit):
    line = [x for s in strings for x in [*(b + 2 for b in s), 1]] + [0]
    return line, sorted(range(len(line)), key=lambda i: line[i : i + limit])


def test_suffixes_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(150):
        limit, letters = rng.choice([4, 100]), rng.choice([1, 2, 3, 200])
        strings = [bytes(rng.randrange(letters) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(1, 8))]
        shard = Shard(limit, memory=rng.choice([200, 1 << 20]))
        for s in strings:
            shard.add([s])
        parts = list(shard.sorted())[::-1]
        shard.close()
        order, shared = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        line, want = sorted_brute(strings, limit)
        assert sorted(order.tolist()) == list(range(len(line)))
        assert [line[i : i + limit] for i in order] == [line[i : i + limit] for i in want]
        for k in range(1, len(order)):
            a, b, same = line[order[k - 1] :], line[order[k] :], 0
            while same < min(len(a), len(b), limit) and a[same] == b[same]:
                same += 1
            assert same == shared[k]
