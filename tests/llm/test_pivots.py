import math

import numpy as np
import pyarrow as pa

from feedback_lens.llm import pivots as pv


def brute(rows, cosine=0.98):
    nodes, links = {}, {}
    for i, vector, label in rows:
        links.setdefault(i, 0)
        if vector and label is not None and all(x is not None and math.isfinite(x) for x in vector) and any(vector):
            v = np.array(vector, float)
            nodes[i] = (v / np.abs(v).max(), label)
    root = {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(nodes)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            (x, s), (y, t) = nodes[a], nodes[b]
            if s == t and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (links[i], find(i)) for i in root}


def corpus(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(40):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 12)):
            v = base + rng.normal(size=16) * rng.choice([0.0, 0.02, 0.05])
            rows.append((v * rng.choice([1.0, 1.0, 3.0])).astype(np.float32).tolist())
    rows = [(i * 5 - 100, v, int(rng.integers(0, 3))) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, [1e-30] * 16, [1e30] * 16, [1.0, 2.0]]
    rows += [(9000 + i, v, 1) for i, v in enumerate(odd)] + [(9100, [1.0] * 16, None), (9101, [2.0, 4.0], 1)]
    return rows


def test_recall_and_precision(spark, monkeypatch):
    for seed, block in ((1, 1024), (2, 8)):
        monkeypatch.setattr(pv, "BLOCK", block)
        rows = corpus(seed)
        df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
        got = {r.vec_id: r for r in pv.near_vectors(df).collect()}
        want = brute(rows)
        assert set(got) == set(want)
        assert all(got[i].n_links <= want[i][0] for i in got)
        assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n for n, _ in want.values())
        assert sum(got[i].component_id == want[i][1] for i in got) >= 0.97 * len(got)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
        assert all(got[i].n_links == 0 for i in (9000, 9001, 9002, 9003, 9004, 9005, 9100))
        assert got[9006].n_links == got[9007].n_links == 1 and got[9101].component_id == 9008


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, pv.near_vectors(df).collect()), key=str)
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)]
    assert pv.near_vectors(df.limit(0)).count() == 0


def test_unit_vectors_of_odd_rows():
    lists = pa.array([[3.0, 4.0], None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1e300, 1e300], [2.0]], pa.list_(pa.float64()))
    got = pv.unit_vectors(lists.slice(0, 9)).to_pylist()
    assert got[0] == [0.6, 0.8] and got[1:7] == [None] * 6 and got[8] == [1.0]
    assert got[7][0] == got[7][1] and abs(got[7][0] - math.sqrt(0.5)) < 1e-15
    assert pv.unit_vectors(lists.slice(7, 2)).to_pylist() == got[7:]
    assert pv.unit_vectors(lists.slice(0, 0)).to_pylist() == []
