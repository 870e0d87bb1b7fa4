import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedback_lens.llm import oracles, topk
from feedback_lens.llm.queries import op11_exact_top_k

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k, scale=64):
    """Plain inner products of Python integers."""

    def whole(x):
        return min(max(math.floor(scale * x), -(2**63)), 2**63 - 1)

    live = [(i, [whole(x) for x in v]) for i, v, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in live:
        if q is None or q % 20:
            continue
        scored = []
        for c, b in live:
            if c != q:
                score = min(max(sum(x * y for x, y in zip(a, b, strict=False)), -(2**63)), 2**63 - 1)
                scored.append((-score, c is None, c))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(q, rank, c, -s) for rank, (s, _, c) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def found(spark, rows, k):
    df = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k)
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    rows = con.execute(oracles.EXACT_TOP_K)
    names = [d[0] for d in rows.description]
    df = op11_exact_top_k(spark, SF)
    assert df.columns == names
    assert sorted(map(tuple, df.collect())) == sorted(rows.fetchall())


def test_ties_repeated_rows_and_copies(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 5) / 8], 0) for i in range(150)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(60)]  # a large group of copies
    rows += [(20, rows[7][1], 0), (20, rows[8][1], 0), (41, rows[7][1], 0), (41, rows[7][1], 0)]
    assert found(spark, rows, 20) == brute(rows, 20)


def test_odd_vectors(spark):
    rows = [(0, [0.5, -0.25, 0.0], None), (20, [], 1), (40, None, 1), (60, [1.0, None, 2.0], 1), (80, [float("nan"), 1.0, 1.0], 1),
            (100, [float("inf"), 1.0, 1.0], 1), (1, [0.7, 0.1], 1), (2, [0.3, 0.2, 0.9, -4.0], 1), (None, [0.5, 0.5, 0.5], 1),
            (3, [-1.0, -0.001, 3.0], 1), (120, [1e300, -1e300, 1.0], 1), (4, [1e300, 1.0, 0.0], 1), (5, [7e9, 7e9, 7e9], 1)]
    assert found(spark, rows, 20) == brute(rows, 20)


def test_few_rows_and_none(spark):
    assert found(spark, [(0, [1.0], 0)], 20) == []
    assert found(spark, [(0, [1.0], 0), (7, [2.0], 0)], 20) == [(0, 1, 7, 64 * 128)]
    assert found(spark, [(1, [1.0], 0)], 20) == []
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []


def test_other_columns_do_not_matter(spark):
    rows = [(i, [i / 7, 1.0], i, i, "x") for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score long, place string")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0, 3).collect()))
    single = [(i, [float(np.float32(x)) for x in v]) for i, v, *_ in rows]
    assert got == sorted(brute(single, 3))
