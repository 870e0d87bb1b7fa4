import os
import random
import re
from collections import Counter

import duckdb
import pytest

from feedback_lens.llm import collocations, oracles
from feedback_lens.llm.queries import op12_phrase_collocations

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string"


def brute(rows, top, longest, least, share):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        totals[lang] += 0
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    key = lang, tuple(words[i : i + n])
                    counts[key] = counts.get(key, 0) + 1
    out = []
    for lang in totals:
        often = {p: a for (x, p), a in counts.items() if x == lang and len(p) > 1 and a >= least}
        found = []
        for p, a in often.items():
            cuts = []
            for k in range(1, len(p)):
                left, right = counts[lang, p[:k]], counts[lang, p[k:]]
                cuts.append((10**6 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            longer = max((b for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))), default=0)
            if not (longer and 100 * longer >= share * a):
                found.append((-score, -a, " ".join(p).encode(), left, right))
        found.sort()
        out += [(lang, i, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(found[:top], 1)]
    return sorted(out)


def found(spark, rows, **how):
    return sorted(map(tuple, collocations.mine(spark.createDataFrame(rows, SCHEMA), **how).collect()))


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(14)] + ["É", "The", "x.", "a, b", "\tQ", "-"]
    fixed = ["New york city hall", "as soon as possible", "The the the the"]
    rows = [(i, " ".join(rng.choice(words) if rng.random() < 0.85 else rng.choice(fixed) for _ in range(rng.randrange(40))), rng.choice(["en", "en", "fr", None]))
            for i in range(n)]
    return rows + [(n, None, "de"), (n + 1, "", None), (n + 2, "only one", "it"), (n + 2, "only one", "it")]


@pytest.mark.parametrize("longest, least, share", [(2, 3, 50), (3, 2, 50), (4, 2, 60)])
def test_against_brute_force(spark, longest, least, share, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 700)
    monkeypatch.setattr(collocations, "GUESS", 1)
    monkeypatch.setattr(collocations, "FURTHER", 2)
    rows = corpus(longest)
    how = dict(top=25, longest=longest, least=least, share=share)
    assert found(spark, rows, **how) == brute(rows, **how)


def test_chance_bits_cost_nothing(spark, monkeypatch):
    """The smallest table of bits: with many phrases, most bits are set."""
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 15)
    rng = random.Random(4)
    rows = [(i, " ".join(f"{rng.randrange(400)}" for _ in range(200)), "en") for i in range(60)]
    how = dict(top=12, longest=3, least=2, share=50)
    assert found(spark, rows, **how) == brute(rows, **how)


def test_a_phrase_gives_way_only_to_a_frequent_longer_one(spark):
    rows = [(1, "good morning everyone. " * 6 + "good morning. " * 6 + "hello there friend. " * 5 + "hello there. " * 6, "en")]
    phrases = {r[2] for r in found(spark, rows, top=50, longest=3, least=3, share=50)}
    assert "good morning" not in phrases and "hello there" in phrases and "there friend" not in phrases


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert collocations.mine(df).collect() == []
    assert found(spark, [(1, None, None), (2, "a b", "en")]) == []


def test_other_columns_do_not_matter(spark):
    rows = [(i, "big red bus. small blue car", "en") for i in range(12)]
    plain = spark.createDataFrame(rows, SCHEMA)
    more = plain.selectExpr("*", "1 AS n", "'x' AS phrase", "2 AS a", "3 AS score", "4 AS rank")
    assert sorted(map(tuple, collocations.mine(more).collect())) == sorted(map(tuple, collocations.mine(plain).collect()))


def test_long_texts_are_read_in_slices(monkeypatch):
    text = "Ab cdé, fg\thi" * 400 + "x" * 300 + " end"
    whole = collocations.split_words(text.encode())
    monkeypatch.setattr(collocations, "SLICE_BYTES", 50)
    parts = list(collocations.slices(text))
    assert b"".join(parts) == text.encode() and len(parts) > 50
    assert [w for part in parts for w in collocations.split_words(part)] == whole


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3 * 10**12 + 1, 3 * 10**12 + 7, 10**13 + 9
    row = spark.range(1).selectExpr(f"{a}L AS a", f"{left}L AS l", f"{right}L AS r")
    assert row.select(collocations.score_of("a", "l", "r")).first()[0] == 10**6 * a * a // (left * right)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = con.execute(oracles.PHRASE_COLLOCATIONS)
    names = [d[0] for d in rows.description]
    df = op12_phrase_collocations(spark, SF)
    assert df.columns == names
    assert sorted(map(tuple, df.collect())) == sorted(rows.fetchall())
