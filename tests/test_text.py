import os
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from feedback_lens.functions import tokens as tk
from feedback_lens.operators import collocations
from feedback_lens.operators.collocations import adjacent_pairs, merge_bigrams
from feedback_lens.operators.lexicon import explode_tokens, gather_tokens
from feedback_lens.operators.phrases import PATTERNS, match_phrases, noun_phrases
from feedback_lens.operators.spelling import correction_table
from feedback_lens.session import written


def greedy(words, pairs):
    out, i = [], 0
    while i < len(words):
        if i + 1 < len(words) and (words[i], words[i + 1]) in pairs:
            out.append(words[i] + "_" + words[i + 1])
            i += 2
        else:
            out.append(words[i])
            i += 1
    return out


def test_merge_matches_a_plain_loop(spark):
    rng = random.Random(1)
    docs = [(i, [rng.choice("abc") for _ in range(rng.randrange(0, 40))]) for i in range(60)]
    pairs = {("a", "a"), ("a", "b"), ("b", "c")}
    df = spark.createDataFrame(docs, "review_id long, tokens array<string>").repartition(5)
    found = merge_bigrams(df, spark.createDataFrame(list(pairs), "a string, b string"))
    assert {r.review_id: r.tokens for r in found.collect()} == {i: greedy(w, pairs) for i, w in docs}


def test_phrases_match_a_plain_regex(spark):
    rng = random.Random(2)
    docs = [(i, "".join(rng.choice("DANVRPX") for _ in range(rng.randrange(0, 60)))) for i in range(80)]
    docs.append((99, "NP" * 20000 + "N"))
    rows = [(i, t, [f"w{j}" for j in range(len(t))]) for i, t in docs]
    df = spark.createDataFrame(rows, "i long, tags string, words array<string>")
    for kind, pattern in PATTERNS.items():
        found = {r.i: r.ps for r in df.select("i", match_phrases(F.col("words"), F.col("tags"), pattern).alias("ps")).collect()}
        for i, tags, words in rows:
            expected = [" ".join(words[m.start() : m.end()]) for m in re.finditer(pattern.replace("*+", "*"), tags)]
            assert found[i] == expected, (kind, i)


def test_tokenisers(spark):
    df = spark.createDataFrame([("Don't like the Café_42 123 x",)], "t string")
    row = df.select(
        tk.tokenize_topic(F.col("t")).alias("topic"),
        tk.split_punctuation(tk.tokenize_similarity(F.col("t"))).alias("similar"),
        tk.tokenize_cv(F.lit("good_idea ab A1b")).alias("cv"),
    ).first()
    assert row.topic == ["don", "like", "the", "cafe_"]
    assert row.similar == ["do", "not", "like", "the", "café_42", "x"]
    assert row.cv == ["good", "idea", "a1b"]


def test_spelling_by_brute_force(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(3)
    known = {"".join(rng.choice("abcd") for _ in range(rng.randrange(2, 7))): rng.randrange(5, 50) for _ in range(40)}
    words = {"".join(rng.choice("abcd") for _ in range(rng.randrange(2, 8))) for _ in range(60)} - set(known)
    table = correction_table(
        spark.createDataFrame([(w,) for w in words], "w string"), spark.createDataFrame(list(known.items()), "w string, n long")
    )
    expected = {}
    for w in words:
        near = [(distance(w, c), -n, c) for c, n in known.items() if distance(w, c) <= 2]
        if near:
            expected[w] = min(near)[2]
    assert {r.w: r.corrected for r in table.collect()} == expected


def test_spelling_of_long_words(spark):
    """Only the beginning of a word makes strings of deletions; the whole word counts for the distance."""
    long = "abcdefg" + "h" * 2000
    known = spark.createDataFrame([(long, 9), ("abcdefgh", 5), ("x", 7)], "w string, n long")
    words = [long + "yy", "z" + long[:-1], long[:1000], "abcdefg" + "y" * 2000, "bacdefgh", "", "yx"]
    found = {r.w: r.corrected for r in correction_table(spark.createDataFrame([(w,) for w in words], "w string"), known).collect()}
    assert found == {long + "yy": long, "z" + long[:-1]: long, "bacdefgh": "abcdefgh", "": "x", "yx": "x"}


def test_phrases_of_words_with_control_characters(spark):
    rows = spark.createDataFrame([(["\x01", "leak", "pot", "\x02"], "XVNX"), ([], ""), (["a"], "N")], "words array<string>, tags string")
    found = [r.p for r in rows.select(noun_phrases(F.col("words"), F.col("tags")).alias("p")).collect()]
    assert found == [["pot"], [], ["a"]]


def test_reviews_without_tokens_stay(spark):
    base = spark.createDataFrame([(1,), (2,)], "review_id long")
    long = spark.createDataFrame([(1, 1, "b"), (1, 0, "a")], "review_id long, pos int, w string")
    found = {r.review_id: r.tokens for r in gather_tokens(long, base=base).collect()}
    assert found == {1: ["a", "b"], 2: []}


def test_texts_are_cut_into_tokens_once(spark):
    """No filter on the number of tokens beside the explode, which would cut every text once more; nulls and empty texts give no row."""
    df = spark.createDataFrame([(1, "one two one"), (2, ""), (3, None)], "review_id long, comment string").repartition(2)
    docs = df.select("review_id", tk.tokenize_topic(F.col("comment")).alias("tokens"))
    long, pairs = explode_tokens(docs), adjacent_pairs(docs, ["review_id"])
    for made in (long, pairs):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert sorted(map(tuple, long.collect())) == [(1, 0, "one"), (1, 1, "two"), (1, 2, "one")]
    assert sorted(map(tuple, pairs.collect())) == [(1, 0, "one", "two"), (1, 1, "two", "one")]


def test_few_neighbours_are_asked_whether_they_are_collocations(spark, monkeypatch):
    docs = [(i, [f"w{i * 7 % 50 + j}" for j in range(30)]) for i in range(40)]
    df = spark.createDataFrame(docs, "review_id long, tokens array<string>")
    bigrams = spark.createDataFrame([("w1", "w2"), ("w60", "w61"), (None, "w3")], "a string, b string")
    pairs = adjacent_pairs(df, ["review_id"])
    kept = collocations._may_be(pairs, bigrams, ["a", "b"])
    exact = pairs.join(bigrams, ["a", "b"], "left_semi")
    assert kept.columns == pairs.columns
    assert exact.exceptAll(kept.select(*exact.columns)).count() == 0 and kept.count() == exact.count() < pairs.count() / 10
    typed = spark.createDataFrame([(3, "w21", "w22")], "review_id int, a string, b string")  # the reviews' ids are long
    keys = ["review_id", "a", "b"]
    assert collocations._may_be(pairs, typed, keys).count() == pairs.join(typed, keys, "left_semi").count() == 1
    monkeypatch.setattr(collocations, "BITS", 64)  # chance bits cost rows only
    crowded = spark.createDataFrame([(f"w{j}", f"w{j + 1}") for j in range(0, 80, 2)], "a string, b string")
    found = merge_bigrams(df, crowded)
    qualify = {(f"w{j}", f"w{j + 1}") for j in range(0, 80, 2)}
    assert {r["review_id"]: r["tokens"] for r in found.collect()} == {i: greedy(words, qualify) for i, words in docs}


def test_words_and_pairs_are_counted_once(spark, monkeypatch):
    """Sizes and joins read one written table each, and what is left of them goes."""
    made = []
    monkeypatch.setattr(collocations, "written", lambda df: made.append(written(df)) or made[-1])
    docs = spark.createDataFrame([(1, list("abcabcabcabcx")), (1, ["a", None, "b", "b"]), (2, ["q"] * 9), (3, [])], "s long, tokens array<string>")
    found = collocations.score_bigrams(docs, ["s"], 1, 0.1)
    plain = {}
    for s in (1, 2):
        rows = [r["tokens"] for r in docs.filter(F.col("s") == s).collect()]
        words = Counter(w for row in rows for w in row)
        pairs = Counter(p for row in rows for p in zip(row, row[1:]))
        size = len(words) + len(pairs)
        scores = {(s, *p): (n - 1) / (words[p[0]] * words[p[1]]) * size for p, n in pairs.items() if n > 1 and None not in p}
        plain |= {key: score for key, score in scores.items() if score > 0.1}
    assert {(r["s"], r["a"], r["b"]): round(r["score"], 9) for r in found.collect()} == {k: round(v, 9) for k, v in plain.items()}
    assert len(made) == 3 and [os.path.exists(x.path.removeprefix("file:")) for x in made] == [False, False, True]
