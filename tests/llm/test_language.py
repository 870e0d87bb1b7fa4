import random

import numpy as np

from feedback_lens.llm import language as lang

SYLLABLES = {"en": ["the", "ing", "and", "er", "th"], "fr": ["eau", "les", "tion", "é", "ou"], "de": ["sch", "ung", "ei", "ü", "ver"]}


def sentence(rng, name, n):
    return " ".join("".join(rng.choice(SYLLABLES[name]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_bundle_is_the_sum_of_bound_trigrams():
    text = " ab b "
    base = {c: lang.letter_vectors(np.array([ord(c)]))[0].astype(int) for c in "ab "}
    want = sum(np.roll(base[x], 2) * np.roll(base[y], 1) * base[z] for x, y, z in zip(text, text[1:], text[2:], strict=False))
    assert (lang.bundles(["A1b--b!"])[0] == sum(np.roll(base[x], 2) * np.roll(base[y], 1) * base[z] for x, y, z in zip(" a b b ", "a b b ", " b b ", strict=False))).all()
    assert (lang.bundles(["ab b"])[0] == want).all() and not lang.bundles(["", "12"]).any()


def test_long_texts_in_parts(monkeypatch):
    rng = random.Random(1)
    texts = [sentence(rng, "fr", n) for n in (3, 400, 0, 1000)]
    whole = lang.bundles(texts)
    monkeypatch.setattr(lang, "BLOCK_CHARS", 50)
    monkeypatch.setattr(lang, "BLOCK_GRAMS", 7)
    assert (lang.bundles(texts) == whole).all()


def test_held_out_accuracy_and_edge_cases(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, name, 30), name, "s") for i, name in enumerate(sorted(SYLLABLES) * 60)]
    odd = [(900, None, "fr", "s"), (901, "12 !?", "fr", "s"), (902, "é", None, "s"), (903, sentence(rng, "de", 60_000), None, "s")]
    df = spark.createDataFrame([*rows, *odd], "doc_id long, text string, lang string, score string")
    model = lang.learn(df.where("doc_id % 5 <> 0"))
    got = {r.doc_id: r.p for r in df.select("doc_id", lang.predict_column(spark, model)("text").alias("p")).collect()}
    held = [(got[i].lang_pred, name) for i, _, name, _ in rows if i % 5 == 0]
    assert all(a == b for a, b in held)
    assert (got[900].lang_pred, got[900].score) == (got[901].lang_pred, got[901].score) == ("und", 0.0)
    assert got[902].lang_pred == "fr" and got[903].lang_pred == "de" and all(0 <= p.score <= 1 for p in got.values())
    blank = lang.learn(df.limit(0))
    assert df.select(lang.predict_column(spark, blank)("text").alias("p")).where("p.lang_pred <> 'und'").count() == 0
    assert df.limit(0).select(lang.predict_column(spark, model)("text").alias("p")).count() == 0
