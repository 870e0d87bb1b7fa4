import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
import public_tokenizers

import corpus_pipeline as cp
from feedback_lens.llm.common import saved_table
from test_minhash import brute as near_brute
from test_repeats import brute as repeat_brute, text_of


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rng = random.Random(5)
    passage = text_of(rng, 70)
    more = [(10_000 + i, text_of(rng, 50) + passage + text_of(rng, 50), "en", "s", 0) for i in range(4)]
    more += [(10_010, None, "en", "s", 0), (10_011, "12 - 34", "en", "s", 7), (None, "no id here", None, None, None)]
    docs.unionByName(spark.createDataFrame(more, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    seen = {}
    for name, stage in cp.STAGES[:-1]:
        old = docs
        docs = saved_table(stage(spark, old, tables))
        assert docs.columns == columns
        seen[name] = (old.collect(), docs.collect())
    assert {r.doc_id for r in seen["toxicity"][1]} <= before
    gone = {r.doc_id for r in seen["language"][0]} - {r.doc_id for r in seen["language"][1]}
    assert gone == {r.doc_id for r in seen["language"][0] if not any(c.isalpha() for c in r.text or "")}
    old, new = seen["near_duplicates"]
    kept = {i for i, _, _, keep in near_brute([(r.doc_id, r.text) for r in old if r.doc_id is not None], cp.NEAR_PERCENT) if keep}
    assert {r.doc_id for r in new} == kept | {None}
    old, new = seen["repeats"]
    want = {row[0]: row[1] - row[2] for row in repeat_brute([(r.doc_id, r.text) for r in old if r.doc_id is not None])}
    texts = {r.doc_id: r.text for r in new}
    assert {r.doc_id: r.n_chars for r in new} == {i: len(t) for i, t in texts.items()}
    assert all(0 <= want[i] - len(t.encode()) <= 6 * t.count(" ") + 6 for i, t in texts.items() if i is not None)
    packed = cp.STAGES[-1][1](spark, docs, tables).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert sum(r.length for r in packed) == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in texts.values())
    assert {r.doc_id for r in packed} == set(texts)


def test_language_stage_without_languages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rng = random.Random(6)
    other = " ".join("".join(rng.choice("абвгдежзиклмнопрстуфх") for _ in range(rng.randrange(2, 9))) for _ in range(200))
    rows = [(20_000, other, None, "s", 0), (20_001, other[:30], None, "s", 0)]
    more = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    lettered = {r.doc_id for r in more.collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in cp.drop_unknown_language(spark, more, tables).collect()} == lettered
    unlabelled = more.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in cp.drop_unknown_language(spark, unlabelled, tables).collect()} == lettered


def test_empty_table(spark, tables, tmp_path):
    folder = str(tmp_path)
    for name in ("documents", "labels"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert cp.run(spark, folder).count() == 0


def test_language_stage_asks_the_model(spark, tables, monkeypatch):
    """The stage predicts languages with the model of op2; what the model does not determine is rejected."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    learned, learn = [], cp.language.learn
    monkeypatch.setattr(cp.language, "learn", lambda *args: learned.append(learn(*args)) or learned[-1])
    kept = cp.drop_unknown_language(spark, docs, tables)
    assert learned and learned[0].names == sorted(r.lang for r in docs.select("lang").where("lang is not null").distinct().collect())
    names, _ = learned[0].predict([r.text or "" for r in docs.collect()])
    assert kept.count() == sum(name != "und" for name in names) < docs.count()
