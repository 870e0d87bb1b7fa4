"""Tokenisers against plain filters over all runs, for every character."""

import pytest
from pyspark.sql import functions as F

from feedback_lens.functions import tokens as tk


def plain_topic(col):
    accented, bare = tk.accent_table()
    stripped = F.translate(F.regexp_replace(F.lower(col), r"\p{Mn}", ""), accented, bare)
    runs = F.regexp_extract_all(stripped, F.lit(tk.TOPIC_TOKEN), F.lit(0))
    return F.filter(runs, lambda w: F.length(w).between(2, 15) & ~F.startswith(w, F.lit("_")))


def plain_similarity(col):
    words = F.split(F.trim(F.regexp_replace(F.lower(col), r"\s+", " ")), " ")
    return F.filter(words, lambda w: (w != "") & ~F.rlike(w, F.lit("^[0-9]+$")))


@pytest.mark.parametrize(("cut", "plain"), [(tk.tokenize_topic, plain_topic), (tk.tokenize_similarity, plain_similarity)])
def test_tokens_need_no_call_per_word(spark, cut, plain):
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    rows = [" ".join(chars[i : i + 500]) + " " + "".join(chars[i : i + 500]) for i in range(0, len(chars), 500)]
    rows += [" ".join(f"12{c}" for c in chars[i : i + 500]) for i in range(0, 0x3000, 500)]
    rows += [f"{u}{w * n} {w * n}" for n in range(18) for w in ("a", "é", "e\u0301", "𝐚", "中") for u in ("", "_", "x_", "7", "\u0301")]
    rows += ["", None, " ", "__", "a_b _c d_", "1 22 3a a3 4.5 6\x85 7\u2028 8\x85\x85 9\u2029x \x85 \t10\n11\r\n"]
    df = spark.createDataFrame([(row,) for row in rows], "t string")
    found = df.select("t", cut(F.col("t")).alias("found"), plain(F.col("t")).alias("plain"))
    assert found.filter(~F.col("found").eqNullSafe(F.col("plain"))).count() == 0
    assert "lambda" not in df.select(cut(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
