import datetime as dt

from pyspark.sql import functions as F

from feedback_lens.functions import normalize as nz
from feedback_lens.functions.markup import Element, path
from feedback_lens.operators.pages import last_page, read_blocks, read_lists, url_tail, valid_rows


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first().y


def test_ratings(spark):
    assert one(spark, "4.0 out of 5 stars", nz.parse_rating) == 4.0
    assert one(spark, "Rating: 3 out of 5 stars", nz.parse_rating) == 3.0
    assert one(spark, "", nz.parse_rating) is None
    assert one(spark, "Average Rating: 5 out of 5", lambda c: nz.parse_rating(c, "Walmart")) == 5.0


def test_votes(spark):
    assert one(spark, "1,204 people found this helpful", nz.parse_usefulness) == 1204
    assert one(spark, "One person found this helpful", nz.parse_usefulness) == 1
    assert one(spark, None, nz.parse_usefulness) == 0


def test_dates(spark):
    assert one(spark, "on October 3, 2018", nz.parse_date) == dt.date(2018, 10, 3)
    assert one(spark, "October 3 2018", nz.parse_date) == dt.date(2018, 10, 3)
    assert one(spark, "3 Oct", nz.parse_date) is None
    as_of = F.lit("2018-12-31").cast("date")
    assert one(spark, "2 months ago", lambda c: nz.parse_relative_date(c, as_of)) == dt.date(2018, 10, 31)
    assert one(spark, "1 month ago", lambda c: nz.parse_relative_date(c, as_of)) == dt.date(2018, 11, 30)


def test_dates_below_a_day(spark):
    as_of = F.lit("2018-12-31").cast("date")
    for text, day in (("3 hours ago", 31), ("1 minute ago", 31), ("50 hours ago", 29), ("10 seconds ago", 31), ("2 days ago", 29)):
        assert one(spark, text, lambda c: nz.parse_relative_date(c, as_of)) == dt.date(2018, 12, day)


def test_entities(spark):
    text = "&#8217;&#x27;&eacute;&amp;lt;&lt;&bogus;&#0;&#x1F600; a & b &nbsp;;"
    assert one(spark, text, nz.strip_tags) == "’'é&lt;<&bogus;\ufffd😀 a & b  ;"
    assert one(spark, "&apos;&check;&copy 1 &copycat &notin; &notit &AMP", nz.strip_tags) == "'✓© 1 ©cat ∉ ¬it &"
    assert one(spark, None, nz.strip_tags) is None and one(spark, "&", nz.strip_tags) == "&"


def test_text_fields(spark):
    assert one(spark, "<b>a &amp; b</b>", nz.strip_tags) == "a & b"
    assert one(spark, "Acme - Brewer", nz.brand_from_name) == "Acme"
    assert one(spark, "a/b/c.p?x=1#y", lambda c: url_tail(c, 2)) == "b/c"


def test_blocks_and_lists(spark):
    html = '<div class="r"><i>1</i><div>x</div></div><div class="r"><b>no</b></div>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    block, field = path(Element("div", "class", "r")), {"n": path(Element("i"))}
    rows = read_blocks(pages, block, field).orderBy("pos").collect()
    assert [r.n for r in rows] == ["1", None]
    assert valid_rows(read_blocks(pages, block, field), ["n"]).count() == 1
    lists = spark.createDataFrame([(1, "<i>1</i><i>2</i><b>x</b><b>y</b><b>z</b><u>p</u>")], "page_id long, html string")
    fields = {"i": path(Element("i")), "b": path(Element("b"))}
    assert read_lists(lists, fields, "i").count() == 2
    assert read_lists(lists, {**fields, "u": path(Element("u"))}, "i").count() == 1


def test_last_page_default(spark):
    pages = spark.createDataFrame([("a", "<li>2</li><li>7</li>"), ("b", "none")], "key string, html string")
    found = {r.key: r.last_page for r in last_page(pages, "<li>([0-9]+)</li>").collect()}
    assert found == {"a": 7, "b": 1}
