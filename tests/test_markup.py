import random

from feedback_lens.catalog.pages import rejected_rows
from feedback_lens.functions.markup import Element, Page, path
from feedback_lens.operators.pages import read_blocks, read_lists, read_values

REVIEW = path(Element("div", "data-hook", "review"))
BODY = path(Element("span", "data-hook", "body"))
VOTES = path(Element("span", "class", word="votes"))


def test_nested_elements_keep_their_whole_text():
    page = Page('<span data-hook="body">one <span>two <span>three</span></span> four</span> five')
    assert page.first(BODY) == "one two three four"


def test_a_block_ends_where_its_element_does():
    source = ('<div data-hook="review"><div><span data-hook="body">A<br>B<img src="x"></span></div></div><p>between</p>'
              '<div data-hook="review"><span data-hook="body">C</span><div><div></div></div></div>'
              '<footer><span class="big votes">9 people</span></footer>')  # fmt: skip
    page = Page(source)
    blocks = list(page.matches(REVIEW))
    assert [page.first(BODY, page.inside(b)) for b in blocks] == ["AB", "C"]
    assert [page.first(VOTES, page.inside(b)) for b in blocks] == [None, None]
    assert page.first(VOTES) == "9 people"


def test_implied_ends_and_stray_tags():
    page = Page("<ul><li>1<li>2<ul><li>in</ul><li>3</ul><p>x<p>y<div>z</div></b></p><table><tr><td>a<td>b<tr><td>c</table>")
    assert [page.text(e) for e in page.matches(path(Element("li")))] == ["1", "2in", "in", "3"]
    assert [page.text(e) for e in page.matches(path(Element("p")))] == ["x", "y"]
    assert [page.text(e) for e in page.matches(path(Element("td")))] == ["a", "b", "c"]
    assert [page.text(e) for e in page.matches(path(Element("tr")))] == ["ab", "c"]


def test_what_holds_no_text():
    page = Page('<div>a<!-- <i>no</i> --><script>if (x < 1) "</div>"</script><style>p{}</style>b</div><!-- open')
    assert page.first(path(Element("div"))) == "ab" and page.first(path(Element("i"))) is None


def test_attributes_in_all_notations():
    page = Page("""<a href='x>y' Class="p q" data-n=7 hidden>t &lt; u</a><span alt="5 &amp; 6"></span>""")
    link = next(page.matches(path(Element("a"))))
    assert [link.attribute(n) for n in ("href", "class", "data-n", "hidden", "none")] == ["x>y", "p q", "7", "", None]
    assert page.text(link) == "t < u"
    assert page.first(path(Element("span", "alt"), take="alt")) == "5 & 6"
    assert page.first(path(Element("a", "class", "p"))) is None and page.first(path(Element("a", "class", word="q"))) == "t < u"


def test_paths_go_inside():
    page = Page('<h1>no</h1><div class="w"><a><h1>yes</h1></a></div><h1>later</h1>')
    assert [page.text(e) for e in page.matches(path(Element("div", "class", "w"), Element("h1")))] == ["yes"]


def test_unclosed_and_empty_pages():
    assert Page("").elements == [] and Page("plain & simple").elements == []
    page = Page("<div><span>open <b>still")
    assert page.first(path(Element("span"))) == "open still"
    assert Page("<div" * 5).elements == []


def test_deep_and_long_pages():
    page = Page("<div>" * 3000 + "x" * 200_000 + "</div>" * 3000)
    assert len(page.elements) == 3000 and page.text(page.elements[0]) == "x" * 200_000


def test_pages_of_a_table(spark):
    rows = [(1, "k", '<h1> T </h1><div data-hook="review"><span data-hook="body">a</span></div>'), (2, "k", None), (3, None, ""), (4, "k", "<h1></h1>")]
    pages = spark.createDataFrame(rows, "page_id long, key string, html string")
    got = read_blocks(pages, REVIEW, {"body": BODY}, ["page_id", "key"], {"title": path(Element("h1"))}).collect()
    assert [tuple(r) for r in got] == [(1, "k", 0, " T ", "a")]
    values = read_values(pages, {"title": path(Element("h1"))}).collect()
    assert sorted(map(tuple, values)) == [(1, "T"), (3, None), (4, None)]
    assert read_lists(pages.limit(0), {"b": BODY}, "b").collect() == []


def test_pages_read_for_some_paths_give_the_same():
    rng, wanted = random.Random(2), [path(Element("span", "id", "x")), path(Element("div", "class", word="v"), Element("b")), path(Element("a", "href"), take="href")]
    attributes = ["", "", ' id="x"', ' class="v w"', " /", ' y="a>b"', ' z="', ' href="/q"', " ID=x"]

    def node(depth):
        if rng.random() < 0.3 or depth > 4:
            return rng.choice(["t", "1 &amp; 2", "<", ">", "<!-- <b> -->", ""])
        tag = rng.choice("li ul a span p div td tr table br script b option select LI".split())
        inside = "".join(node(depth + 1) for _ in range(rng.randrange(4)))
        return f"<{tag}{rng.choice(attributes)}>{inside}{rng.choice([f'</{tag}>'] * 6 + ['', '</div>'])}"

    def read(page):
        hits = [[(e.start, e.end, page.value(e, w)) for e in page.matches(w)] for w in wanted]
        return hits, [[page.first(w, page.inside(e)) for w in wanted] for e in page.matches(wanted[1])]

    for _ in range(2000):
        source = "".join(node(0) for _ in range(5))
        assert read(Page(source, wanted)) == read(Page(source)), source


def test_long_lists_take_no_step_per_entry():
    entries = "".join(f'<li class="page"><a href="#">{i}</a></li>' for i in range(5000))
    page = Page(f'<div><ul>{entries}</ul><span class="v">77</span></div>', [path(Element("span", "class", "v")), path(Element("a", "id"))])
    assert [e.tag for e in page.elements] == ["div", "ul", "span"]
    assert page.first(path(Element("span", "class", "v"))) == "77"
    assert page.text(page.elements[1]) == "".join(map(str, range(5000)))


def test_rejected_rows_read_the_pages_once(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = rejected_rows(spark, str(tmp_path))
    assert "MapInArrow" not in found._jdf.queryExecution().toString()
    assert found.collect() == [(200, 4, 196)]
