import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchlake.operators import extract, markup


def test_url_and_page_edge_cases(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://h.example/team/9996/alpha", '<title>T</title><a href="/a">A</a><a href="/b">B</a>'),
            (2, "x", "<p>no title, no link</p>"),
            (3, "http://h.example/", '<a href="/only">header</a>'),
        ],
        "page_id long, url string, html string",
    )
    u = {r.page_id: tuple(r)[1:] for r in extract.url_fields(pages).collect()}
    assert u[1] == ("h.example", "9996", "9996", "alpha")
    assert u[2] == ("", "", "", "x")
    assert u[3] == ("h.example", "", "h.example", "")
    p = {r.page_id: tuple(r)[1:] for r in extract.page_fields(pages).collect()}
    assert p[1] == ("T", "", 2, "/a") and p[2] == ("", "", 0, None)
    pairs = sorted(tuple(r) for r in extract.link_pairs(pages).collect())
    assert pairs == [(1, 0, "/b", "B")]  # the first anchor is the header; page 3 has only it


def test_veto_line_rules(spark):
    lines = spark.createDataFrame(
        [
            ("m", "1. Alpha removed Nuke", False),
            ("m", "3. Beta picked Dust2", False),
            ("m", "7. Inferno was left over", False),
            ("m", "5. Mirage was left over", False),
            ("m", "4. Alpha picked Mirage in the first round today", True),
            ("m", "6. Beta removed Ancient in the first round today", False),
        ],
        "match_id string, line string, one_block boolean",
    ).selectExpr("*", "'1' AS team1_id", "'Alpha' AS team1_name", "'2' AS team2_id", "'Beta' AS team2_name")
    got = [tuple(r)[1:] for r in extract.parse_veto_lines(lines).collect()]
    assert got == [
        ("ban", "1", "Nuke", "1"),
        ("pick", "3", "Dust2", "2"),
        ("pick", "7", "Inferno", None),
        ("pick", "5", "over", None),      # no team, not choice 7: last token
        ("pick", "4", "Mirage", "1"),     # single block, > 8 tokens: 6th from the end
        ("ban", "6", "today", "2"),       # not a single block: last token
    ]


def cut_by_hand(html, tag, cls):
    """Elements of a tag and class by a stack of open tokens."""
    out, open_ = [], []
    for m in re.finditer(rf"(?is)<{tag}(?=[\s>])([^>]*)>|</{tag}\s*>", html):
        if m.group(0).startswith("</"):
            if open_:
                out.append((*open_.pop(), m.end()))
        elif not m.group(0).endswith("/>"):
            names = re.search(r'(?:^|\s)class="([^"]*)"', m.group(1) or "")
            open_.append((m.start(), (names.group(1) if names else "").split()))
    out += [(start, names, len(html)) for start, names in open_]
    return [html[start:end] for start, names, end in sorted(out) if cls is None or cls in names]


def test_elements_inside_elements(spark):
    pages = [
        '<div class="a">x</div>', '<div class="a"><div>y</div>z</div>tail', 'no element', '', None, '<div class="a">never <div>closed</div>',
        '<p>t</p><DIV id="1" class="b a"><div class="a c">in</div></DIV ><div class="ab">no</div><div class="a">last</div>',
        '</div><div class="a">after a stray end</div>', '<div class="a"/><div class="a">x</div>', '<divider class="a">no</divider>',
        "<div\nclass=\"a\">line\n<div\n>two</div>\n</div>", '<div class="x"><div class="a"><div class="a">deep</div></div></div>' * 3,
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = df.select("i", markup.elements(F.col("html"), "div", "a").alias("a"), markup.elements(F.col("html"), "div").alias("d"))
    for r in got.collect():
        page = pages[r.i]
        assert (r.a, r.d) == ((None, None) if page is None else (cut_by_hand(page, "div", "a"), cut_by_hand(page, "div", None))), page


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(['<div>', '<div class="a">', '</div>', "x", "<p>", '<div class="b a" id="1">', "<div/>"]), max_size=14), max_size=20))
def test_elements_of_any_nesting(spark, parts):
    pages = ["".join(p) for p in parts]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    for r in df.select("i", markup.elements(F.col("html"), "div", "a").alias("a")).collect():
        assert r.a == cut_by_hand(pages[r.i], "div", "a"), pages[r.i]


def test_text_of_elements(spark):
    html = '<div class="n"> <div>two</div> <b>words</b> </div>'
    df = spark.createDataFrame([(html,), ("",)], "html string")
    assert [r[0] for r in df.select(markup.first_text(F.col("html"), "div", "n")).collect()] == ["two words", None]


def test_counted_and_first_elements_are_those_that_are_cut(spark):
    pages = ['<div class="a"><div>y</div><div class="a">z</div></div></div><div class="a">open', "</div>", "", None, "<p>t</p>" + "<div>" * 30 + "</div>" * 29]
    df = spark.createDataFrame([(p,) for p in pages], "html string").withColumn("p", markup.pieces(F.col("html"), "div"))
    for cls in (None, "a"):
        got = df.select(
            markup.elements(F.col("html"), "div", cls).alias("all"), markup.count_elements(F.col("p"), "div", cls).alias("n"),
            markup.first_element(F.col("p"), "div", cls).alias("first"),
        ).collect()
        for r in got:
            if r.all is not None:
                assert (r.n, r.first) == (len(r.all), r.all[0] if r.all else None)
            else:
                assert r.first is None
