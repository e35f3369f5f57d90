"""Page extraction: native expressions, tree rules, post harvest."""

import pytest

from winnow.functions import harvest, html as hx, markup
from winnow.operators import pages as pg

PAGE = """<html><head><!-- <title>old</title> --><title> T &amp; x </title>
<script>var a="<body>";</script><style>p{}</style></head>
<body class=x><p>one&nbsp; <b>two</b> <!-- hidden --> 3 &lt; 4</p><script>if (a<b) {}</script>
<a href='/x?a=1&amp;b=2'>X <i>y</i></a> <a href="x#y">second</a><a href="/x?a=1&b=2">again</a>
<a name="n">no link</a><a href="mailto:me">m</a><a href="http://o.org/share">s</a>
<img src="i.png" ALT='a "b"' width=3 hidden src=other><IMG SRC=//cdn/j.png>
</body><p>late</p></html>"""


@pytest.fixture
def page(spark):
    rows = [(0, "http://h.org/d/p.html", PAGE), (1, "http://h.org/e", ""), (2, "http://h.org/f", None)]
    return spark.createDataFrame(rows, "ord long, url string, content string")


def first(frame):
    return frame.where("ord = 0").collect()[0]


def test_fast_mode(page):
    rows = {r.ord: r for r in pg.extract_pages(page, "fast").collect()}
    row = rows[0]
    assert row.text.startswith("<title>T & x</title>one two 3 < 4 X y second again no link m s")
    assert row.text.endswith("late") and "hidden" not in row.text
    assert row.links == ["http://h.org/x?a=1&b=2", "http://h.org/d/x#y"]
    assert row.link_texts == ["X y", "second"]
    assert row["images"] == [
        {"src": "http://h.org/d/i.png", "alt": 'a "b"', "width": "3", "hidden": ""},
        {"src": "http://cdn/j.png"},
    ]
    for empty in (rows[1], rows[2]):
        assert (empty["images"], empty.links, empty.link_texts, empty.text) == ([], [], [], "")


def test_title_switch(page):
    assert first(pg.extract_pages(page, "fast", title_in_body=False)).text.startswith("T & x") is False
    plain = first(pg.extract_pages(page, "remove"))
    assert plain.text.startswith("T & x one two 3 < 4")
    assert plain.text.endswith("late")


def test_described_links(page):
    links = first(pg.extract_pages(page, "remove")).links
    assert [(r.link, r.desc) for r in links] == [
        ("http://h.org/x?a=1&b=2", "X  y|again"),
        ("http://h.org/d/x#y", "second"),
        ("http://o.org/share", "s"),
    ]


def test_quoted_values_and_bare_signs(evaluate):
    pages = [
        "<p title='x > y'>shown</p>", "a < b and c > d then e", "<p title=\"don't\">x</p><p a='2 \">'>y",
        "<a title='a > b' href='/x'>one</a>", "x <3 y", "<p class=a=b>z</p>", "<i>never closed", "<a x='y>t</a>",
    ]
    assert evaluate(hx.fast_text, pages) == [
        "shown", "a < b and c > d then e", "x y", "one", "x <3 y", "z", "never closed", "t",
    ]


def test_adjoining_elements_have_no_empty_pieces(spark):
    page = "<a href='/y' title='p > q'><b>one</b><i>two</i></a><img alt='m > n' src='/i.png' class=k>"
    frame = spark.createDataFrame([(0, "http://h.org/", page)], "ord long, url string, content string")
    row = first(pg.extract_pages(frame, "remove"))
    assert [(r.link, r.desc) for r in row.links] == [("http://h.org/y", "one two")]
    assert row["images"] == [{"alt": "m > n", "src": "http://h.org/i.png", "class": "k"}]


def test_page_without_body_or_title(evaluate):
    assert evaluate(hx.fast_text, ["<p>a<p> b", "just text", "<TITLE>q</TITLE>x"]) == [
        "a b", "just text", "<title>q</title>x",
    ]


def test_many_tags_and_blanks_need_no_stack(evaluate):
    page = "<td></td>" * 100_000 + " " * 100_000 + "<p>end"
    assert evaluate(hx.fast_text, [page]) == ["end"]


def test_base_element_moves_links(spark):
    html = "<base href='http://other.org/k/'><a href='z'>z</a>"
    frame = spark.createDataFrame([(0, "http://h.org/", html)], "ord long, url string, html string")
    assert [r.link for r in pg.page_links(frame).collect()] == ["http://other.org/k/z"]


def test_unknown_mode_is_an_error(page):
    with pytest.raises(ValueError):
        pg.extract_pages(page, "tokens")


def test_main_content_keeps_long_blocks(evaluate):
    long = "word " * 45
    page = f"<body><nav><a href=/a>{long}</a></nav><p>{long}</p><div>short</div></body>"
    assert evaluate(hx.main_content, [page]) == [f"<p>{long.strip()}</p><p>short</p>"]
    assert evaluate(hx.simplified_page, [None]) == [""]


def reduced(html, **options):
    return markup.reduced_html(html, "http://h.org/d/", **options)


def test_reduce_rules():
    assert reduced("<html><head><title> T </title></head><body><p>x</p></body></html>") == (
        "<head><title>T</title></head><h1><strong>T</strong></h1><p>x</p>"
    )
    assert reduced("<div><div> a <b></b></div></div>") == "<div> a </div>"
    assert reduced("<section><p>a</p><p>b</p></section>") == "<p>a</p><p>b</p>"
    assert reduced("<section>a</section>") == "<section>a</section>"
    assert reduced("<h2> a <i> b</i></h2><script>x</script><!-- c -->") == "<h2>a<i> b</i></h2>"
    styled = "<p style='color: red;margin:0;font-weight:bold' id=q>a<br>b</p>"
    assert reduced(styled) == '<p style="color: red;font-weight:bold">a<br/>b</p>'
    link = "<p>x <a href='y' class=c>t</a> <a href='ftp://z'>u</a><img src=i.png id=1></p>"
    assert reduced(link) == "<p>x t u</p>"
    assert reduced(link, text_only=False) == (
        '<p>x <a href="http://h.org/d/y">t</a> u<img src="http://h.org/d/i.png"/></p>'
    )
    assert reduced("") == ""
    assert reduced("a &lt; b &amp; c") == "a &lt; b &amp; c"


def test_reduce_survives_deep_and_wide_pages():
    assert reduced("<b>" * 5000 + "x").count("<b>") == 5000
    assert reduced("<p></p>" * 50_000 + "x") == "x"


def test_markdown_rules():
    html = (
        "<html><head><title>T</title></head><body><h2>Head</h2><p>a <b>bold</b> <i>it</i>"
        "<ul><li>one<li>two</ul><a href='y'>link</a><img src=i.png alt=A></body></html>"
    )
    text = markup.markdown(html, "http://h.org/d/", True, True)
    assert text.startswith("# **T**\n\n## Head\n\na **bold** _it_")
    assert "  * one" in text and "link" in text and "](" not in text
    linked = markup.markdown(html, "http://h.org/d/", False, True)
    assert "[link](http://h.org/d/y)" in linked and "![A](http://h.org/d/i.png)" in linked


LISTING = """<div class="blog-posts"><h2 class='date-header'>May 5, 2021</h2>
<div class='post'><h3 class='post-title'><a href='/p1'>One</a></h3><div class='post-body'>
<div class='separator'><a href='/i1'><img src='/s320/1.jpg' alt=q></a></div>By
<a href='/w1'>anna</a>, free<a href='/w1'>more</a></div>
<div class='post-footer'><span class='post-labels'><a href='/t'>bear</a></span></div></div>
<div class='post'><div class='post-body'>no picture, no title</div>
<div class='post-footer'></div></div>
<div class='post'><h3 class='post-title'>broken</h3></div></div><a href='/next'>Older Posts</a>"""


def test_harvest_reads_posts_and_sets_failures_aside(spark):
    frame = spark.createDataFrame([(0, "u", LISTING)], "page_idx long, url string, html string")
    row = harvest.harvest_posts(frame).collect()[0]
    one, two = row.page_data
    assert (row.num_posts, row.next_page) == (3, "/next")
    assert [(f.post_idx, f.error) for f in row.failed] == [(2, "IndexError")]
    assert (one.post_date, one.header.title_text, one.header.title_link) == (
        "May 5, 2021", "One", "/p1",
    )
    item = one.body.parsed[0]
    assert (item.img_link, item.text_link, item.text_desc) == ("/i1", "/w1", "Byanna, free")
    assert item.img_attrs == {"src": "/s320/1.jpg", "alt": "q"}
    assert one.body.raw_links == ["/i1", "/w1"] and one.body.raw_images == ["/s320/1.jpg"]
    assert one.footer[0].tag == "bear"
    assert two.header.title_text == "" and two.body.parsed == [] and two.footer == []


def test_harvest_layout_is_a_parameter(spark):
    page = LISTING.replace("blog-posts", "feed")
    frame = spark.createDataFrame([(0, "u", page)], "page_idx long, url string, html string")
    assert harvest.harvest_posts(frame).collect()[0].num_posts == 0
    assert harvest.harvest_posts(frame, {"posts": "feed"}).collect()[0].num_posts == 3


def test_classified_links(spark):
    html = "<a href='/a'>1</a><img src='http://o.org/b.png'><link href='/c'><a href='javascript:x'>"
    frame = spark.createDataFrame([(0, "http://h.org/", html)], "ord long, url string, html string")
    rows = pg.classify_links(frame).orderBy("pos").collect()
    assert [(r.image, r.internal, r.schemeok, r.link) for r in rows] == [
        (False, True, True, "http://h.org/a"),
        (True, False, True, "http://o.org/b.png"),
    ]


def _links(spark, html, url="http://h.org/d/p"):
    frame = spark.createDataFrame([(0, url, html)], "ord long, url string, html string")
    return [(r.link, r.link_text) for r in pg.page_links(frame).orderBy("pos").collect()]


@pytest.mark.parametrize(
    ("html", "wanted"),
    [
        ('<a title="see href=/bad" href="/good">t</a>', [("/good", "t")]),
        ("<a title='x' data-href='/no'>t</a>", []),
        ('<a href="/u">open <p>x</p> .. <a href=/v>v</a>', [("/u", "open x ..", ), ("/v", "v")]),
        ("<a href=/x>one <a href=/y>two</a> three</a>", [("/x", "one"), ("/y", "two")]),
        ("<a href=/x>one <abbr>two</abbr> <b title='</a>'>three</b></a> four", [("/x", "one two three")]),
        ("<a href=/x>one<a>two</a>", [("/x", "one")]),
        ("<a href=/x>one", [("/x", "one")]),
        ("<a href=/x", []),
        ("<a href>none</a><a href=>none</a><a href=''>own</a>", [("", "own")]),
        ("<A HREF = '/x' href='/y'>t</A\n>", [("/x", "t")]),
        ("<a\nhref=/a/b/>t</a foo>", [("/a/b/", "t")]),
        ("<a href=/x>a < b</a> <a href=/y", [("/x", "a < b")]),
        ("<a class=c/href=/x>t</a>", []),
        ("<a class='c'href=/x>t</a>", [("/x", "t")]),
    ],
)
def test_anchors_are_read_like_a_page_reader_does(spark, html, wanted):
    found = _links(spark, f"<body>{html}", "http://h.org/d/p")
    assert found == [("http://h.org" + link if link else "http://h.org/d/p", text) for link, text in wanted]


def test_base_is_the_first_href_of_the_base_element(spark):
    html = "<base title='href=/no' href=\" http://b.org/k/ \"><a href=z>t</a>"
    assert _links(spark, html) == [("http://b.org/k/z", "t")]


def test_hostile_anchors_are_read_in_linear_time(spark):
    long = 200_000
    pages = [
        "<a href=/x>" * (long // 11), "<a href=/x>" + "<" * long, "<a " + "b=c " * (long // 4) + "href=/x>t</a>",
        "<a href='" + "x" * long, "<a " + "href " * (long // 5) + ">t</a>", "<a href=/x>" + "<b " * (long // 3),
        "<a" + " a='" * (long // 4) + ">", "<a href=/x>" + "</a" * (long // 3), "<base " + "x" * long,
    ]
    frame = spark.createDataFrame([(i, "http://h.org/", p) for i, p in enumerate(pages)], "ord long, url string, html string")
    found = {(r.ord, r.link) for r in pg.page_links(frame).collect()}
    assert {(0, "http://h.org/x"), (1, "http://h.org/x"), (2, "http://h.org/x")} <= found
    assert pg.classify_links(frame).count() >= 3
