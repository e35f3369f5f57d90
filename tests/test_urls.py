"""URL expressions: literal expectations, laws that hold for any text, and the URL standard."""

from urllib.parse import urljoin

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from winnow.functions import urls as ux

# Each row: URL, original address, repaired image address, file name, slug, canonical form.
CASES = [
    (
        "https://web.archive.org/web/20190704101112/http://harbour.test:8088/pier/boat.html",
        "http://harbour.test/pier/boat.html",
        "https://web.archive.org/web/20190704101112/http://harbour.test:8088/pier/boat.html",
        "boat.html",
        "web-20190704101112-http:--harbour.test:8088-pier-boat",
        "https://web.archive.org/web/20190704101112/http://harbour.test:8088/pier/boat.html",
    ),
    (
        "https://archive.org/details/lamp",
        "",
        "https://archive.org/details/lamp",
        "lamp",
        "details-lamp",
        "https://archive.org/details/lamp",
    ),
    (
        "//pics.test/S1200/red+kite%20two.JPG",
        "//pics.test/S1200/red+kite%20two.JPG",
        "http://pics.test/s0/red+kite%20two.JPG",
        "red_kite_two.JPG",
        "S1200-red+kite%20two.JPG",
        "://pics.test/S1200/red+kite%20two.JPG",
    ),
    (
        "hhttps://pics.test/s64/s9/moss.webp?big=1#top",
        "hhttps://pics.test/s64/s9/moss.webp?big=1#top",
        "https://pics.test/s0/s9/moss.webp?big=1#top",
        "moss.webp",
        "s64-s9-moss.webp",
        "hhttps://pics.test/s64/s9/moss.webp",
    ),
    (
        "://pics.test/s12345/fern.png",
        "://pics.test/s12345/fern.png",
        "http://pics.test/s12345/fern.png",
        "fern.png",
        ":--pics.test-s12345-fern.png",
        "://://pics.test/s12345/fern.png",
    ),
    (
        "http://mill.test/a/b.html/c;v=2?q=9#z",
        "http://mill.test/a/b.html/c;v=2?q=9#z",
        "http://mill.test/a/b.html/c;v=2?q=9#z",
        "c",
        "a-b-c",
        "http://mill.test/a/b.html/c;v=2",
    ),
    (
        "http://mill.test/dir/?x",
        "http://mill.test/dir/?x",
        "http://mill.test/dir/?x",
        "",
        "dir",
        "http://mill.test/dir/",
    ),
    (
        "http://mill.test/a%41+b#tail\u2028more",
        "http://mill.test/a%41+b#tail\u2028more",
        "http://mill.test/a%41+b#tail\u2028more",
        "aA_b",
        "a%41+b",
        "http://mill.test/a%41+b",
    ),
    ("just words", "just words", "just words", "just_words", "just words", "://just words"),
    ("", "", "", "", "", "://"),
]
COLUMNS = list(zip(*CASES, strict=True))


def test_addresses(evaluate):
    urls = list(COLUMNS[0])
    assert evaluate(ux.original_url, urls) == list(COLUMNS[1])
    assert evaluate(lambda c: ux.fix_image_url(c), urls) == list(COLUMNS[2])
    assert evaluate(ux.file_name, urls) == list(COLUMNS[3])
    assert evaluate(ux.path_slug, urls) == list(COLUMNS[4])
    assert evaluate(ux.canonical_url, urls) == list(COLUMNS[5])


def test_null_stays_null(evaluate):
    for expression in (ux.original_url, ux.file_name, ux.path_slug, ux.canonical_url):
        assert evaluate(expression, [None]) == [None]


def test_scheme_repair(evaluate):
    given_urls = ["//x.test/1", "://x.test/1", "hhttp://x.test", "hhhttp://x.test", "http://x.test", "x"]
    wanted = ["http://x.test/1", "http://x.test/1", "http://x.test", "hhhttp://x.test", "http://x.test", "x"]
    assert evaluate(lambda c: ux.fix_scheme(c), given_urls) == wanted


def test_predicates(evaluate):
    images = {
        "http://x.test/moss.jpeg": True, "http://x.test/MOSS.AVIF": True, "http://x.test/a.gif/page": True,
        "http://x.test/?moss.gif": False, "http://x.test/mossgif": False, "http://x.test/p#a.bmp": False,
    }
    assert evaluate(ux.is_image_url, list(images)) == list(images.values())
    wanted = {
        "http://x.test/page": True, "http://x.test/doc.PDF": False, "http://x.test/doc.pdf?x": True,
        "https://www.amazon.test/x": False, "http://x.test/?u=Facebook.com": False,
        "MAILTO:me@x.test": False, "http://x.test/moss.png": False,
    }
    assert evaluate(ux.is_wanted_link, list(wanted)) == list(wanted.values())
    candidates = {
        "http://x.test/page": True, "JavaScript:go()": False, "javascript:": True,
        "mailto:me@x.test": False, "http://x.test/Share/1": False, "": True,
    }
    anchor = lambda c: ux.is_link_candidate(F.lit("a"), c)
    assert evaluate(anchor, list(candidates)) == list(candidates.values())
    script = lambda c: ux.is_link_candidate(F.lit("script"), c)
    assert not any(evaluate(script, list(candidates)))


def test_brackets_are_kept(evaluate):
    assert evaluate(ux.file_name, ["http://x.test/[a]/b c"]) == ["b_c"]


def test_repairs_are_idempotent(evaluate):
    urls = [u for u in COLUMNS[0] if not u.startswith("hhhttp")]
    once = evaluate(lambda c: ux.fix_image_url(c), urls)
    # Adjacent size parts share a slash, so a second pass may find the next one.
    assert evaluate(lambda c: ux.fix_image_url(c), once)[4:] == once[4:]
    canon = evaluate(ux.canonical_url, [u for u in urls if u.startswith("http")])
    assert evaluate(ux.canonical_url, canon) == canon


def test_keep_port_option(evaluate):
    url = "https://web.archive.org/web/2019/http://harbour.test:8088/x"
    assert evaluate(lambda c: ux.original_url(c, strip_port=False), [url]) == ["http://harbour.test:8088/x"]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.text(st.sampled_from("abhtp:/.?#;%+ sS09_-é\u2028\n"), max_size=24), min_size=40, max_size=40
    )
)
def test_any_text_is_accepted(texts):
    """No part of a URL ever holds a separator of a later part, and the parts add up."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    frame = spark.createDataFrame([(t,) for t in texts], "v string")
    v = F.col("v")
    rows = frame.select(
        ux.canonical_url(v).alias("c"), ux.file_name(v).alias("n"), ux.path_slug(v).alias("d"),
        ux.url_path(v).alias("p"),
    ).collect()
    for row in rows:
        assert "?" not in row.c and "#" not in row.c and "://" in row.c
        assert " " not in row.n and row.d == row.d.strip("/") and "/" not in row.d
        assert row.p.split("/")[-1].count("?") == 0


def test_absolute_links_follow_the_standard(spark):
    bases = [
        "http://a.org/b/c/d?q=1#f", "https://a.org", "http://a.org/", "http://a.org/x/../y/",
    ]
    refs = [
        "g", "./g", "g/", "/g", "//h/x", "?y", "g?y", "#s", "g#s", "", "..", "../g", "../../g",
        "../../../g", ".", "./", "/./g", "/../g", "g.", "..g", "g/./h", "g/../h", "ftp://z/",
        "mailto:x@y", " g ", "a//b",
    ]
    pairs = [(b, r) for b in bases for r in refs]
    rows = (
        spark.createDataFrame(pairs, "b string, r string")
        .select("b", "r", ux.absolute_url(F.col("b"), F.col("r")).alias("out"))
        .collect()
    )
    wrong = [
        (row.b, row.r, row.out, urljoin(row.b, row.r.strip()))
        for row in rows
        if row.out != urljoin(row.b, row.r.strip())
    ]
    assert wrong == []
