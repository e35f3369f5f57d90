"""Corpus build against a brute-force restatement, its options and the command line jobs."""

import gzip
import json
import os
import random
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.functions.text import TERMS
from winnow.operators.captures import results_with_dates
from winnow.operators.pages import extract_pages
from winnow.plans import corpus as cx
from winnow.plans import jobs
from winnow.schemas import LISTING_PAGE
from winnow.sinks import files as out
from winnow.sources import files as rd

CAPTURE = "ord long, target_uri string, status int, content_length long, content string"
POSTS = "post_no long, ptid string, post_title string, text_links array<string>"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(2)
    urls = [f"http://h{i}.org/p?q={i}" for i in range(12)]
    texts = ["sc row", "sc", "ch ch ch", "plain", "row 1 row 2"] + [f"t{i} sc" for i in range(20)]
    captures = []
    for n in range(240):
        url = "http://hot.org/" if n % 3 == 0 else rng.choice(urls)
        if rng.random() < 0.4:
            url = "https://web.archive.org/web/20200101000000/" + url
        text = rng.choice(texts[:5] if rng.random() < 0.5 else texts)
        html = f"<title>x</title><body>{text}</body>"
        captures.append((n, url, rng.choice([200, 200, 301, 404, None]), rng.randint(1, 9), html))
    posts = []
    for n in range(30):
        links = rng.sample(urls + ["http://hot.org/", "http://none.org/"], rng.randint(0, 4))
        posts.append((n, f"{n:05d}", f"title {n}", links))
    return captures, posts


def original(url):
    return url.split("20200101000000/")[-1]


def brute_force(captures, posts, terms):
    joined = []
    for ord_, url, status, length, html in captures:
        if status is None or status > 399:
            continue
        text = "<title>x</title>" + html.split("<body>")[1][:-7]
        for post_no, _, _, links in posts:
            if original(url) in links:
                joined.append((ord_, post_no, original(url), text, terms(text), length))
    seen, once = set(), []
    for row in joined:
        if row[3] not in seen:
            seen.add(row[3])
            once.append(row)
    once.sort(key=lambda r: (r[2], -r[4], -r[5]))
    best = {}
    for row in once:
        best.setdefault(row[2], row)
    return sorted((r[0], r[1], r[2], r[4]) for r in best.values())


def count_terms(text):
    return sum(1 for _ in re.finditer(TERMS, text, re.I | re.M))


@pytest.mark.parametrize("parts", [1, 5])
def test_master_corpus_equals_brute_force(spark, data, parts):
    captures, posts = data
    extracts = cx.text_extracts(spark.createDataFrame(captures, CAPTURE).repartition(parts))
    master = cx.master_corpus(extracts, spark.createDataFrame(posts, POSTS).repartition(parts))
    found = sorted((r.ord, r.post_no, r.origurl, r.term_count) for r in master.collect())
    assert found == brute_force(captures, posts, count_terms)


def odd_captures(captures):
    """With bodies repeated under other URLs, repeated and NULL ``ord``, and NULL bodies."""
    again = [(n + 500, "http://hot.org/", 200, length, html) for n, _, _, length, html in captures[:60]]
    nulls = [(None, *row[1:]) for row in captures[:40]] + [(n + 700, *captures[n][1:4], None) for n in range(20)]
    return captures + again + nulls + captures[100:130]


@pytest.mark.parametrize("mode, match", [("fast", "exact"), ("remove", "canonical"), ("reduce", "exact")])
def test_corpus_of_captures_equals_that_of_all_extracts(spark, data, mode, match):
    captures, posts = data
    frame = spark.createDataFrame(odd_captures(captures), CAPTURE).repartition(3)
    mentions = spark.createDataFrame(posts, POSTS)
    whole = cx.master_corpus(cx.text_extracts(frame, mode), mentions, match, "row_no")
    found = cx.corpus_of_captures(frame, mentions, mode, match=match, row_no="row_no")
    assert found.columns == whole.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))


def test_one_extraction_per_content(spark, data):
    """Of captures of equal content that a post mentions, the first stays; the rest is never extracted."""
    captures, posts = data
    linked = {link for *_, links in posts for link in links}
    firsts = {}
    for ord_, url, status, _, html in captures:
        if status is not None and status <= 399 and original(url) in linked:
            firsts.setdefault(html, ord_)
    frame = spark.createDataFrame(captures, CAPTURE)
    found = cx.first_captures(frame, spark.createDataFrame(posts, POSTS)).collect()
    assert sorted(r.ord for r in found) == sorted(firsts.values()) and len(found) < 40


def test_posts_are_cleaned_before_the_join(spark):
    """Cleaning stands below the join that brings the numbers, so that the scan's tasks share it."""
    from winnow.operators.posts import build_posts

    pages = spark.createDataFrame([], T.StructType([T.StructField("page_idx", T.LongType()), *LISTING_PAGE]))
    plan = build_posts(pages)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert "AS languages" not in "".join(lines[:join]) and "AS languages" in "".join(lines[join:])


def test_lazy_and_stored_extracts_agree(spark, data, tmp_path):
    captures, posts = data
    frame = spark.createDataFrame(posts, POSTS)
    lazy = cx.text_extracts(spark.createDataFrame(captures, CAPTURE))
    lazy.write.parquet(str(tmp_path / "x"))
    kept = spark.read.parquet(str(tmp_path / "x"))
    keys = lambda e: sorted(map(tuple, cx.corpus_keys(e, frame).collect()))
    assert keys(lazy) == keys(kept)


def test_options_of_the_extraction(spark, data):
    captures, _ = data
    frame = spark.createDataFrame(captures, CAPTURE)
    assert cx.text_extracts(frame, max_status=0).count() == len(captures)
    some = cx.text_extracts(frame, min_term_count=2)
    assert {r.term_count >= 2 for r in some.select("term_count").collect()} == {True}
    for mode in ("reduce", "markdown", "remove"):
        row = cx.text_extracts(frame, mode=mode).where("ord = 0").collect()
        assert not row or isinstance(row[0].text, str)
    only = cx.text_extracts(frame, outputs=["text"])
    assert "links" not in only.columns and "text" in only.columns


def test_canonical_match_joins_urls_with_query(spark):
    captures = [(0, "http://h.org/p", 200, 1, "<body>sc</body>")]
    posts = [(0, "00000", "t", ["http://h.org/p?x=1"])]
    extracts = cx.text_extracts(spark.createDataFrame(captures, CAPTURE))
    frame = spark.createDataFrame(posts, POSTS)
    assert cx.master_corpus(extracts, frame).count() == 0
    assert cx.master_corpus(extracts, frame, match="canonical").count() == 1
    with pytest.raises(ValueError):
        cx.master_corpus(extracts, frame, match="fuzzy")


def test_missing_counts_lose_their_url(spark):
    rows = [("u", 1, 5, None), ("u", 2, 5, 0), ("v", 3, None, 9), ("v", 4, 0, 1), ("w", 5, None, None)]
    narrow = spark.createDataFrame(rows, "origurl string, ord int, term_count long, content_length long")
    assert sorted(r.ord for r in cx.best_per_url(narrow).collect()) == [2, 4, 5]


def test_status_filter_reaches_the_scan(spark, data, tmp_path):
    captures, _ = data
    spark.createDataFrame(captures, CAPTURE).write.parquet(str(tmp_path / "c"))
    plan = cx.text_extracts(spark.read.parquet(str(tmp_path / "c")), mode="reduce")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(status,399)" in text


def listing(n_posts, first):
    return {
        "url": "u",
        "num_posts": n_posts,
        "next_page": None,
        "page_data": [
            {
                "post_date": "May 5, 2021",
                "header": {"title_text": f"T {first + i}", "title_link": f"http://b/{first + i}.html"},
                "body": {
                    "parsed": [
                        {
                            "img_link": "//i/s320/a.jpg",
                            "img_attrs": {"src": "hhttp://i/s64/b.png"},
                            "text_link": f"hhttp://site.org/{first + i}",
                            "text_desc": "d",
                        }
                    ],
                    "raw_links": [f"http://site.org/{first + i}?q", "http://youtube.com/x"],
                    "raw_images": [],
                    "raw_text": " Some  French\ntext ",
                },
                "footer": [{"tag": "Korean", "taglink": "/k"}],
            }
            for i in range(n_posts)
        ],
    }


@pytest.fixture
def harvest(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    # two files, the second larger: numbering follows the names, not the sizes
    (folder / "a.json").write_text(json.dumps([listing(2, 0), listing(1, 2)]))
    (folder / "b.json").write_text(json.dumps([listing(40, 3), listing(3, 43)]))
    body = "<html><title>P</title><body><p>" + "sc row word " * 20 + "{}</p></body></html>"
    records = []
    for i in range(5):
        block = f"HTTP/1.1 200 OK\r\n\r\n{body.format(i)}".encode()
        head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://site.org/{i}\r\n"
        records.append(
            gzip.compress(f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")
        )
    (tmp_path / "x.warc.gz").write_bytes(b"".join(records))
    return tmp_path


def test_pages_keep_file_order(spark, harvest):
    from winnow.operators.posts import build_posts

    pages = rd.read_listing_pages(spark, str(harvest / "in"))
    rows = build_posts(pages).orderBy("post_no").collect()
    assert [r.post_title for r in rows] == [f"T {i}" for i in range(46)]
    assert rows[0].ptid == "00000" and rows[-1].ptid == "00045"
    assert rows[0].raw_text == "Some French\\ntext"
    assert rows[0].languages == ["French", "Korean"]
    assert rows[0].body_extracts[0].img_attrs == {"src": "http://i/s0/b.png"}
    assert rows[0].ptid_slug == "00000_0"


def test_build_job(spark, harvest):
    args = [
        "build", "--posts", str(harvest / "in"), "--warc", str(harvest / "x.warc.gz"),
        "--corpus-out", str(harvest / "corpus"), "--labels-out", str(harvest / "labels"),
        "--min-term-count", "3",
    ]
    jobs.run_build(spark, jobs.parser().parse_args(args))
    rows = rd.read_corpus(spark, str(harvest / "corpus")).orderBy("ord").collect()
    assert [(r.origurl, r.ptid, r.title) for r in rows] == [
        (f"http://site.org/{i}", f"{i:05d}", "P") for i in range(5)
    ]
    labels = rd.read_labels(spark, str(harvest / "labels")).orderBy("ptid").collect()
    assert labels[0].text.startswith("<h1><strong>P</strong></h1><p>sc row word")
    jobs.run_images(
        spark,
        jobs.parser().parse_args(
            ["images", "--posts", str(harvest / "in"), "--labels", str(harvest / "labels"),
             "--out", str(harvest / "img")]
        ),
    )
    assert spark.read.parquet(str(harvest / "img" / "post_images")).count() == 2


def test_frontier_job(spark, harvest):
    index = [("http://site.org/3", "20210506000000", "arch/3")]
    spark.createDataFrame(
        index, "original string, timestamp string, archive_url string"
    ).write.parquet(str(harvest / "index"))
    args = [
        "frontier", "--posts", str(harvest / "in"), "--index", str(harvest / "index"),
        "--out", str(harvest / "front"),
    ]
    jobs.run_frontier(spark, jobs.parser().parse_args(args))
    live = rd.read_url_list(spark, str(harvest / "front" / "url_list")).orderBy("ord").collect()
    assert [r.url for r in live] == [f"http://site.org/{i}" for i in range(46)]
    archive = rd.read_url_list(spark, str(harvest / "front" / "archive_url_list")).collect()
    assert [r.url for r in archive] == ["arch/3"]
    assert spark.read.json(str(harvest / "front" / "snapshot_hits")).count() == 46


def test_shared_folder_is_required_and_stages_go(spark, tmp_path):
    from winnow import staging

    frame = spark.range(3)
    staging.drop_stages(spark)
    table = staging.stored(frame, "three")
    assert table.count() == 3
    place = staging._made[-1]
    assert os.path.isdir(place)
    staging.drop_stages(spark)
    assert not os.path.exists(place)
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ValueError, match="checkpoint"):
        staging.new_path(unset, "three")


def test_fetch_results_give_one_row_per_link(spark):
    links = spark.createDataFrame([("d1", "u"), ("d2", "u"), ("d3", "v")], "post_date string, url string")
    results = spark.createDataFrame([(2, "u", "late"), (0, "u", "first"), (1, "u", "mid")], "ord long, url string, r string")
    rows = results_with_dates(results, links).collect()
    assert sorted((r.post_date, r.url, r.r) for r in rows) == [("d1", "u", "first"), ("d2", "u", "first"), ("d3", "v", None)]


def test_url_list_round_trip(spark, tmp_path):
    rng = random.Random(4)
    urls = [f" u{rng.randint(0, 300)} " for _ in range(2000)]
    frame = spark.createDataFrame(list(enumerate(urls)), "ord long, url string").repartition(9)
    out.write_url_list(frame, str(tmp_path / "all"))
    back = rd.read_url_list(spark, str(tmp_path / "all")).orderBy("ord").collect()
    assert [r.url for r in back] == [u.strip() for u in urls]
    out.write_url_list(frame, str(tmp_path / "once"), drop_duplicates=True)
    back = rd.read_url_list(spark, str(tmp_path / "once")).orderBy("ord").collect()
    assert [r.url for r in back] == list(dict.fromkeys(u.strip() for u in urls))


def test_file_export_writes_each_path_once(spark, tmp_path):
    rows = [("http://a", "a/x.md", "old"), ("http://c", "b.md", "é"), ("http://b", "a/x.md", "new")]
    frame = spark.createDataFrame(rows, "origurl string, path string, body string").repartition(3)
    out.write_files(out._last_per_path(frame), str(tmp_path / "out"))
    assert (tmp_path / "out/a/x.md").read_text() == "new"
    assert (tmp_path / "out/b.md").read_text() == "é"


def test_image_paths_and_files(spark):
    rows = [(i, "00001", f"http://h/{i}/a+b.jpg?x", bytes([i]) if i != 2 else None) for i in range(4)]
    frame = spark.createDataFrame(rows, "ord long, ptid string, imgurl string, content binary")
    unique = out.image_paths(frame, "/base", force_unique=True).orderBy("ord").collect()
    assert [r.path for r in unique] == [
        "/base/00001/a_b.jpg", "/base/00001/1_a_b.jpg", "/base/00001/2_a_b.jpg",
        "/base/00001/3_a_b.jpg",
    ]
    kept = out.image_files(frame).collect()
    assert [(r.path, bytes(r.content)) for r in kept] == [("00001/a_b.jpg", b"\x03")]


def plain_names(names):
    """Number of earlier names with the same end before a repeated name; zeros where a row is called so."""
    stored = []
    for i, name in enumerate(names):
        if name not in names[:i]:
            stored.append(name)
            continue
        counts = [sum(n.endswith(name) for n in names[:k]) for k, n in enumerate(names) if n == name]
        number = sum(n.endswith(name) for n in names[:i])
        heads = [n[: -len(name) - 1] for n in names if n.endswith("_" + name)]
        digits = [len(h) for h in heads if h.isdigit()]
        if str(number) in heads:
            number = str(number).zfill(max([len(str(max(counts))), *digits]) + 1)
        stored.append(f"{number}_{name}")
    return stored


@pytest.mark.parametrize("parts", [1, 6])
def test_image_names_are_unique(spark, parts):
    rng = random.Random(5)
    posts = {f"p{k}": [] for k in range(12)}
    some = ["pic.jpg", "1_pic.jpg", "01_pic.jpg", "2_pic.jpg", "mypic.jpg", "1_1_pic.jpg", "007_pic.jpg", "g", "gg", "x.png"]
    for k, names in enumerate(posts.values()):
        names.extend(rng.choice(some[: 2 + k % len(some)]) for _ in range(60 if k == 0 else 14))
    posts["p12"] = ["pic.jpg", "1_pic.jpg", "pic.jpg"]
    rows = [(p, i, n) for p, names in posts.items() for i, n in enumerate(names)]
    rows = [(o, p, i, n) for o, (p, i, n) in enumerate(rows)]
    frame = spark.createDataFrame(
        [(o, p, f"http://h/{o}/{n}") for o, p, _, n in rng.sample(rows, len(rows))], "ord long, ptid string, imgurl string"
    )
    found = out.image_paths(frame.repartition(parts), force_unique=True).orderBy("ord").collect()
    assert len(found) == len(rows) and len({r.path for r in found}) == len(rows)
    expected = [f"{p}/{n}" for p, names in posts.items() for n in plain_names(names)]
    assert [r.path for r in found] == expected
    assert expected[-3:] == ["p12/pic.jpg", "p12/1_pic.jpg", "p12/2_pic.jpg"]


def test_failed_export_leaves_whole_files_only(spark, tmp_path):
    """A task that dies inside a file leaves neither a torn file nor its attempt; a second run completes."""
    good = [(f"d{i % 3}/{i}.txt", f"body {i}") for i in range(30)]
    rows = spark.createDataFrame([*good, ("d0/bad.txt", None)], "path string, body string").coalesce(1)
    folder = tmp_path / "files"
    with pytest.raises(Exception, match="NoneType"):
        out.write_files(rows, str(folder))
    written = {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file()}
    assert written.items() <= dict(good).items()
    out.write_files(rows.where("body IS NOT NULL"), str(folder))
    written = {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file()}
    assert written == dict(good) and not list(folder.glob("_attempts*"))


def test_post_pages_with_damaged_lines(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", [], i, None) for i in range(5)], T.StructType(
        [T.StructField("page_idx", T.LongType()), *LISTING_PAGE]
    ))
    out.write_listing_pages(pages.repartition(3), str(tmp_path / "pages"))
    back = rd.read_listing_pages(spark, str(tmp_path / "pages"), multi_line=False, errors="raise")
    assert sorted(back.collect()) == sorted(pages.collect())
    with pytest.raises(ValueError, match="num_posts"):
        out.write_listing_pages(pages.withColumn("num_posts", F.lit("x")), str(tmp_path / "no"))
    assert not (tmp_path / "no").exists()
    (tmp_path / "bad.json").write_text('{"url": "a", "num_posts": 1}\n{"url": "b", "num\n{"url": "c", "num_posts": "x"}\n')
    read = lambda errors: rd.read_listing_pages(spark, str(tmp_path / "bad.json"), False, errors).orderBy("page_idx")
    assert [(r.url, r._error is None) for r in read("quarantine").collect()] == [("a", True), (None, False), ("c", False)]
    assert [r.num_posts for r in read("null").collect()] == [1, None, None]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read("raise").collect()


def test_unknown_mode_stops():
    with pytest.raises(ValueError, match="unknown mode"):
        extract_pages(None, "slow")


def test_front_matter_is_readable_yaml(spark):
    yaml = pytest.importorskip("yaml")
    row = {
        "title": 'a "q": b', "post_title": None, "raw_text": "x\\ny", "languages": ["French"],
        "tag_list": [], "term_count": 3, "content_length": 12, "url": "http://h/?a=b#c",
    }
    frame = spark.createDataFrame(
        [tuple(row.values())],
        "title string, post_title string, raw_text string, languages array<string>,"
        " tag_list array<string>, term_count int, content_length long, url string",
    )
    text = frame.select(out.front_matter(frame).alias("m")).collect()[0].m
    assert text.startswith("---\n") and text.endswith("---\n\n")
    assert yaml.safe_load(text.split("---")[1]) == row
