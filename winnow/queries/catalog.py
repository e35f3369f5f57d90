"""Registered queries: one per operator, each over its whole tables."""

from __future__ import annotations

import gzip
from itertools import chain, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.functions import html as hx
from winnow.functions import text as tx
from winnow.functions import urls as ux
from winnow.operators import captures as cap
from winnow.operators import pages as pg
from winnow.operators import posts as po
from winnow.operators.ordering import keep_first_wide, ordered_distinct as distinct_in_order
from winnow.operators.snapshots import nearest_snapshot as nearest
from winnow.plans import corpus as cx
from winnow.plans import frontier as fx
from winnow.queries import inputs as src
from winnow.schemas import SNAPSHOT_FIELDS
from winnow.sinks import files as out
from winnow.sources import files as rd
from winnow.sources import warc
from winnow.sources.warc_records import decoded_body
from winnow.staging import new_path, stored

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _joined(name: str):
    return F.array_join(name, "|").alias(name)


def _pages(spark, sf_dir):
    return src.odd_pages(spark, sf_dir)


def _documents(spark, sf_dir):
    return src.table(spark, sf_dir, "documents")


def _pictures(spark, sf_dir):
    return src.page_pictures(spark, sf_dir)


def _sha(name: str, alias: str):
    return F.sha2(F.col(name), 256).alias(alias)


# --- URL expressions ----------------------------------------------------------


def _url_query(name, expression):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        forms = src.url_forms(spark, sf_dir)
        return forms.select("page_id", "form", expression(F.col("url")).alias("result"))

    run.__name__ = name
    QUERIES[name] = run


_url_query("original_url", ux.original_url)
_url_query("image_full_size", ux.full_size_image)
_url_query("fix_scheme", ux.fix_scheme)
_url_query("fix_image_url", ux.fix_image_url)
_url_query("url_file_name", ux.file_name)
_url_query("url_slug", ux.path_slug)
_url_query("canonical_url", ux.canonical_url)


def _url_filter(name, predicate):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        forms = src.url_forms(spark, sf_dir)
        return forms.where(predicate(F.col("url"))).select("page_id", "form", "url")

    run.__name__ = name
    QUERIES[name] = run


_url_filter("image_url_filter", ux.is_image_url)
_url_filter("link_filter", ux.is_wanted_link)


@query
def link_candidates(spark, sf_dir):
    forms = src.url_forms(spark, sf_dir)
    tagged = forms.withColumn(
        "tag",
        F.when(F.col("form") == 5, "link").when(F.col("form") == 6, "img").otherwise("a"),
    )
    return tagged.where(ux.is_link_candidate(F.col("tag"), F.col("url"))).select(
        "page_id", "form", "tag", "url"
    )


@query
def split_archived(spark, sf_dir):
    forms = src.url_forms(spark, sf_dir).where(F.col("url").isNotNull())
    side = F.when(ux.is_snapshot(F.col("url")), "archived").otherwise("live")
    return forms.select("page_id", "form", side.alias("side"))


@query
def image_fallback(spark, sf_dir):
    forms = src.url_forms(spark, sf_dir).withColumn("ok", F.contains("url", F.lit("#")))
    return cap.images_to_retry(forms).select("page_id", "form", "retry_url")


@query
def image_path(spark, sf_dir):
    rows = src.picture_rows(spark, sf_dir)
    return out.image_paths(rows, "/images", force_unique=True).select("ord", "ptid", "path")


@query
def image_path_clash(spark, sf_dir):
    """Names that end in each other, and names that are called like a numbered one."""
    rows = src.clashing_pictures(spark, sf_dir)
    return out.image_paths(rows, "/images", force_unique=True).select("ord", "ptid", "path")


@query
def snapshot_stamp(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", ux.snapshot_stamp(F.col("o_orderdate")).alias("stamp"))


@query
def parse_post_date(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders")
    written = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("o_orderdate", "MMM d, yyyy"))
        .alias("post_date"),
    )
    day = ux.post_day(F.col("post_date")).cast("string").alias("day")
    return written.select("o_orderkey", day)


# --- text expressions ---------------------------------------------------------


@query
def clean_post_text(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    messy = F.concat(F.lit("\t  "), F.replace("text", F.lit(", "), F.lit(",   \n  ")), F.lit(" \n"))
    return docs.select("doc_id", tx.clean_post_text(messy).alias("text"))


@query
def clean_page_text(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    messy = F.concat(F.lit(" \n"), F.replace("text", F.lit("\n"), F.lit("  \n \n")))
    return docs.select("doc_id", tx.clean_page_text(messy).alias("text"))


@query
def term_count(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return docs.select("doc_id", tx.term_count(F.col("text")).cast("bigint").alias("term_count"))


@query
def min_terms(spark, sf_dir):
    return term_count(spark, sf_dir).where(F.col("term_count") >= 2)


@query
def detect_languages(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    named = F.concat("text", F.lit(" Englishman. In "), F.col("source"), F.lit("FRENCH, french"))
    tag = (
        F.when(F.col("lang") == "en", "English")
        .when(F.col("lang") == "fr", "French")
        .when(F.col("lang") == "de", "German")
        .otherwise("spanish")
    )
    tags = F.array(F.col("source"), tag, F.lit("Thai"), tag)
    return docs.select("doc_id", F.array_join(tx.languages(named, tags), "|").alias("languages"))


@query
def page_title(spark, sf_dir):
    text = tx.clean_page_text(hx.fast_text(F.col("html")))
    return _pages(spark, sf_dir).select("ord", tx.page_title(text, "fast").alias("title"))


@query
def export_name(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    name = tx.export_name(tx.term_count(F.col("text")), F.col("n_chars"), F.col("text"), "md")
    return docs.select("doc_id", name.alias("name"))


# --- posts --------------------------------------------------------------------


@query
def flatten_posts(spark, sf_dir):
    return _flat_posts(src.listing_pages(spark, sf_dir))


def _flat_posts(pages):
    flat = po.flatten_posts(pages)
    return flat.select(
        "page_idx", "post_idx", "post_date", "post_title", "post_link", "raw_text",
        F.array_join(F.transform("body_extracts", lambda i: i["text_link"]), "|").alias("links"),
        _joined("tag_list"),
    )


@query
def post_pages_roundtrip(spark, sf_dir):
    """Nested post pages written as JSON lines, read back and flattened."""
    path = new_path(spark, "post_pages")
    out.write_listing_pages(src.listing_pages(spark, sf_dir), path)
    return _flat_posts(rd.read_listing_pages(spark, path, multi_line=False, errors="raise"))


@query
def posts_per_page(spark, sf_dir):
    return po.posts_per_page(src.listing_pages(spark, sf_dir))


@query
def post_ids(spark, sf_dir):
    pages = src.listing_pages(spark, sf_dir)
    flat = po.flatten_posts(pages).select("page_idx", "post_idx")
    return po.number_posts(flat, po.page_offsets(pages)).select("page_idx", "post_idx", "ptid")


@query
def fix_post_links(spark, sf_dir):
    fixed = po.fix_post_links(po.flatten_posts(src.listing_pages(spark, sf_dir)))
    item = F.element_at("body_extracts", 1)
    first = F.when(F.size("body_extracts") > 0, item)
    return fixed.select(
        "page_idx", "post_idx", _joined("raw_images"), _joined("raw_links"),
        first["img_link"].alias("img_link"), first["img_attrs"]["src"].alias("img_src"),
        first["text_link"].alias("text_link"),
    )


@query
def posts(spark, sf_dir):
    return src.posts(spark, sf_dir).select(
        "ptid", "post_date", "post_title", "post_link", "raw_text", "ptid_slug",
        _joined("tag_list"), _joined("languages"), _joined("text_links"), _joined("raw_links"),
        _joined("raw_images"),
    )


@query
def post_images(spark, sf_dir):
    return po.post_images(src.posts(spark, sf_dir))


@query
def dated_links(spark, sf_dir):
    links = po.dated_links(src.posts(spark, sf_dir))
    return links.select(F.col("post_date").cast("string").alias("post_date"), "url").distinct()


# --- pages --------------------------------------------------------------------


@query
def page_text(spark, sf_dir):
    return _pages(spark, sf_dir).select("ord", hx.fast_text(F.col("html")).alias("text"))


@query
def page_text_plain(spark, sf_dir):
    return _pages(spark, sf_dir).select("ord", hx.plain_text(F.col("html")).alias("text"))


@query
def extract_modes(spark, sf_dir):
    """Texts of the two modes that need no element tree, chosen by name."""

    def texts(mode):
        found = pg.extract_pages(_pages(spark, sf_dir), mode, html="html", outputs=("text",))
        return found.select("ord", F.lit(mode).alias("mode"), "text")

    return texts("fast").unionAll(texts("remove"))


@query
def absolute_links(spark, sf_dir):
    href = F.col("href")
    name = F.substring(href, F.lit(2), F.length(href))
    refs = F.array(
        href,
        F.concat(F.lit("//cdn.example.com"), href),
        F.lit("?q=1"),
        F.lit("#top"),
        name,
        F.concat(F.lit("../"), name),
        F.concat(F.lit("./a/../"), name),
        F.concat(F.lit("mailto:"), name),
        F.lit(""),
    )
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    links = _pages(spark, sf_dir).select("ord", "url", F.posexplode(hrefs).alias("pos", "href"))
    forms = links.select("ord", "pos", "url", F.posexplode(refs).alias("form", "ref"))
    return forms.select(
        "ord", "pos", "form", ux.absolute_url(F.col("url"), F.col("ref")).alias("link")
    )


@query
def page_images(spark, sf_dir):
    rows = pg.page_images(_pictures(spark, sf_dir))
    attrs = F.col("attrs")
    return rows.select(
        "ord", "pos", attrs["src"].alias("src"), attrs["alt"].alias("alt"),
        attrs["width"].alias("width"),
    )


@query
def page_links(spark, sf_dir):
    return pg.page_links(_pages(spark, sf_dir)).drop("url")


@query
def link_descriptions(spark, sf_dir):
    doubled = _pages(spark, sf_dir).withColumn(
        "html", F.replace("html", F.lit("<article>"), F.lit("<a href='/to'>once <b>more</b></a>"))
    )
    return pg.link_descriptions(doubled).drop("url")


@query
def classify_links(spark, sf_dir):
    mixed = _pictures(spark, sf_dir).withColumn(
        "html",
        F.concat(
            "html",
            F.lit("<a href='https://other.example.com/a'>x</a><a href='mailto:me'>y</a>"
                  "<a href='ftp://files'>z</a><a href='/share'>s</a>"),
        ),
    )
    return pg.classify_links(mixed).drop("url")


@query
def odd_anchor_links(spark, sf_dir):
    return pg.page_links(src.anchor_pages(spark, sf_dir)).drop("url")


@query
def odd_anchor_texts(spark, sf_dir):
    return pg.link_descriptions(src.anchor_pages(spark, sf_dir)).drop("url")


@query
def odd_anchor_classes(spark, sf_dir):
    rows = pg.classify_links(src.anchor_pages(spark, sf_dir))
    return rows.select("ord", "image", "internal", "link")


@query
def odd_anchor_extracts(spark, sf_dir):
    """The extraction of the corpus build over the same pages."""
    rows = pg.extract_pages(src.anchor_pages(spark, sf_dir), html="html", outputs=("links",))
    both = [F.array_join(name, "|").alias(name) for name in ("links", "link_texts")]
    return rows.select("ord", *both)


@query
def text_images(spark, sf_dir):
    shown = _pictures(spark, sf_dir).select(
        "ord",
        tx.post_id(F.expr("ord div 3")).alias("ptid"),
        F.replace("html", F.lit("src='"), F.lit("src='//img.example.com")).alias("text"),
    )
    return pg.text_images(shown)


@query
def main_content(spark, sf_dir):
    return _pages(spark, sf_dir).select("ord", hx.simplified_page(F.col("html")).alias("text"))


# --- captures and fetch tables -------------------------------------------------


@query
def captures(spark, sf_dir):
    rows = cap.captures(src.captures(spark, sf_dir))
    return rows.select("ord", "target_uri", "status", "content_length", _sha("content", "sha"))


@query
def status_filter(spark, sf_dir):
    rows = cap.under_status(src.typed_captures(spark, sf_dir))
    return rows.select("ord", "target_uri", "status")


def _archive_folder(spark, sf_dir, per_file: int = 64, packed: bool = True, damaged: bool = False) -> str:
    """Request and response records of the captures as archives on the shared folder.

    With ``damaged``, every record is a gzip member, and the response of every seventh capture of an
    archive has bytes changed.
    """
    line = lambda *parts: F.concat(*parts, F.lit("\r\n"))
    target = line(F.lit("WARC-Target-URI: "), F.col("target_uri"))
    block = F.concat(
        line(F.lit("HTTP/1.1 "), F.col("statusline")), F.lit("Content-Type: text/html\r\n\r\n"),
        F.col("content"),
    )
    request = F.lit("GET / HTTP/1.1\r\n\r\n")

    def record(kind: str, body):
        return F.concat(
            F.lit(f"WARC/1.0\r\nWARC-Type: {kind}\r\n"), target,
            line(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
            F.lit("\r\n"), body,
        )

    both = src.captures(spark, sf_dir).select(
        record("request", request).cast("binary").alias("request"),
        record("response", block).cast("binary").alias("response"),
        (F.col("ord") % 7 == 3).alias("broken"),
    )

    def members(rows, step):
        """Gzip members or plain stretches of ``step`` records, of which one is held at a time."""
        held = []
        for row in rows:
            for kind in ("request", "response"):
                held.append(row[kind] + b"\r\n\r\n")
                if len(held) == step:
                    member = gzip.compress(b"".join(held)) if packed else b"".join(held)
                    yield _changed(member) if damaged and row["broken"] and kind == "response" else member
                    held = []
        if held:
            yield gzip.compress(b"".join(held)) if packed else b"".join(held)

    def archives(batches):
        """Archives of up to ``per_file`` captures, with one, two or many records per gzip member."""
        part, number = TaskContext.get().partitionId(), 0
        rows = (row for batch in batches for at in range(0, batch.num_rows, 64) for row in batch.slice(at, 64).to_pylist())
        for first in rows:
            own = chain([first], islice(rows, per_file - 1))
            yield f"{part:05d}-{number:05d}.warc" + ".gz" * packed, members(own, 1 if damaged else (1, 2, 7)[number % 3])
            number += 1

    path = new_path(spark, "archives")
    out.write_files(both, path, archives)
    return path


def _changed(member: bytes) -> bytes:
    """A gzip member with its last packed bytes and its check sum inverted."""
    return member[:-16] + bytes(255 - b for b in member[-16:-4]) + member[-4:]


@query
def warc_scan(spark, sf_dir):
    rows = cap.captures(warc.read_warc(spark, _archive_folder(spark, sf_dir)))
    return rows.select("target_uri", "status", "content_length", _sha("content", "sha"))


@query
def warc_split_scan(spark, sf_dir):
    """Larger archives, packed and plain, read in ranges from an index of offsets."""
    found = []
    for packed in (True, False):
        folder = _archive_folder(spark, sf_dir, 2048, packed)
        index = stored(warc.archive_index(spark, folder), "index")
        rows = warc.read_warc(spark, folder, index=index, split_bytes=1 << 18)
        found.append(cap.captures(rows).withColumn("packed", F.lit(packed)))
    rows = found[0].unionByName(found[1])
    return rows.select("packed", "target_uri", "status", "content_length", _sha("content", "sha"))


@query
def warc_index(spark, sf_dir):
    """Offsets of plain archives: every record, request or response, with its length in bytes."""
    found = warc.archive_index(spark, _archive_folder(spark, sf_dir, 2048, packed=False))
    return found.select("target_uri", "length")


@query
def warc_quarantine(spark, sf_dir):
    """Damaged archives: good responses, and a row for each stretch that cannot be read."""
    folder = _archive_folder(spark, sf_dir, 512, damaged=True)
    rows = warc.read_warc(spark, folder, errors="quarantine")
    return rows.select("target_uri", _sha("content", "sha"), F.isnotnull("_error").alias("broken"))


@query
def warc_cdx_scan(spark, sf_dir):
    """The same archives, split by an index in CDX lines."""
    folder = _archive_folder(spark, sf_dir, 2048)
    index = warc.archive_index(spark, folder)
    name = F.regexp_extract("path", "[^/]*$", 0)
    lines = index.select(
        F.concat_ws(" ", F.lit("key 20200101000000"), "target_uri", F.lit("text/html 200 AA - -"), "length", "offset", name)
    )
    path = new_path(spark, "cdx")
    lines.write.text(path)
    rows = warc.read_warc(spark, folder, index=warc.read_cdx(spark, path, folder), split_bytes=1 << 18)
    return cap.captures(rows).select("target_uri", "status", "content_length", _sha("content", "sha"))


@query
def body_states(spark, sf_dir):
    """Bodies of captures under encodings that are whole, cut, wrong or unknown."""
    names = ("whole chunks", "cut chunks", "whole gzip", "cut gzip", "not gzip", "br")

    def states(batches):
        for batch in batches:
            rows = []
            for page, html in zip(*(batch.column(c).to_pylist() for c in range(2)), strict=True):
                raw = (html or "").encode()
                chunked = b"%x\r\n%s\r\n" % (len(raw), raw) if raw else b""
                zipped = gzip.compress(raw)
                bodies = [chunked + b"0\r\n\r\n", chunked, zipped, zipped[: len(zipped) // 2], b"<" + raw, raw]
                for name, body in zip(names, bodies, strict=True):
                    kind = "Transfer-Encoding" if "chunks" in name else "Content-Encoding"
                    value = "chunked" if "chunks" in name else name.rpartition(" ")[2]
                    content, state = decoded_body(body, [{"name": kind, "value": value}])
                    rows.append((page, name, state, content == raw))
            columns = [pa.array(c) for c in zip(*rows, strict=True)] if rows else []
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["ord", "kind", "state", "whole"])

    pages = _pages(spark, sf_dir).select("ord", "html")
    return pages.mapInArrow(states, "ord long, kind string, state string, whole boolean")


@query
def warc_metadata(spark, sf_dir):
    rows = warc.archive_metadata(spark, _archive_folder(spark, sf_dir))
    return rows.select(
        "target_uri", "warc_type", "statusline", "content_length", "payload_digest"
    )


@query
def warc_headers(spark, sf_dir):
    rows = warc.record_headers(spark, _archive_folder(spark, sf_dir))
    stacked = cap.stack_headers(F.concat("rec_headers", "http_headers"))
    headers = rows.select("ord", stacked.alias("h"))
    names = ["WARC-Type", "WARC-Target-URI", "Content-Type"]
    return headers.select(
        *[F.array_join(F.col("h")[n], "|").alias(n.replace("-", "_").lower()) for n in names]
    )


@query
def merge_scanned(spark, sf_dir):
    """First capture per URI over real archives, listed twice: each URI stays once."""
    folder = _archive_folder(spark, sf_dir)
    rows = cap.merge_captures(cap.captures(warc.read_warc(spark, [folder, folder])))
    return rows.select("target_uri", "status", _sha("content", "sha"))


@query
def merge_captures(spark, sf_dir):
    first = src.captures(spark, sf_dir)
    archives = F.array(
        F.struct(F.lit(0).alias("archive"), F.col("content").alias("body")),
        F.struct(
            F.lit(1).alias("archive"), F.concat("content", F.lit("<!-- later -->")).alias("body")
        ),
    )
    both = first.select("ord", "target_uri", F.inline(archives))
    # The copies were fetched by the second archive only.
    present = (F.col("archive") == 1) | ~F.endswith("target_uri", F.lit("-copy"))
    rows = both.where(present).select(
        F.shiftleft(F.col("archive").cast("bigint"), 40).bitwiseOR(F.col("ord")).alias("ord"),
        "target_uri",
        "body",
    )
    return cap.merge_captures(rows).select("target_uri", _sha("body", "sha"))


@query
def stack_headers(spark, sf_dir):
    rows = src.header_entries(spark, sf_dir).select(
        "ord", F.explode(cap.stack_headers(F.col("entries"))).alias("name", "values")
    )
    return rows.select("ord", "name", _joined("values"))


@query
def fetch_tally(spark, sf_dir):
    rows = src.typed_captures(spark, sf_dir)
    return cap.fetch_tally(rows.select((F.col("status") < 400).alias("ok")))


@query
def fetch_results_dated(spark, sf_dir):
    # Every address is fetched twice here; the first result counts.
    results = src.typed_captures(spark, sf_dir).select(
        F.explode(F.array(F.col("ord"), F.col("ord") + (1 << 40))).alias("ord"),
        F.col("target_uri").alias("url"), "status", "content_length", _sha("content", "sha"),
    ).withColumn("sha", F.when(F.col("ord") < 1 << 40, F.col("sha")).otherwise("later"))
    links = po.dated_links(src.posts(spark, sf_dir)).select(
        "post_no", "pos", F.col("post_date").cast("string").alias("post_date"), "url"
    )
    return cap.results_with_dates(results, links)


@query
def image_files(spark, sf_dir):
    rows = out.image_files(src.picture_rows(spark, sf_dir))
    return rows.select("ptid", "path", _sha("content", "sha"))


@query
def pending_images(spark, sf_dir):
    rows = out.image_paths(src.picture_rows(spark, sf_dir))
    there = rows.where(F.col("content").isNull()).select("ptid", "fname").distinct()
    return cap.pending_images(rows.select("ord", "ptid", "fname"), there)


# --- snapshots and frontier ------------------------------------------------------


@query
def nearest_snapshot(spark, sf_dir):
    hits = nearest(src.event_requests(spark, sf_dir), src.event_index(spark, sf_dir))
    return hits.select("event_id", "stamp", "timestamp", "archive_url", "original")


@query
def snapshot_hits(spark, sf_dir):
    """Whole index records of the hits, written as JSON lines and read back."""
    path = new_path(spark, "hits")
    hits = nearest(src.event_requests(spark, sf_dir), src.event_index(spark, sf_dir))
    out.write_json(hits, path)
    return spark.read.schema(hits.schema).json(path).select(
        "event_id", "stamp", "available", "status", *SNAPSHOT_FIELDS
    )


@query
def fetch_frontier(spark, sf_dir):
    links = po.dated_links(src.posts(spark, sf_dir))
    return fx.fetch_frontier(links, src.page_index(spark, sf_dir))


# --- dedup and corpus -------------------------------------------------------------


@query
def ordered_distinct(spark, sf_dir):
    words = _documents(spark, sf_dir).select(
        "doc_id", F.posexplode(F.split("text", r"\s+")).alias("pos", "word")
    )
    placed = words.select(
        "word", (F.shiftleft(F.col("doc_id"), 24) + F.col("pos")).alias("ord")
    )
    return distinct_in_order(placed, "word")


@query
def dedup_text(spark, sf_dir):
    docs = src.table(spark, sf_dir, "documents")
    kept = keep_first_wide(docs, F.sha2("text", 256), "doc_id")
    return kept.select("doc_id", "source", "n_chars", _sha("text", "sha"))


def _extracts(spark, sf_dir, **options):
    return cx.text_extracts(src.typed_captures(spark, sf_dir), **options)


@query
def text_extracts(spark, sf_dir):
    return _extracts(spark, sf_dir).select(
        "ord", "status", "url", "origurl", "title", "content_length",
        F.col("term_count").cast("bigint").alias("term_count"), "text",
        F.size("images").cast("bigint").alias("n_images"), _joined("links"), _joined("link_texts"),
    )


@query
def pages_posts_join(spark, sf_dir):
    # The many-to-many rows carry the hash of a text, not the text.
    extracts = _extracts(spark, sf_dir).drop("text", "content")
    joined = cx.pages_with_posts(extracts, src.posts(spark, sf_dir))
    return joined.select("ord", "ptid", "text_links", "post_title", F.col("text_key").alias("sha"))


@query
def best_per_url(spark, sf_dir):
    narrow = _extracts(spark, sf_dir).select("ord", "origurl", "term_count", "content_length")
    return cx.best_per_url(narrow).select(
        "origurl", "ord", F.col("term_count").cast("bigint").alias("term_count"), "content_length"
    )


def _corpus(spark, sf_dir, **options):
    """The corpus over a stored posts table, as the build job runs it, all columns included."""
    posts_table = stored(src.posts(spark, sf_dir), "posts")
    return cx.corpus_of_captures(src.typed_captures(spark, sf_dir), posts_table, **options)


def _page_columns():
    return [
        F.size("images").cast("bigint").alias("n_images"), _joined("links"), _joined("link_texts"),
        _sha("content", "content_sha"),
    ]


@query
def master_corpus(spark, sf_dir):
    return _corpus(spark, sf_dir).select(
        "ord", "origurl", "url", "status", "title", "ptid", "post_title", "content_length",
        F.col("term_count").cast("bigint").alias("term_count"), _sha("text", "sha"),
        _joined("languages"), *_page_columns(),
    )


@query
def corpus_order(spark, sf_dir):
    """The stored row number of the corpus, and the place of the row in its files."""
    path = new_path(spark, "corpus")
    out.write_corpus(_corpus(spark, sf_dir, row_no="row_no"), path)
    return rd.with_row_number(rd.read_corpus(spark, path), "place").select("origurl", "row_no", "place")


@query
def corpus_roundtrip(spark, sf_dir):
    path = new_path(spark, "corpus")
    out.write_corpus(_corpus(spark, sf_dir), path)
    return rd.read_corpus(spark, path).select(
        "ord", "ptid", "title", _sha("text", "sha"), *_page_columns()
    )


@query
def label_records(spark, sf_dir):
    simple = cx.simplify_corpus(_corpus(spark, sf_dir))
    return cx.label_records(simple).select(F.to_json("data").alias("data"))


@query
def label_scan(spark, sf_dir):
    path = new_path(spark, "labels")
    out.write_json(cx.label_records(cx.simplify_corpus(_corpus(spark, sf_dir))), path)
    rows = rd.read_labels(spark, path)
    return rows.select(
        "ptid", "url", "post_title", "content_length", _sha("text", "sha"), _joined("languages")
    )


@query
def export_html(spark, sf_dir):
    return out.html_files(_corpus(spark, sf_dir))


@query
def export_markdown(spark, sf_dir):
    return out.markdown_files(_corpus(spark, sf_dir))


# --- URL lists -------------------------------------------------------------------


def _url_rows(spark, sf_dir):
    links = po.dated_links(src.posts(spark, sf_dir))
    return links.select(
        F.struct("post_no", "pos").alias("ord"),
        F.concat(F.lit(" "), ux.canonical_url(F.col("url")), F.lit("\t")).alias("url"),
    )


@query
def url_list_out(spark, sf_dir):
    rows = out.url_list_rows(_url_rows(spark, sf_dir), drop_duplicates=True)
    return rows.select(F.col("ord.post_no").alias("post_no"), F.col("ord.pos").alias("pos"), "url")


@query
def url_list_scan(spark, sf_dir):
    path = new_path(spark, "urls")
    out.write_url_list(_url_rows(spark, sf_dir), path)
    return rd.read_url_list(spark, path, drop_duplicates=True)
