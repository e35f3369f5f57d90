"""Harvest relations derived from the given tables, row for row and in full.

The tables hold no posts, captures or snapshot index, so these are built from pages,
conversations, documents and events; ``oracles`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.functions import urls as ux
from winnow.operators.captures import status_code
from winnow.operators.posts import build_posts
from winnow.staging import stored

PAGE_POSTS = 64
PAGE_SLOTS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").withColumnRenamed("page_id", "ord")


def odd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with quoted ``>``, bare ``<`` and ``>``, adjoining inline elements and late text."""
    odd = (
        "<article><p title='x > y'>shown</p>a < b and c > d "
        "<a title='m > n' href='/quoted'><b>one</b><i>two</i></a>"
    )
    html = F.concat(F.replace("html", F.lit("<article>"), F.lit(odd)), F.lit("<p>late &amp; last</p>"))
    return pages(spark, sf_dir).withColumn("html", html)


# Links that are not closed, stand in each other, or hold "href=" and "<a" in attribute values.
ODD_ANCHORS = (
    "<a title=\"see href=/bad\" href=\"/good\">titled</a>"
    "<a href=\"/open\">open <p>par</p> and <a href=/next/>next</a> tail"
    "<a href='/outer'>one <a name=x>anchor</a> two</a>"
    "<a href=\"/alt\">see <img alt='<a href=/no>' title=\"src=/no\" src=\"/p.jpg\"> it</a>"
    "<a data-href=\"/data\" HREF = /upper>up</A ><abbr href=/abbr>no link</abbr>"
    "<a href=\"/last\">rest <i>of it"
)


def anchor_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that end in odd anchors."""
    return pages(spark, sf_dir).withColumn("html", F.concat("html", F.lit(ODD_ANCHORS)))


def bare(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*", "")


def url_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL in eleven shapes that occur in harvested links, NULL among them."""
    url = F.col("url")
    with_port = F.regexp_replace(url, r"(example\.[a-z]+)/", "$1:8080/")
    host = ux.url_host(url)
    forms = F.array(
        url,
        F.concat(F.lit("https://web.archive.org/web/20190704101112/"), with_port),
        F.concat(F.lit("https://archive.org/details"), ux.url_part(url, 3)),
        F.regexp_replace(url, "^[a-z]+:", ""),
        F.regexp_replace(url, "^[a-z]+", ""),
        F.concat(F.lit("h"), url),
        F.concat(bare(url), F.lit("/S320/s64/my+pic%20one%zz.JPG;v=1?x=.pdf")),
        F.concat(bare(url), F.lit("/a b;p=1/c.html;q=2")),
        F.concat(F.lit("mailto:someone@"), host),
        F.concat(url, F.lit("/Share.pdf")),
        F.lit(None).cast("string"),
    )
    return table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(forms).alias("form", "url")
    )


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four captures per page: live, two archived states, and a copy under another URL."""
    url, html = F.col("url"), F.col("html")
    live_status = F.when(F.contains(url, F.lit("#")), "404 Not Found").otherwise("200 OK")
    copy_status = F.when(F.contains(html, F.lit("</body>")), "200 OK").otherwise("broken")
    grown = F.replace(html, F.lit("</article>"), F.lit("<p>row 1</p></article>"))

    def one(k: int, target: Column, statusline: Column, content: Column) -> Column:
        return F.struct(
            (F.col("page_id") * 4 + k).alias("ord"),
            target.alias("target_uri"),
            statusline.alias("statusline"),
            F.length(content).cast("bigint").alias("content_length"),
            content.alias("content"),
        )

    archive = "https://web.archive.org/web/"
    rows = F.array(
        one(0, url, live_status, html),
        one(1, F.concat(F.lit(archive + "20200101000000/"), url), F.lit("200 OK"), html),
        one(2, F.concat(F.lit(archive + "20210101000000/"), url), F.lit("200 OK"), grown),
        one(3, F.concat(url, F.lit("-copy")), copy_status, html),
    )
    return table(spark, sf_dir, "pages").select(F.inline(rows))


def typed_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures(spark, sf_dir).withColumn("status", status_code(F.col("statusline")))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as nested post pages: a turn is a post, a page holds up to 64 of them.

    The posts of a conversation link to the three pages with its number; a page that lists
    more posts continues on the next one, so no group outgrows 64 rows.
    """
    mentions = (
        table(spark, sf_dir, "pages")
        .groupBy(F.expr("page_id div 3").alias("conv_id"))
        .agg(F.sort_array(F.collect_list(F.struct("page_id", "url")))["url"].alias("urls"))
    )
    chunks = (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id", F.expr(f"turn div {PAGE_POSTS}").alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
        .join(mentions, "conv_id", "left")
    )
    urls = F.coalesce("urls", F.array().cast("array<string>"))
    page_idx = F.col("conv_id") * PAGE_SLOTS + F.col("chunk")
    return chunks.select(
        page_idx.alias("page_idx"),
        F.concat(F.lit("https://blog.example.com/search?start="), page_idx.cast("string")).alias(
            "url"
        ),
        F.transform("turns", lambda turn: _post(F.col("conv_id"), turn, urls)).alias("page_data"),
        F.size("turns").alias("num_posts"),
        F.lit(None).cast("string").alias("next_page"),
    )


def _post(conv_id: Column, turn: Column, urls: Column) -> Column:
    role, text = turn["role"], turn["text"]
    place = F.concat(conv_id.cast("string"), F.lit("-"), turn["turn"].cast("string"))

    def item(link: Column) -> Column:
        return F.struct(
            F.concat(F.lit("//img.example.com/s320/"), place, F.lit(".jpg")).alias("img_link"),
            F.create_map(
                F.lit("alt"),
                role,
                F.lit("src"),
                F.concat(F.lit("hhttps://img.example.com/s64/"), place, F.lit(".png")),
            ).alias("img_attrs"),
            link.alias("text_link"),
            role.alias("text_desc"),
        )

    links = F.flatten(
        F.transform(
            urls, lambda u: F.array(F.concat(F.lit("h"), u), F.concat(u, F.lit("-copy")))
        )
    )
    raw_links = F.concat(
        urls,
        F.transform(
            urls, lambda u: F.concat(F.lit("https://web.archive.org/web/20200101000000/"), u)
        ),
        F.array(
            F.concat(F.lit("http://www.amazon.com/"), place),
            F.concat(F.lit("http://files.example.com/"), place, F.lit(".PDF")),
            F.concat(F.lit("//img.example.com/s1600/"), place, F.lit(".gif")),
        ),
    )
    day = F.date_add(F.lit("2020-01-01").cast("date"), (conv_id % 5000).cast("int"))
    title_link = F.concat(F.lit("https://blog.example.com/2021/05/"), place, F.lit(".html"))
    raw_text = F.concat(
        F.lit("  "), text, F.lit(" \n written in FRENCH,  polishing by "), role, F.lit(" ")
    )
    return F.struct(
        F.date_format(day, "MMM d, yyyy").alias("post_date"),
        F.struct(
            F.regexp_extract(text, r"^[^.\n]*", 0).alias("title_text"),
            title_link.alias("title_link"),
        ).alias("header"),
        F.struct(
            F.transform(links, item).alias("parsed"),
            raw_links.alias("raw_links"),
            F.array(
                F.concat(F.lit("://img.example.com/S72/"), role, F.lit(".png")),
                F.concat(F.lit("https://img.example.com/"), place, F.lit(".webp")),
            ).alias("raw_images"),
            raw_text.alias("raw_text"),
        ).alias("body"),
        F.array(
            F.struct(role.alias("tag"), F.lit("/t").alias("taglink")),
            F.struct(
                F.when(role == "user", "Korean").otherwise("korean").alias("tag"),
                F.lit("/k").alias("taglink"),
            ),
        ).alias("footer"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_posts(stored(listing_pages(spark, sf_dir), "listing"))


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as snapshot requests of the clicking user's address."""
    return _event_stamps(spark, sf_dir, "click").select("event_id", "url", "stamp")


def event_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as a snapshot index."""
    archive_url = F.concat(F.lit("https://web.archive.org/web/"), "stamp", F.lit("/"), "url")
    return _event_stamps(spark, sf_dir, "purchase").select(
        F.col("url").alias("original"),
        F.col("stamp").alias("timestamp"),
        archive_url.alias("archive_url"),
        F.concat(F.lit("com,example,users)/"), F.substring_index("url", "/", -1)).alias("urlkey"),
        F.lit("text/html").alias("mimetype"),
        F.lit("200").alias("statuscode"),
        F.md5(archive_url).alias("digest"),
        F.length(archive_url).cast("string").alias("length"),
    )


def _event_stamps(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == kind)
        .select(
            "event_id",
            F.concat(
                F.lit("https://users.example.com/"), F.col("user_id").cast("string")
            ).alias("url"),
            F.date_format("ts", "yyyyMMddHHmmss").alias("stamp"),
        )
    )


def page_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots per page: one at a fixed time, one on the page's own day."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("page_id") % 5000).cast("int"))
    stamps = F.array(F.lit("20200301000000"), F.concat(F.date_format(day, "yyyyMMdd"), F.lit("120000")))
    rows = table(spark, sf_dir, "pages").select(
        ux.canonical_url(F.col("url")).alias("original"), F.explode(stamps).alias("timestamp")
    )
    return rows.withColumn(
        "archive_url",
        F.concat(F.lit("https://web.archive.org/web/"), "timestamp", F.lit("/"), "original"),
    )


def page_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with every link turned into an image (the given pages hold none)."""
    return pages(spark, sf_dir).withColumn(
        "html",
        F.regexp_replace(
            "html",
            r'<a href="/([^"]*)">([^<]*)</a>',
            r"<img width=320 src='/s320/$1.jpg' alt=\"$2\" />",
        ),
    )


def picture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image rows with repeated names inside a post: ``ord, ptid, imgurl, content``."""
    lang = F.regexp_extract("html", r'lang="([a-z]*)"', 1)
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("ord"),
        F.format_string("%05d", F.expr("page_id div 10")).alias("ptid"),
        F.concat(bare(F.col("url")), F.lit("/my+"), lang, F.lit("%20pic.jpg?v=1")).alias("imgurl"),
        F.when(~F.contains("url", F.lit("#")), F.encode("html", "UTF-8")).alias("content"),
    )


def clashing_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image rows whose names end in each other or look numbered: ``ord, ptid, imgurl``."""
    name = F.element_at(
        F.array(*map(F.lit, ["pic.jpg", "pic.jpg", "mypic.jpg", "1_pic.jpg", "pic.jpg"])),
        F.expr("CAST(page_id % 5 AS INT) + 1"),
    )
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("ord"),
        F.format_string("%05d", F.expr("page_id div 10")).alias("ptid"),
        F.concat(bare(F.col("url")), F.lit("/"), name, F.lit("?v=1")).alias("imgurl"),
    )


def header_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header-like ``(name, value)`` lists: first letter and target of every page link."""
    hrefs = F.regexp_extract_all("html", F.lit('<a href="/([^"]*)"'), F.lit(1))
    return pages(spark, sf_dir).select(
        "ord",
        F.transform(
            hrefs,
            lambda h: F.struct(F.lower(F.substring(h, 1, 1)).alias("name"), h.alias("value")),
        ).alias("entries"),
    )
