"""Page extraction: text, links and images of raw pages as new columns or link tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions import html as hx
from winnow.functions import markup as mx
from winnow.functions import urls as ux

MODES = ("fast", "reduce", "markdown", "remove")
OUTPUTS = ("images", "links", "text")


def extract_pages(
    pages: DataFrame,
    mode: str = "fast",
    text_only: bool = True,
    title_in_body: bool = True,
    html: str = "content",
    url: str = "url",
    outputs: Sequence[str] = OUTPUTS,
) -> DataFrame:
    """Add ``images``, ``links`` (and ``link_texts`` in fast mode) and ``text``.

    Nothing moves between rows, so the work stays in the scan stage.  An empty page yields
    empty outputs.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    page = F.coalesce(F.col(html), F.lit(""))
    kept = list(pages.columns)
    staged = pages
    if "images" in outputs or "links" in outputs:
        staged = staged.withColumns(
            {"_seen": hx.visible(page), "_base": hx.page_base(page, F.col(url))}
        )
    new = {}
    if "images" in outputs:
        new["images"] = hx.images(F.col("_seen"), F.col("_base"))
    if "links" in outputs:
        found = hx.anchors(F.col("_seen"), F.col("_base"))
        new["links"] = hx.first_links(found) if mode == "fast" else hx.described_links(found)
    if "text" in outputs:
        new["text"] = _text(page, F.col(url), mode, text_only, title_in_body)
    kept += new
    parsed = staged.withColumns(new)
    if "links" in outputs and mode == "fast":
        at = kept.index("links") + 1
        kept[at:at] = ["link_texts"]
        parsed = parsed.withColumns(
            {"links": F.col("links.link"), "link_texts": F.col("links.link_text")}
        )
    return parsed.select(*kept)


def _linked(pages: DataFrame, html: str, url: str) -> DataFrame:
    """Pages with the columns link extraction starts from."""
    page = F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        "ord", url, hx.visible(page).alias("_seen"), hx.page_base(page, F.col(url)).alias("_base")
    )


def _text(page: Column, url: Column, mode: str, text_only: bool, title_in_body: bool) -> Column:
    if mode == "fast":
        return hx.fast_text(page, title_in_body)
    if mode == "remove":
        return hx.plain_text(page)
    convert = mx.markdown_udf if mode == "markdown" else mx.reduced_udf
    return convert(text_only, title_in_body)(page, url)


def page_links(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """First anchor of every candidate link per page: ``(page columns, pos, link, link_text)``."""
    found = hx.first_links(hx.anchors(F.col("_seen"), F.col("_base")))
    exploded = _linked(pages, html, url).select("ord", url, F.posexplode(found).alias("pos", "row"))
    return exploded.select("ord", url, "pos", "row.link", "row.link_text")


def link_descriptions(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Web links per page with all their different texts joined by ``|``."""
    found = hx.described_links(hx.anchors(F.col("_seen"), F.col("_base")))
    exploded = _linked(pages, html, url).select(
        "ord", url, F.posexplode(found).alias("pos", "row")
    )
    return exploded.select("ord", url, "pos", "row.link", "row.desc")


def page_images(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One row per image of a page with its attribute map."""
    found = hx.images(F.col("_seen"), F.col("_base"))
    return _linked(pages, html, url).select(
        "ord", url, F.posexplode(found).alias("pos", "attrs")
    )


def classify_links(
    pages: DataFrame, html: str = "html", url: str = "url", host_name: str | None = None
) -> DataFrame:
    """Candidate links with the flags image / internal / schemeok."""
    host = F.lit(host_name) if host_name is not None else ux.url_host(F.col(url))
    rows = _linked(pages, html, url).select(
        "ord",
        url,
        host.alias("_host"),
        F.posexplode(hx.linked_elements(F.col("_seen"), F.col("_base"))).alias("pos", "row"),
    )
    return rows.where(ux.is_link_candidate(F.col("row.tag"), F.col("row.link"))).select(
        "ord",
        url,
        "pos",
        (F.col("row.tag") == "img").alias("image"),
        F.contains(F.col("row.link"), F.col("_host")).alias("internal"),
        F.startswith(F.col("row.link"), F.lit("http")).alias("schemeok"),
        F.col("row.link").alias("link"),
    )


def text_images(texts: DataFrame, markup: str = "text") -> DataFrame:
    """Image URLs inside simplified texts, each with the earliest row that shows it."""
    found = F.transform(hx.images(hx.visible(F.col(markup))), lambda attrs: attrs["src"])
    rows = texts.select("ord", "ptid", F.explode(found).alias("src"))
    return (
        rows.select("ord", "ptid", ux.fix_image_url(F.col("src")).alias("imgurl"))
        .where(F.col("imgurl").isNotNull())
        .groupBy("imgurl")
        .agg(F.min_by("ptid", "ord").alias("ptid"))
    )
