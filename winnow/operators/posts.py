"""Post tables: flattening, numbering, link repair, images and dated links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions import text as tx
from winnow.functions import urls as ux
from winnow.operators.ordering import running_total


def flatten_posts(pages: DataFrame) -> DataFrame:
    """One row per post of nested listing pages; ``(page_idx, post_idx)`` is the row order."""
    posts = pages.select(
        "page_idx", F.posexplode("page_data").alias("post_idx", "post")
    )
    return posts.select(
        "page_idx",
        F.col("post_idx").cast("bigint").alias("post_idx"),
        "post.post_date",
        F.col("post.header.title_text").alias("post_title"),
        F.col("post.header.title_link").alias("post_link"),
        F.col("post.body.parsed").alias("body_extracts"),
        "post.body.raw_links",
        "post.body.raw_images",
        "post.body.raw_text",
        F.col("post.footer.tag").alias("tag_list"),
    )


def posts_per_page(pages: DataFrame) -> DataFrame:
    return pages.select("page_idx", "url", F.size("page_data").cast("bigint").alias("num_posts"))


def page_offsets(pages: DataFrame) -> DataFrame:
    """Number of posts on all earlier pages, per page."""
    sizes = pages.select("page_idx", F.size("page_data").cast("bigint").alias("n"))
    return running_total(sizes, "page_idx", "n", "first_no").select("page_idx", "first_no")


def number_posts(posts: DataFrame, offsets: DataFrame) -> DataFrame:
    """Add ``post_no`` (running number over all posts) and ``ptid`` (its padded text form)."""
    numbered = posts.join(offsets, "page_idx").withColumn(
        "post_no", F.col("first_no") + F.col("post_idx")
    )
    return numbered.drop("first_no").withColumn("ptid", tx.post_id(F.col("post_no")))


def fix_items(items: Column) -> Column:
    """Repair the image and text links of body items."""

    def fixed(item: Column) -> Column:
        attrs = F.map_concat(
            F.map_filter(item["img_attrs"], lambda name, _: name != "src"),
            F.create_map(F.lit("src"), ux.fix_image_url(item["img_attrs"]["src"])),
        )
        return F.struct(
            ux.fix_image_url(item["img_link"]).alias("img_link"),
            attrs.alias("img_attrs"),
            ux.fix_scheme(item["text_link"]).alias("text_link"),
            item["text_desc"].alias("text_desc"),
        )

    return F.transform(items, fixed)


def fix_post_links(posts: DataFrame) -> DataFrame:
    return posts.withColumns(
        {
            "raw_images": F.transform("raw_images", lambda url: ux.fix_image_url(url)),
            "raw_links": F.transform("raw_links", lambda url: ux.fix_scheme(url)),
            "body_extracts": fix_items(F.col("body_extracts")),
        }
    )


def clean_posts(posts: DataFrame, language_names: list[str] | None = None) -> DataFrame:
    """Clean text, repaired links, languages and text links of posts."""
    fixed = fix_post_links(posts).withColumn("raw_text", tx.clean_post_text(F.col("raw_text")))
    return fixed.withColumns(
        {
            "languages": tx.languages(F.col("raw_text"), F.col("tag_list"), language_names),
            "text_links": F.transform("body_extracts", lambda item: item["text_link"]),
        }
    )


def finish_posts(posts: DataFrame, language_names: list[str] | None = None) -> DataFrame:
    """Clean text, repaired links, languages, text links and slugs of numbered posts."""
    return _slugged(clean_posts(posts, language_names))


def _slugged(posts: DataFrame) -> DataFrame:
    return posts.withColumn("ptid_slug", F.concat_ws("_", "ptid", ux.path_slug(F.col("post_link"))))


def build_posts(pages: DataFrame, language_names: list[str] | None = None) -> DataFrame:
    """Posts table from nested listing pages that carry ``page_idx``."""
    posts = flatten_posts(pages)
    # Cleaned before the join, whose tasks follow the bytes of its rows and can be as few as one.
    cleaned = clean_posts(posts, language_names)
    numbered = _slugged(number_posts(cleaned, page_offsets(pages)))
    columns = [name for name in posts.columns if name not in ("page_idx", "post_idx")]
    return numbered.select(*columns, "post_no", "ptid", "languages", "text_links", "ptid_slug")


def post_images(posts: DataFrame) -> DataFrame:
    """Every image URL of the posts with the earliest post that shows it."""
    items = F.col("body_extracts")
    found = F.concat(
        F.coalesce("raw_images", F.array().cast("array<string>")),
        F.transform(items, lambda item: item["img_attrs"]["src"]),
        F.filter(items["img_link"], ux.is_image_url),
        F.filter("raw_links", ux.is_image_url),
    )
    exploded = posts.select("post_no", F.explode(F.array_distinct(found)).alias("imgurl"))
    firsts = (
        exploded.select("post_no", ux.fix_image_url(F.col("imgurl")).alias("imgurl"))
        .where(F.col("imgurl").isNotNull())
        .groupBy("imgurl")
        .agg(F.min("post_no").alias("post_no"))
    )
    return firsts.select("imgurl", tx.post_id(F.col("post_no")).alias("ptid"))


def dated_links(
    posts: DataFrame,
    ignored: list[str] | None = None,
    ignored_extensions: list[str] | None = None,
) -> DataFrame:
    """Wanted links of the posts with the post date; ``(post_no, pos)`` is the row order."""
    links = posts.select(
        "post_no",
        ux.post_day(F.col("post_date")).alias("post_date"),
        F.posexplode("raw_links").alias("pos", "url"),
    )
    return links.where(ux.is_wanted_link(F.col("url"), ignored, ignored_extensions))
