"""The corpus build: captures to text extracts, joined to posts and deduplicated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions import html as hx
from winnow.functions import text as tx
from winnow.functions import urls as ux
from winnow.operators.captures import under_status
from winnow.operators.ordering import numbered
from winnow.operators.pages import OUTPUTS, extract_pages
from winnow.staging import stored


def text_extracts(
    captures: DataFrame,
    mode: str = "fast",
    text_only: bool = True,
    max_status: int = 399,
    min_term_count: int = 0,
    terms: str = tx.TERMS,
    outputs: Sequence[str] = OUTPUTS,
) -> DataFrame:
    """Clean text, title, term count, original URL and text hash of every good capture.

    The status test runs before the extraction: it reaches the scan, which no filter can
    do from behind a Python stage.  All steps work on one row, so there is no shuffle.
    ``outputs`` may leave out links and images.
    """
    good = under_status(captures.withColumnRenamed("target_uri", "url"), max_status)
    parsed = extract_pages(good, mode, text_only, outputs=outputs)
    counted = parsed.withColumn("text", tx.clean_page_text(F.col("text"))).withColumn(
        "term_count", tx.term_count(F.col("text"), terms)
    )
    if min_term_count > 0:
        counted = counted.where(F.col("term_count") >= min_term_count)
    return counted.withColumns(
        {
            "title": tx.page_title(F.col("text"), mode),
            "origurl": ux.original_url(F.col("url")),
            "text_key": F.sha2("text", 256),
        }
    )


def first_mentions(posts: DataFrame, match: str = "exact") -> DataFrame:
    """The earliest post that mentions each link."""
    links = posts.select("post_no", F.explode("text_links").alias("link"))
    return (
        links.select(_match_key(F.col("link"), match).alias("link"), "post_no")
        .where(F.col("link").isNotNull())
        .groupBy("link")
        .agg(F.min("post_no").alias("post_no"))
    )


def pages_with_posts(extracts: DataFrame, posts: DataFrame, match: str = "exact") -> DataFrame:
    """Every page with every post that mentions it (many to many)."""
    links = posts.withColumn("text_links", F.explode("text_links")).withColumn(
        "_link", _match_key(F.col("text_links"), match)
    )
    keyed = extracts.withColumn("_link", _match_key(F.col("origurl"), match))
    return keyed.join(links, "_link").drop("_link")


def distinct_texts(narrow: DataFrame) -> DataFrame:
    """Per text the row with the smallest ``ord``."""
    rest = [name for name in narrow.columns if name != "text_key"]
    return (
        narrow.groupBy("text_key")
        .agg(F.min_by(F.struct(*rest), "ord").alias("row"))
        .select("text_key", "row.*")
    )


def best_per_url(narrow: DataFrame) -> DataFrame:
    """Per original URL the row with most terms, then longest content, then smallest ``ord``."""
    rest = [name for name in narrow.columns if name != "origurl"]
    # The least of negated counts: ``ord`` may be of any type that has an order.  NULL counts come last.
    counts = [key for name in ("term_count", "content_length") for key in (F.isnull(name), -F.col(name))]
    rank = F.struct(*(key.alias(f"k{n}") for n, key in enumerate(counts)), "ord")
    return (
        narrow.groupBy("origurl")
        .agg(F.min_by(F.struct(*rest), rank).alias("row"))
        .select("origurl", "row.*")
    )


def corpus_keys(extracts: DataFrame, posts: DataFrame, match: str = "exact") -> DataFrame:
    """The surviving ``(ord, post_no)`` pairs of the corpus, with their unique ``origurl``.

    All rows of a page share its text, so of a page's posts only the first can survive the
    text dedup: each link is cut to its first post before the join.  That makes the join
    one to one on the post side and leaves both dedups to narrow, pre-aggregated rows.
    """
    narrow = extracts.select(
        "ord", "origurl", "text_key", "term_count", "content_length"
    ).withColumn("link", _match_key(F.col("origurl"), match))
    matched = narrow.join(first_mentions(posts, match), "link").drop("link")
    return best_per_url(distinct_texts(matched).drop("text_key")).select("ord", "post_no", "origurl")


def master_corpus(
    extracts: DataFrame, posts: DataFrame, match: str = "exact", row_no: str | None = None
) -> DataFrame:
    """Deduplicated corpus: page columns and the columns of its first post.

    ``row_no`` names a column for the place of a row in the order of ``origurl``; places are
    found on the keys, before any body moves.

    Page bodies are fetched for the survivors only, by one join on ``ord``.  Give a stored
    ``extracts`` table (the build job does); a lazy one is computed twice.
    """
    keys = corpus_keys(extracts, posts, match)
    if row_no:
        keys = numbered(keys, "origurl", row_no)
    winners = keys.drop("origurl").join(posts, "post_no")
    return extracts.drop("text_key").join(winners, "ord")


def first_captures(
    captures: DataFrame, posts: DataFrame, mode: str = "fast", max_status: int = 399, match: str = "exact"
) -> DataFrame:
    """The good captures that can survive the text dedup, found before any text is extracted.

    Captures of equal content have equal texts, so of those that a post mentions only the one with the
    smallest ``ord`` can survive.  In the modes that write links into the text their URL counts as content.
    """
    good = under_status(captures, max_status)
    same = ["_content"] if mode in ("fast", "remove") else ["_content", "target_uri"]
    mentioned = good.select(
        "ord",
        "target_uri",
        F.sha2(F.coalesce("content", F.lit("")), 256).alias("_content"),
        _match_key(ux.original_url(F.col("target_uri")), match).alias("link"),
    ).join(first_mentions(posts, match), "link", "left_semi")
    firsts = mentioned.groupBy(*same).agg(F.min("ord").alias("_ord")).select("_ord")
    return good.join(firsts, F.col("ord").eqNullSafe(F.col("_ord")), "left_semi")


def corpus_of_captures(
    captures: DataFrame,
    posts: DataFrame,
    mode: str = "fast",
    text_only: bool = True,
    max_status: int = 399,
    min_term_count: int = 0,
    match: str = "exact",
    row_no: str | None = None,
) -> DataFrame:
    """``master_corpus`` of the extracts of all captures, with no more extraction than it needs.

    Texts are those of ``first_captures``; links and images are read from the rows of the corpus only.
    """
    firsts = first_captures(captures, posts, mode, max_status, match)
    texts = text_extracts(firsts, mode, text_only, max_status, min_term_count, outputs=("text",))
    master = master_corpus(stored(texts, "extracts"), posts, match, row_no)
    linked = extract_pages(master, mode, outputs=("images", "links"))
    new = [name for name in linked.columns if name not in master.columns]
    at = master.columns.index("text")
    corpus = linked.select(*master.columns[:at], *new, *master.columns[at:])
    # A numbered corpus is sorted, which reads it twice.
    return stored(corpus, "corpus") if row_no else corpus


def simplify_corpus(master: DataFrame) -> DataFrame:
    """Corpus with the text replaced by title and main content; term counts stay as they were."""
    return master.withColumn("text", hx.simplified_page(F.col("content")))


def label_records(corpus: DataFrame) -> DataFrame:
    """Seven corpus columns wrapped as one ``data`` record; a numbered corpus gives them in its order."""
    fields = [
        "ptid", "text", "post_title", "languages", "term_count", "content_length", "url",
    ]
    if "row_no" in corpus.columns:
        # Only what the records hold is sorted.
        corpus = corpus.select(*fields, "row_no").orderBy("row_no")
    return corpus.select(F.struct(*fields).alias("data"))


def _match_key(url, match: str):
    if match == "exact":
        return url
    if match == "canonical":
        return ux.canonical_url(url)
    raise ValueError(f"unknown match: {match}")
