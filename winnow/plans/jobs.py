"""Command line jobs: ``python -m winnow.plans.jobs JOB ...``; ``--help`` lists them."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from winnow.operators.captures import captures, decoded, merge_captures, results_with_dates
from winnow.operators.pages import MODES, text_images
from winnow.operators.posts import build_posts, dated_links, post_images
from winnow.plans import corpus as cx
from winnow.plans.frontier import fetch_lists
from winnow.session import build_session
from winnow.sinks import files as out
from winnow.sources.files import read_labels, read_listing_pages, with_row_number
from winnow.sources.warc import archive_metadata, read_warc
from winnow.staging import drop_stages, stored


def flag(text: str) -> bool:
    return text.lower() in ("1", "true", "yes")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="winnow")
    jobs = top.add_subparsers(dest="job", required=True)
    front = jobs.add_parser("frontier", help="URL lists and snapshot hits from post pages")
    front.add_argument("--posts", required=True)
    front.add_argument("--index", required=True, help="snapshot index (Parquet)")
    front.add_argument("--out", required=True)
    build = jobs.add_parser("build", help="corpus and label records from archives and posts")
    build.add_argument("--posts", required=True)
    build.add_argument("--warc", required=True, nargs="+")
    build.add_argument("--corpus-out", required=True)
    build.add_argument("--labels-out", required=True)
    build.add_argument("--tag-transform", default="fast", choices=MODES)
    build.add_argument("--text-only", type=flag, default=True)
    build.add_argument("--max-status", type=int, default=399)
    build.add_argument("--min-term-count", type=int, default=0)
    build.add_argument("--match", default="exact", choices=("exact", "canonical"))
    images = jobs.add_parser("images", help="image lists of posts and simplified texts")
    images.add_argument("--posts", required=True)
    images.add_argument("--labels", required=True)
    images.add_argument("--out", required=True)
    merge = jobs.add_parser("merge", help="one capture per URI and record metadata")
    merge.add_argument("--warc", required=True, nargs="+")
    merge.add_argument("--out", required=True)
    export = jobs.add_parser("export", help="one HTML and one Markdown file per corpus row")
    export.add_argument("--corpus", required=True)
    export.add_argument("--out", required=True)
    dates = jobs.add_parser("dates", help="fetch results with the dates of their links")
    dates.add_argument("--posts", required=True)
    dates.add_argument("--results", required=True)
    dates.add_argument("--out", required=True)
    fetched = jobs.add_parser("fetched-images", help="image files from fetched bytes")
    fetched.add_argument("--fetched", required=True, help="Parquet: ord, ptid, imgurl, content")
    fetched.add_argument("--out", required=True)
    return top


def run_frontier(spark: SparkSession, args: argparse.Namespace) -> None:
    links = dated_links(build_posts(read_listing_pages(spark, args.posts)))
    live, archive, hits = fetch_lists(links, spark.read.parquet(args.index))
    out.write_url_list(live, f"{args.out}/url_list")
    out.write_url_list(archive, f"{args.out}/archive_url_list")
    out.write_json(hits.drop("ord"), f"{args.out}/snapshot_hits")


def run_build(spark: SparkSession, args: argparse.Namespace) -> None:
    posts = stored(build_posts(read_listing_pages(spark, args.posts)), "posts")
    scanned = stored(captures(read_warc(spark, args.warc)), "captures")
    frame = decoded(merge_captures(scanned))
    corpus = cx.corpus_of_captures(
        frame, posts, args.tag_transform, args.text_only, args.max_status, args.min_term_count,
        args.match, "row_no",
    )
    out.write_corpus(corpus, args.corpus_out)
    simplified = cx.simplify_corpus(spark.read.parquet(args.corpus_out))
    out.write_json(cx.label_records(simplified), args.labels_out)


def run_images(spark: SparkSession, args: argparse.Namespace) -> None:
    posts = build_posts(read_listing_pages(spark, args.posts))
    post_images(posts).write.mode("overwrite").parquet(f"{args.out}/post_images")
    labels = read_labels(spark, args.labels, "ord")
    text_images(labels).write.mode("overwrite").parquet(f"{args.out}/text_images")


def run_merge(spark: SparkSession, args: argparse.Namespace) -> None:
    """First capture per URI, and the seven header columns of every record."""
    merge_captures(captures(read_warc(spark, args.warc))).drop("ord").write.mode("overwrite").parquet(
        f"{args.out}/captures"
    )
    archive_metadata(spark, args.warc).write.mode("overwrite").parquet(f"{args.out}/metadata")
    counted = spark.read.parquet(f"{args.out}/captures").count()
    print(f"{counted} records merged")


def run_export(spark: SparkSession, args: argparse.Namespace) -> None:
    corpus = spark.read.parquet(args.corpus)
    out.write_files(out.html_files(corpus), f"{args.out}/html")
    out.write_files(out.markdown_files(corpus), f"{args.out}/markdown")


def run_dates(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fetch results (JSON lines, in order) with the dates of the links that asked for them."""
    results = with_row_number(spark.read.json(args.results), "ord")
    links = dated_links(build_posts(read_listing_pages(spark, args.posts))).select("post_date", "url")
    out.write_json(results_with_dates(results, links), args.out)


def run_fetched_images(spark: SparkSession, args: argparse.Namespace) -> None:
    fetched = spark.read.parquet(args.fetched)
    files = out.image_files(fetched).select("path", F.col("content").alias("body"))
    out.write_files(files, args.out)


JOBS = {
    "frontier": run_frontier, "build": run_build, "images": run_images, "merge": run_merge,
    "export": run_export, "dates": run_dates, "fetched-images": run_fetched_images,
}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"winnow-{args.job}")
    try:
        JOBS[args.job](spark, args)
    finally:
        drop_stages(spark)


if __name__ == "__main__":
    main()
