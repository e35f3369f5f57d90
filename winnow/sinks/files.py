"""Writers: label records, URL lists, one file per row, image bytes."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyarrow.fs import FileType
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions import text as tx
from winnow.functions import urls as ux
from winnow.functions.common import strip_space
from winnow.operators.ordering import number_in_group, ordered_distinct
from winnow.schemas import LISTING_PAGE
from winnow.sources.warc_records import file_system

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
FRONT_MATTER = [
    "title", "post_title", "raw_text", "languages", "tag_list", "term_count", "content_length",
    "url",
]


def write_corpus(corpus: DataFrame, path: str) -> None:
    """Parquet; a corpus with ``row_no`` is range-partitioned, so its files follow that order."""
    if "row_no" in corpus.columns:
        corpus = corpus.orderBy("row_no")
    corpus.write.mode("overwrite").parquet(path)


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines: label records, snapshot hits, dated fetch results or post pages."""
    rows.write.mode("overwrite").json(path)


def write_listing_pages(pages: DataFrame, path: str) -> None:
    """Nested post pages as JSON lines in ``page_idx`` order; ``read_listing_pages`` reads them back.

    Columns are checked by name and type before anything is written; NULL fields are kept.
    """
    given = {field.name: field.dataType.simpleString() for field in pages.schema}
    wanted = {field.name: field.dataType.simpleString() for field in LISTING_PAGE}
    wrong = [f"{name}: {given.get(name)}, not {kind}" for name, kind in wanted.items() if given.get(name) != kind]
    if wrong:
        raise ValueError("no post pages: " + "; ".join(wrong))
    rows = pages.orderBy("page_idx").select(*wanted)
    rows.write.mode("overwrite").json(path, ignoreNullFields=False)


def url_list_rows(urls: DataFrame, drop_duplicates: bool = False) -> DataFrame:
    """Rows ``(ord, url)`` of a URL list: distinct before the lines are stripped."""
    rows = ordered_distinct(urls.select("ord", "url"), "url") if drop_duplicates else urls
    return rows.select("ord", strip_space(F.col("url")).alias("url"))


def write_url_list(urls: DataFrame, path: str, drop_duplicates: bool = False) -> None:
    """URL list as text files whose lines stand in ``ord`` order over all parts."""
    rows = url_list_rows(urls, drop_duplicates)
    rows.orderBy("ord").select("url").write.mode("overwrite").text(path)


def html_files(corpus: DataFrame) -> DataFrame:
    """``(path, body)`` of the HTML export; like a file, a path keeps its last body."""
    name = tx.export_name(
        F.col("term_count"), F.col("content_length"), F.col("post_title"), "html"
    )
    return _last_per_path(corpus.select("origurl", name.alias("path"), F.col("text").alias("body")))


def front_matter(corpus: DataFrame) -> Column:
    """YAML block of eight columns; every value is written as JSON, which YAML can read."""
    types = dict(corpus.dtypes)

    def value(name: str) -> Column:
        if types[name] in ("int", "bigint"):
            return F.coalesce(F.col(name).cast("string"), F.lit("null"))
        if types[name].startswith("array"):
            return F.coalesce(F.to_json(name), F.lit("null"))
        quoted = F.to_json(F.array(name))
        return F.substring(quoted, F.lit(2), F.length(quoted) - 2)

    lines = [F.concat(F.lit(name + ": "), value(name)) for name in FRONT_MATTER]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n\n"))


def markdown_files(corpus: DataFrame) -> DataFrame:
    """``(path, body)`` of the Markdown export under ``<ptid_slug>/texts/``."""
    name = tx.export_name(F.col("term_count"), F.col("content_length"), F.col("post_title"), "md")
    path = F.concat("ptid_slug", F.lit("/texts/"), name)
    body = F.concat(front_matter(corpus), "text")
    return _last_per_path(corpus.select("origurl", path.alias("path"), body.alias("body")))


def _last_per_path(rows: DataFrame) -> DataFrame:
    """Last row per path in the order of the corpus, which is that of its unique ``origurl``.

    The winners are found on narrow rows; bodies move once, for the join.
    """
    last = rows.groupBy("path").agg(F.max("origurl").alias("origurl"))
    return rows.join(last, ["path", "origurl"], "left_semi").select("path", "body")


def write_files(files: DataFrame, folder: str, make: Callable | None = None) -> None:
    """One file per row of ``(path, body)``, text or binary.

    ``make`` turns the Arrow batches of a task into such pairs, so that bodies are written where they
    are made and no second process holds them.  A body may also be an iterator of bytes, which is written piece
    by piece; batches stay small whatever the length of the rows.

    Paths are unique.  A file is written under a name of its attempt and then renamed, so a task that
    dies or runs twice leaves whole files only; the attempts are deleted when the job ends or fails.
    """
    attempts = f"{folder.rstrip('/')}/_attempts-{uuid.uuid4().hex}"

    def write_pairs(pairs):
        _, scratch = file_system(attempts)
        scratch = f"{scratch}/{uuid.uuid4().hex}"
        system, inner = file_system(folder)
        system.create_dir(scratch, recursive=True)
        made = set()
        for path, body in pairs:
            target = f"{inner.rstrip('/')}/{path}"
            parent = target.rsplit("/", 1)[0]
            if parent not in made:
                system.create_dir(parent, recursive=True)
                made.add(parent)
            whole = isinstance(body, str | bytes | bytearray | memoryview)
            part = f"{scratch}/part"
            with system.open_output_stream(part, compression=None, buffer_size=1 << 20) as out:
                for data in [body] if whole else body:
                    out.write(data.encode() if isinstance(data, str) else bytes(data))
            _publish(system, part, target)

    def write_made(batches):
        write_pairs(make(batches))
        pa.default_memory_pool().release_unused()
        return iter(())

    try:
        if make is None:
            files.select("path", "body").foreachPartition(write_pairs)
        else:
            spark = files.sparkSession
            before = spark.conf.get(_BATCH_BYTES, None)
            spark.conf.set(_BATCH_BYTES, "8m")
            try:
                files.mapInArrow(write_made, "path string").write.format("noop").mode("overwrite").save()
            finally:
                spark.conf.unset(_BATCH_BYTES) if before is None else spark.conf.set(_BATCH_BYTES, before)
    finally:
        system, inner = file_system(attempts)
        if system.get_file_info(inner).type == FileType.Directory:
            system.delete_dir(inner)


def _publish(system, part: str, target: str) -> None:
    try:
        system.move(part, target)
    except OSError:
        # Some file systems do not rename over a file that is there.
        if system.get_file_info(target).type == FileType.NotFound:
            raise
        system.delete_file(target)
        system.move(part, target)


def image_paths(images: DataFrame, base: str = "", force_unique: bool = False) -> DataFrame:
    """Add ``fname`` and ``path``; with ``force_unique`` no two rows of a post share a path."""
    named = images.withColumn("fname", ux.file_name(F.col("imgurl")))
    prefix = [F.lit(base.rstrip("/"))] if base else []
    if not force_unique:
        return named.withColumn("path", F.concat_ws("/", *prefix, "ptid", "fname"))
    names = unique_names(named.select("ptid", "fname", "ord"))
    path = F.concat_ws("/", *prefix, "ptid", F.coalesce("_name", "fname"))
    return named.join(names, ["ptid", "fname", "ord"], "left").withColumn("path", path).drop("_name")


def unique_names(names: DataFrame) -> DataFrame:
    """Stored names ``_name`` of the rows ``(ptid, fname, ord)`` whose name an earlier row of the post has.

    The first row of a name keeps it.  A later one is numbered: before its name stands how many
    earlier rows of the post have a name that ends in it.  Where another row is called so, zeros
    make the number longer than that of any name in question.  ``ord`` is a unique whole number.
    """
    repeated = names.groupBy("ptid", "fname").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    ends = repeated.select("ptid", F.col("fname").alias("_end"))
    # Every name is cut into its ends once, in the posts that repeat a name.
    near = names.join(ends.select("ptid").distinct(), "ptid", "left_semi").select("ptid", "fname").distinct()
    tail = F.explode(F.transform(F.sequence(F.lit(1), F.length("fname")), lambda at: F.substring("fname", at, F.length("fname"))))
    family = near.where(F.length("fname") > 0).select("ptid", "fname", tail.alias("_end")).join(ends, ["ptid", "_end"])
    counted = number_in_group(names.join(family, ["ptid", "fname"]), ["ptid", "_end"], "ord", "_no")
    own = counted.where(F.col("fname") == F.col("_end"))
    first = own.groupBy("ptid", "fname").agg(F.min("ord").alias("_first"), F.max("_no").alias("_most"))
    # Names that are a number, "_" and the end.
    number = F.regexp_extract("fname", r"\A([0-9]+)_", 1)
    rivals = family.withColumn("_taken", number).where(
        (F.length("_taken") > 0) & (F.col("fname") == F.concat("_taken", F.lit("_"), "_end"))
    )
    widest = rivals.groupBy("ptid", F.col("_end").alias("fname")).agg(F.max(F.length("_taken")).alias("_wide"))
    taken = rivals.select("ptid", F.col("_end").alias("fname"), "_taken", F.lit(True).alias("_clash"))
    later = (
        own.join(first, ["ptid", "fname"])
        .where(F.col("ord") > F.col("_first"))
        .withColumn("_taken", F.col("_no").cast("string"))
        .join(taken, ["ptid", "fname", "_taken"], "left")
        .join(widest, ["ptid", "fname"], "left")
    )
    width = F.greatest(F.coalesce("_wide", F.lit(0)), F.length(F.col("_most").cast("string"))) + 1
    padded = F.concat(F.repeat(F.lit("0"), width - F.length("_taken")), "_taken")
    stored = F.concat(F.when(F.col("_clash"), padded).otherwise(F.col("_taken")), F.lit("_"), "fname")
    return later.select("ptid", "fname", "ord", stored.alias("_name"))


def image_files(fetched: DataFrame) -> DataFrame:
    """``(ptid, path, content)`` of fetched images; failed ones drop out, the last one wins."""
    good = fetched.where(F.col("content").isNotNull())
    named = image_paths(good)
    return (
        named.groupBy("ptid", "path")
        .agg(F.max_by("content", "ord").alias("content"))
        .select("ptid", "path", "content")
    )
