"""Captured responses: typed frame, merge across archives, fetch results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.urls import image_fallback
from winnow.operators.ordering import keep_first, keep_first_wide


def status_code(statusline: Column) -> Column:
    """First word of a status line as int, NULL when malformed."""
    return F.split(F.ltrim(statusline), r"\s+")[0].try_cast("int")


def captures(records: DataFrame) -> DataFrame:
    """Typed captures of scanned archive records: ``ord, target_uri, status, content...``."""
    return records.select(
        "ord",
        "target_uri",
        status_code(F.col("statusline")).alias("status"),
        F.col("content_length").try_cast("bigint").alias("content_length"),
        "content",
    )


def decoded(frame: DataFrame) -> DataFrame:
    """Captures with the body as text; bytes that are no UTF-8 become replacement characters."""
    return frame.withColumn("content", F.make_valid_utf8(F.col("content").cast("string")))


def under_status(frame: DataFrame, max_status: int = 399) -> DataFrame:
    """Drop responses above the status ceiling; a ceiling of 0 keeps all."""
    return frame.where(F.col("status") <= max_status) if max_status > 0 else frame


def merge_captures(frame: DataFrame) -> DataFrame:
    """First capture per target URI over all archives in ``ord`` order."""
    return keep_first_wide(frame, F.col("target_uri"))


def stack_headers(entries: Column) -> Column:
    """``array<struct<name,value>>`` as ``map<name, array<value>>``; names keep their order."""
    names = F.array_distinct(F.transform(entries, lambda e: e["name"]))
    return F.map_from_entries(
        F.transform(
            names,
            lambda name: F.struct(
                name,
                F.transform(
                    F.filter(entries, lambda e: e["name"] == name), lambda e: e["value"]
                ),
            ),
        )
    )


def fetch_tally(results: DataFrame) -> DataFrame:
    """Numbers of good and failed fetches."""
    ok = F.coalesce(F.col("ok"), F.lit(False))
    return results.agg(
        F.count_if(ok).alias("ok_count"), F.count_if(~ok).alias("fail_count")
    )


def results_with_dates(results: DataFrame, links: DataFrame) -> DataFrame:
    """Each dated link with the result of its fetch (NULLs where the fetch is missing).

    A URL that was fetched more than once counts with its first result (smallest ``ord``), so a
    link gives one row whatever the results hold.
    """
    return links.join(keep_first(results, ["url"]).drop("ord"), "url", "left")


def images_to_retry(results: DataFrame) -> DataFrame:
    """Failed archived images with the original address to try next."""
    again = results.withColumn("retry_url", image_fallback(F.col("url"), F.col("ok")))
    return again.where(F.col("retry_url").isNotNull())


def pending_images(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Images whose ``(ptid, fname)`` is not stored yet."""
    return wanted.join(existing, ["ptid", "fname"], "left_anti")
