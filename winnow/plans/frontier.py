"""What to fetch next: wanted links, their snapshots and the two URL lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions import urls as ux
from winnow.operators.ordering import ordered_distinct
from winnow.operators.snapshots import nearest_snapshot
from winnow.staging import stored


def stamped_links(links: DataFrame) -> DataFrame:
    """Distinct ``(stamp, url)`` of dated links in first-seen order; URLs without query."""
    rows = links.select(
        F.struct("post_no", "pos").alias("ord"),
        ux.snapshot_stamp(F.col("post_date")).alias("stamp"),
        ux.canonical_url(F.col("url")).alias("url"),
    )
    return rows.groupBy("stamp", "url").agg(F.min("ord").alias("ord"))


def fetch_lists(links: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(live urls, archive urls, snapshot hits)``; both lists keep first-seen order.

    The stamped links are stored once; all branches read that table.
    """
    stamped = stored(stamped_links(links), "stamped")
    archived = ux.is_snapshot(F.col("url"))
    live = stamped.where(~archived)
    hits = nearest_snapshot(live, index)
    found = hits.where(F.col("archive_url").isNotNull()).select(
        F.struct(F.lit(0).alias("branch"), F.col("ord").alias("at")).alias("ord"),
        F.col("archive_url").alias("url"),
    )
    given = stamped.where(archived).select(
        F.struct(F.lit(1).alias("branch"), F.col("ord").alias("at")).alias("ord"), "url"
    )
    live_list = ordered_distinct(live.select("ord", "url"), "url")
    archive_list = ordered_distinct(found.unionByName(given), "url")
    return live_list, archive_list, hits


def fetch_frontier(links: DataFrame, index: DataFrame) -> DataFrame:
    """Both lists as one table ``(list, url)``; a URL may stand on both."""
    live, archive, _ = fetch_lists(links, index)
    return live.select(F.lit("live").alias("list"), "url").unionByName(
        archive.select(F.lit("archive").alias("list"), "url")
    )
