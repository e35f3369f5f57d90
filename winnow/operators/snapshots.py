"""Nearest archived snapshot of a URL in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions.urls import stamp_seconds

# A time slice spans 2**SLICE_BITS seconds (18 hours).
SLICE_BITS = 16


def nearest_snapshot(requests: DataFrame, index: DataFrame) -> DataFrame:
    """Left outer as-of join: each ``(url, stamp)`` gets the snapshot nearest in time.

    ``requests`` holds ``url, stamp`` and any further columns, ``index`` the columns
    ``original, timestamp, archive_url`` and any further ones, which the result carries too (those
    that ``requests`` has keep the value of the request).  Ties go to the earlier snapshot.  Without
    a hit the columns of the index are NULL and ``original`` is the URL itself.  ``available`` tells
    hits, ``status`` repeats ``statuscode`` where the index has one.

    No pairs of requests and snapshots are formed.  Both sides are reduced to distinct
    seconds and cut into time slices of a URL, so a window group holds at most two rows per
    second of one slice; the nearest snapshots outside it come from a table with one row per
    URL and slice.  A URL that owns a third of all rows is therefore spread over its slices.
    Only times travel through the windows; the addresses join at the end.
    """
    told = {*requests.columns, "original", "archive_url", "timestamp", "available", "status"}
    rest = [name for name in index.columns if name not in told]
    timed = requests.withColumn("_at", stamp_seconds(F.col("stamp")))
    known = index.select(
        F.col("original").alias("url"),
        stamp_seconds(F.col("timestamp")).alias("at"),
        "timestamp",
        "archive_url",
        *rest,
    ).where(F.col("at").isNotNull() & F.col("url").isNotNull())
    asked = timed.select("url", F.col("_at").alias("at")).where(
        F.col("at").isNotNull() & F.col("url").isNotNull()
    )
    moments = (
        known.select("url", "at", F.lit(0).alias("asks"))
        .unionByName(asked.select("url", "at", F.lit(1).alias("asks")))
        .distinct()
    )
    timeline = moments.select(
        "url",
        F.shiftright("at", SLICE_BITS).alias("slice"),
        "at",
        "asks",
        F.when(F.col("asks") == 0, F.col("at")).alias("hit"),
    )

    so_far = Window.unboundedPreceding
    inside = Window.partitionBy("url", "slice")
    ahead = inside.orderBy("at", "asks").rowsBetween(so_far, Window.currentRow)
    back = inside.orderBy(F.desc("at"), F.desc("asks")).rowsBetween(so_far, Window.currentRow)
    near = (
        timeline.withColumn("before", F.last("hit", ignorenulls=True).over(ahead))
        .withColumn("after", F.last("hit", ignorenulls=True).over(back))
        .where(F.col("asks") == 1)
        .select("url", "slice", "at", "before", "after")
    )

    by_url = Window.partitionBy("url")
    slices = (
        timeline.groupBy("url", "slice")
        .agg(F.min("hit").alias("first_hit"), F.max("hit").alias("last_hit"))
        .select(
            "url",
            "slice",
            F.last("last_hit", ignorenulls=True)
            .over(by_url.orderBy("slice").rowsBetween(so_far, -1))
            .alias("earlier"),
            F.last("first_hit", ignorenulls=True)
            .over(by_url.orderBy(F.desc("slice")).rowsBetween(so_far, -1))
            .alias("later"),
        )
    )

    # Smallest gap first, then the earlier snapshot: the field order of the struct.
    candidates = [
        F.when(
            F.col(name).isNotNull(), F.struct(F.abs(F.col(name) - F.col("at")), F.col(name).alias("t"))
        )
        for name in ("before", "after", "earlier", "later")
    ]
    named = known.groupBy("url", F.col("at").alias("hit_at")).agg(
        F.min(F.struct("archive_url", "timestamp", *rest)).alias("hit")
    )
    answers = (
        near.join(slices, ["url", "slice"])
        .select("url", F.col("at").alias("_at"), F.least(*candidates)["t"].alias("hit_at"))
        .join(named, ["url", "hit_at"])
        .select("url", "_at", "hit.*")
    )
    status = F.col("statuscode") if "statuscode" in rest else F.lit(None).cast("string")
    return (
        timed.join(answers, ["url", "_at"], "left")
        .withColumn("original", F.col("url"))
        .withColumn("available", F.col("archive_url").isNotNull())
        .withColumn("status", status)
        .select(
            *requests.columns,
            *(
                name
                for name in ("archive_url", "timestamp", "original", *rest, "available", "status")
                if name not in requests.columns
            ),
        )
    )
