"""Nearest snapshot against brute force, with one hot URL, ties, gaps and bad stamps."""

import random
from datetime import datetime, timedelta

import pytest

from winnow.operators.snapshots import nearest_snapshot

START = datetime(2019, 12, 30)


def stamp(moment):
    return moment.strftime("%Y%m%d%H%M%S")


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    # most moments lie in a few days, some far away; seconds repeat often
    def moment():
        return START + timedelta(
            days=rng.choice([0, 1, 1, 2, 40, 400]), seconds=rng.choice([0, 5, 6, 7, 86399, 40000])
        )

    urls = ["hot"] * 5 + ["a", "b", "c", "d"]
    asks = [(i, rng.choice(urls + ["never"]), stamp(moment())) for i in range(400)]
    known = []
    for _ in range(150):
        url, at = rng.choice(urls), stamp(moment())
        known.append((url, at, f"arch/{at}/{url}"))
    return asks, known


def expected(asks, known):
    out = []
    for i, url, at in asks:
        moment = datetime.strptime(at, "%Y%m%d%H%M%S")
        hits = [
            (abs(datetime.strptime(s, "%Y%m%d%H%M%S") - moment), s, link)
            for u, s, link in known
            if u == url
        ]
        best = min(hits, default=(None, None, None))
        out.append((i, url, at, best[1], best[2], url))
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_equals_brute_force(spark, data, parts):
    asks, known = data
    left = spark.createDataFrame(asks, "i int, url string, stamp string").repartition(parts)
    index = spark.createDataFrame(
        known, "original string, timestamp string, archive_url string"
    ).repartition(parts)
    rows = nearest_snapshot(left, index).collect()
    found = sorted((r.i, r.url, r.stamp, r.timestamp, r.archive_url, r.original) for r in rows)
    assert found == expected(asks, known)


def test_bad_or_missing_stamps_keep_their_row(spark):
    left = spark.createDataFrame(
        [(1, "a", "junk"), (2, "a", None), (3, "a", "20200101000000")],
        "i int, url string, stamp string",
    )
    index = spark.createDataFrame(
        [("a", "20200102000000", "x"), ("a", "20191231000000", "y"), ("a", "bad", "z")],
        "original string, timestamp string, archive_url string",
    )
    rows = {r.i: r.archive_url for r in nearest_snapshot(left, index).collect()}
    assert rows == {1: None, 2: None, 3: "y"}  # a tie goes to the earlier snapshot


def test_stamps_do_not_depend_on_the_session_zone(spark, evaluate):
    from winnow.functions.urls import stamp_seconds

    stamps = ["20200308023000", "19700101000001", "20201301000000", "2020", "x" * 14, None]
    expected = [1583634600, 1, None, None, None, None]
    assert evaluate(stamp_seconds, stamps) == expected
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert evaluate(stamp_seconds, stamps) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_plan_forms_no_pairs(spark, data):
    asks, known = data
    left = spark.createDataFrame(asks, "i int, url string, stamp string")
    index = spark.createDataFrame(known, "original string, timestamp string, archive_url string")
    plan = nearest_snapshot(left, index)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
