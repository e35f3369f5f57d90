"""Keep-first, running totals and numbering: brute force, hot keys, any partitioning."""

import random

import pytest
from pyspark.sql import functions as F

from winnow.operators import ordering as od


@pytest.fixture(scope="module")
def rows():
    """A third of the rows share one key."""
    rng = random.Random(3)
    keys = ["hot"] * 200 + [f"k{rng.randint(0, 60)}" for _ in range(400)]
    rng.shuffle(keys)
    return [(i * 3, key, f"p{i}", rng.randint(0, 9)) for i, key in enumerate(keys)]


def frame(spark, rows, parts):
    shuffled = random.Random(parts).sample(rows, len(rows))
    return spark.createDataFrame(shuffled, "ord long, key string, pay string, n long").repartition(
        parts
    )


def first_rows(rows):
    seen = {}
    for row in rows:
        seen.setdefault(row[1], row)
    return sorted(seen.values())


@pytest.mark.parametrize("parts", [1, 7])
def test_keep_first(spark, rows, parts):
    df = frame(spark, rows, parts)
    assert sorted(map(tuple, od.keep_first(df, ["key"]).collect())) == first_rows(rows)
    wide = od.keep_first_wide(df, F.col("key"))
    assert sorted(map(tuple, wide.select(*df.columns).collect())) == first_rows(rows)


def test_keep_first_is_idempotent(spark, rows):
    once = od.keep_first(frame(spark, rows, 3), ["key"])
    assert sorted(od.keep_first(once, ["key"]).collect()) == sorted(once.collect())


def test_ordered_distinct(spark, rows):
    found = od.ordered_distinct(frame(spark, rows, 5), "key").collect()
    assert sorted((r.key, r.ord) for r in found) == sorted((r[1], r[0]) for r in first_rows(rows))


@pytest.mark.parametrize("bits", [1, 5, 16])
@pytest.mark.parametrize("parts", [1, 7])
def test_running_total(spark, rows, bits, parts):
    found = od.running_total(frame(spark, rows, parts), "ord", "n", "t", block_bits=bits).collect()
    total, expected = 0, []
    for row in rows:
        expected.append((row[0], total))
        total += row[3]
    assert sorted((r.ord, r.t) for r in found) == expected


@pytest.mark.parametrize("bits", [1, 6, 16])
def test_number_in_group(spark, rows, bits):
    found = od.number_in_group(frame(spark, rows, 4), ["key"], "ord", "i", block_bits=bits)
    seen, expected = {}, []
    for row in rows:
        expected.append((row[0], row[1], seen.get(row[1], 0)))
        seen[row[1]] = seen.get(row[1], 0) + 1
    assert sorted((r.ord, r.key, r.i) for r in found.collect()) == expected


def test_hot_key_leaves_map_tasks_as_one_row(spark, rows):
    """The aggregate before the shuffle: no plan sends all rows of a key to one task."""
    plan = od.keep_first(frame(spark, rows, 4), ["key"])._jdf.queryExecution().toString()
    assert "partial_min_by" in plan


@pytest.mark.parametrize("parts", [1, 7])
def test_sparse_ords_number_through_all_levels(spark, parts):
    """One row per block, negative and far ``ord`` values: each level of blocks has rows of its own."""
    rng = random.Random(11)
    ords = sorted({rng.randrange(-(1 << 63), 1 << 63) >> rng.choice([0, 12, 30, 44]) for _ in range(500)})
    rows = [(o, rng.choice(["hot", "hot", f"k{i % 9}"]), "", rng.randint(0, 9)) for i, o in enumerate(ords)]
    df = frame(spark, rows, parts)
    total, seen, totals, numbers = 0, {}, [], []
    for o, key, _, n in rows:
        totals.append((o, total))
        numbers.append((o, seen.get(key, 0)))
        total += n
        seen[key] = seen.get(key, 0) + 1
    assert sorted((r.ord, r.t) for r in od.running_total(df, "ord", "n", "t").collect()) == totals
    assert sorted((r.ord, r.i) for r in od.number_in_group(df, ["key"], "ord", "i").collect()) == numbers


@pytest.mark.parametrize("parts", [1, 9])
def test_numbered(spark, parts):
    rng = random.Random(12)
    names = [f"é{rng.randint(0, 400)}" for _ in range(900)] + ["hot"] * 400
    found = od.numbered(frame(spark, [(i, k, "", 0) for i, k in enumerate(names)], parts), "key", "row_no").collect()
    found.sort(key=lambda r: r.row_no)
    assert [r.row_no for r in found] == list(range(len(names)))
    assert [r.key for r in found] == sorted(names, key=str.encode)
    assert sorted(r.ord for r in found) == list(range(len(names)))
    assert od.numbered(frame(spark, [], 1), "key", "row_no").count() == 0
