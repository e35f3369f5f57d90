"""SimHash near-dedup, components and decontamination against brute force."""

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.cases import ODD, SF, documents, empty_docs, odd_docs
from winnow.llm import decontaminate, graph, simhash_dedup
from winnow.llm.queries import QUERIES


def plain_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Least index per component of all pairs within 3 bits."""
    x = np.array(prints, np.uint64)
    parent = np.arange(len(x))
    for i in range(len(x)):
        near = np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 3)
        graph.unite(parent, np.full(len(near), i), near)
    graph.find_roots(parent)
    return parent


def test_query_on_table(spark):
    docs = documents()
    rows = {r.doc_id: r for r in QUERIES["op7_simhash_dedup"](spark, SF).collect()}
    prints = [plain_print(text) for _, text, _ in docs]
    parent = plain_components(prints)
    assert len(rows) == len(docs)
    for k, (i, _, _) in enumerate(docs):
        assert rows[i].fingerprint == f"{prints[k]:016x}"
        assert rows[i].component_id == docs[parent[k]][0]


def _close_prints(rng, n):
    centres = rng.integers(0, 1 << 63, n // 20, dtype=np.uint64)
    out = rng.choice(centres, n)
    for _ in range(4):
        flip = np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        out = np.where(rng.random(n) < 0.5, out ^ flip, out)
    return np.unique(out)


@pytest.mark.parametrize("group_rows", [1 << 20, 40, 8])
def test_links_find_all_components(spark, group_rows):
    """Also with groups cut into cells, and with one dense ball in a single block."""
    rng = np.random.default_rng(3)
    ball = np.uint64(0xABCD << 48) | (rng.integers(0, 1 << 9, 200, dtype=np.uint64) << np.uint64(20))
    prints = np.unique(np.concatenate([_close_prints(rng, 600), ball, np.array([0, 1, 2**64 - 1], np.uint64)]))
    frame = spark.createDataFrame([(int(v),) for v in prints.view(np.int64)], "fp long")
    roots = {r.node: r.root for r in graph.connected(simhash_dedup.links(frame, group_rows)).collect()}
    found = [roots.get(v, v) for v in prints.view(np.int64).tolist()]
    parent = plain_components(prints)
    pairs = set(zip(found, parent.tolist()))
    assert len(pairs) == len(set(found)) == len(set(parent.tolist()))


def test_gray_order_shares_prefixes():
    rank = simhash_dedup.gray_rank(np.arange(1 << 12, dtype=np.uint64))
    order = np.argsort(rank)
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()


def test_components_of_chains(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100 + k, 100) for k in range(1, 30)] + [(7, 7)]
    frame = spark.createDataFrame(chain, "a long, b long")
    found = {r.node: r.root for r in graph.connected(frame).collect()}
    assert found == {**{k: 0 for k in range(1, 61)}, **{100 + k: 100 for k in range(1, 30)}}
    assert graph.connected(frame.filter("false")).count() == 0


def test_odd_rows(spark):
    rows = simhash_dedup.near_groups(odd_docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by[i].component_id for i in (1, 2, 3)} == {1}
    assert {by[i].component_id for i in (4, 5, 6)} == {4} and by[4].fingerprint == "0" * 16
    assert simhash_dedup.near_groups(empty_docs(spark)).count() == 0

    kept = simhash_dedup.drop_near_copies(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids and ids.count(None) == 2
    assert simhash_dedup.drop_near_copies(empty_docs(spark)).count() == 0


def test_one_row_of_every_component_with_repeated_ids(spark):
    near = " ".join(f"w{k}" for k in range(400))  # three texts of one component
    copies = [near, near + " ", near.upper()]
    other = "a clean text that shares its id with a row of another source"
    rows = [
        (5, other, "a"), (5, copies[0], "b"), (7, copies[1], "c"),  # both rows of id 5 stand for a component
        (3, "first of a pair", "d"), (9, "First of a pair", "e"), (9, "nobody's copy at all", "f"),
        (2, "loaded twice", "g"), (2, "loaded twice", "h"), (4, copies[2], "i"), (4, other + " too, not a copy", "j"),
        (None, other, "k"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for parts in (1, 4):
        kept = simhash_dedup.drop_near_copies(frame.repartition(parts))
        found = sorted(r.source for r in kept.collect())
        assert kept.columns == frame.columns and [s for s in found if s not in "gh"] == list("adfijk")
        assert len(found) == 7


def plain_leaks(text, items):
    words = [decontaminate.normal(w) for w in (text or "").encode().split() and (text or "").split()]
    found = set()
    for item, item_text in items:
        own = [decontaminate.normal(w) for w in item_text.split()]
        grams = decontaminate.shingles(own)
        for at in range(max(1, len(words) - len(own) + 1)):
            passage = words[at : at + len(own)]
            if set(own[:9]) & set(passage) and decontaminate.similarity(decontaminate.shingles(passage), grams) >= 0.8:
                found.add(item)
                break
    return found


def test_leaks_on_table(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    docs = documents()[::4]
    found = {}
    for r in QUERIES["op6_decontaminate"](spark, SF).collect():
        assert r.similarity >= 0.8
        found.setdefault(r.doc_id, set()).add(r.item_id)
    for i, text, _ in docs:
        assert found.get(i, set()) == plain_leaks(text, items)


def test_every_position_edits_and_ends():
    rng = np.random.default_rng(5)
    item = [f"item{k}" for k in range(57)]
    search = decontaminate._searcher(decontaminate.Index([(9, " ".join(item)), (8, None), (7, "too short")]), 0.8)
    for before in range(0, 14):
        filler = [f"f{k}" for k in rng.integers(0, 1000, 200)]
        text = " ".join([*filler[:before], *item, *filler[before:]])
        assert [(x["item"], x["start"]) for x in search([text])[0]] == [(9, before)]
    for edit in range(57):
        changed = [*item[:edit], "other", *item[edit + 1 :]]
        near = decontaminate.similarity(decontaminate.shingles(changed), decontaminate.shingles(item)) >= 0.8
        assert bool(search([" ".join([*filler[:40], *changed, *filler[40:]])])[0]) == near
    assert search([" ".join(item).upper(), " ".join(item[:30]), " ".join(item[30:])])[1:] == [[], []]


@pytest.mark.parametrize("space", ["\u00a0", "\u202f", "\u2009", "\u3000", "\u2028", "\u0085", "\x1c"])
def test_items_and_documents_have_the_same_words(space):
    words = [f"mot{k}" for k in range(20)]
    item = f"{' '.join(words[:8])}{space}: {' '.join(words[8:14])}{space}{' '.join(words[14:])}"
    search = decontaminate._searcher(decontaminate.Index([(1, item)]), 0.8)
    leaks = search([f"before it {item} after it", item, item.replace(space, " ")])
    assert [[(x["similarity"], x["start"]) for x in one] for one in leaks] == [[(1.0, 2)], [(1.0, 0)], [(1.0, 0)]]


def clipped_best(words, own):
    """Best similarity of an item to a passage of its size, or to one cut by the ends of the text."""
    size, n = len(own), min(5, len(own))
    grams = decontaminate.shingles(own, n)
    passages = (words[max(0, at) : max(0, at + size)] for at in range(-size, len(words)))
    return max((decontaminate.similarity(decontaminate.shingles(p, n), grams) for p in passages), default=0.0)


def test_leaks_do_not_depend_on_neighbours_or_partitions(spark):
    """Edited and cut passages: no false one, nearly all true ones, alike under any partitioning."""
    rng = np.random.default_rng(8)
    sizes = [1, 2, 3, 4, 5, 8, 9, 11, 12, 16, 24, 31, 44, 57, 90]
    own = [[f"item{k}x{j}" for j in range(n)] for k, n in enumerate(sizes)]
    rows = []
    for i in range(600):
        words = list(own[i % len(own)])
        for _ in range(rng.integers(0, 3)):
            at = int(rng.integers(0, len(words)))
            words[at : at + int(rng.integers(0, 2))] = ["other"] * int(rng.integers(0, 2))
            words = words or ["other"]
        words = words[int(rng.integers(0, 1 + len(words) // 6)) :]
        filler = [f"f{k}" for k in rng.integers(0, 500, 40)]
        cut = int(rng.integers(0, 40)) if i % 4 else 0
        rows.append((i, " ".join([*filler[:cut], *words, *filler[cut : None if i % 4 else 0]])))
    items = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(own)], "item_id int, text string")
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    results = []
    for parts in (1, 7, 40):
        found = decontaminate.find_leaks(docs.repartition(parts), items).collect()
        results.append({r.doc_id: sorted((x["item"], x["similarity"], x["start"]) for x in r.leaks) for r in found})
    assert results[0] == results[1] == results[2]
    expected = {(i, k) for i, text in rows for k, w in enumerate(own) if clipped_best(text.split(), w) >= 0.8}
    given = {(i, k) for i, leaks in results[0].items() for k, *_ in leaks}
    assert given <= expected and len(given) >= 0.98 * len(expected)
    short = {(i, k) for i, k in expected if sizes[k] < 9}
    assert short and short <= given


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(6)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    queries = rng.choice(prints, 500)
    for _ in range(8):
        queries = queries ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    blocks = decontaminate._Blocks(prints)
    found = set(zip(*(x.tolist() for x in blocks.search(queries))))
    distance = np.bitwise_count(queries[:, None] ^ prints[None, :])
    assert found == set(zip(*(x.tolist() for x in np.nonzero(distance <= decontaminate.RADIUS))))


def test_leaks_odd_rows_slices_and_long_items(spark, monkeypatch):
    long_item = " ".join(f"long{k}" for k in range(400))
    rows = [(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, long_item), (4, long_item)]
    items = spark.createDataFrame(rows, "item_id long, text string").withColumn("leaks", F.lit(1))
    docs = odd_docs(spark).unionByName(
        odd_docs(spark).filter("doc_id = 7").withColumn("text", F.lit("before it " + long_item + " after it"))
    )
    monkeypatch.setattr(decontaminate, "SLICE_ITEMS", 2)
    found = decontaminate.find_leaks(docs, items)
    assert found.columns == [*[c for c in docs.columns if c != "leaks"], "leaks"]
    leaks = sorted((r.doc_id, x["item"]) for r in found.filter("doc_id IS NOT NULL").collect() for x in r.leaks)
    assert set(leaks) == {(1, 1), (2, 1), (3, 1), (7, 4)}
    assert decontaminate.find_leaks(empty_docs(spark), items).count() == 0
    assert all(not r.leaks for r in decontaminate.find_leaks(docs, items.filter("false")).collect())
