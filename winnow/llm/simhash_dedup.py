"""SimHash near-dedup: fingerprints linked through a Gray-order hierarchical index.

* Fingerprints: XXH64 (seed 42) of three-word shingles, majority vote per bit, 64 bits.
* Exact copies of a fingerprint meet in one aggregate; all further work is on distinct ones.
* Routing: of the four 16-bit blocks of two fingerprints within 3 bits, one is equal.  Each
  fingerprint goes to its four (block, value) groups, so every link meets in one of them.  A group
  above ``GROUP_ROWS`` is cut by further bits; its members also visit the cells whose bits differ in
  at most 3 places, so no link is lost and no task holds an unbounded group.
* Index: within a task the rotated fingerprints are sorted by Gray rank.  ``FANOUT`` neighbours
  form a leaf, ``FANOUT`` leaves an upper node, and so on to the root of the group.  A node keeps
  the bits that all its members share, less those its parent already holds.  A search walks down,
  adds the differences in those bits, and drops a whole node once the sum exceeds the radius, or
  once the node is known to lie in the searcher's own component.
* A task returns a spanning forest, at most one edge per member, never the pairs.

NULL and empty texts have fingerprint zero and link like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import map_texts, store, unused
from winnow.llm.graph import connected, find_roots, unite

RADIUS = 3
SEED = 42
SHINGLE = 3
FANOUT = 8
GROUP_ROWS = 1 << 20  # a larger group is cut into cells
_FRONTIER = 1 << 20  # most (search, node) pairs held at once


def fingerprint(text: str | None) -> int:
    """64-bit fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(SHINGLE))))
        n = len(words) - SHINGLE + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        size = min(1 << 16, n - at)
        hashes = np.fromiter((digest(s, SEED) for s in islice(shingles, size)), np.uint64, size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each 64-bit pattern in reflected Gray order."""
    rank = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _distance(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int8)


class GrayIndex:
    """Forest over groups of 64-bit patterns; members of a group are contiguous in Gray order."""

    def __init__(self, patterns: np.ndarray, group: np.ndarray):
        self.items = patterns
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[first, len(group)])
        number = np.repeat(np.arange(len(first)), size)
        place = np.arange(len(group)) - first[number]
        self.levels = []  # leaves first: child bounds, item bounds, mask, pattern
        width, below = FANOUT, np.arange(len(group) + 1)
        while True:
            key = number * (int(size.max()) // width + 1) + place // width
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            bounds = np.r_[starts, len(group)]
            every = np.bitwise_and.reduceat(patterns, starts)
            some = np.bitwise_or.reduceat(patterns, starts)
            mask = ~(every ^ some)
            children = np.searchsorted(below, bounds)
            self.levels.append([children, bounds, mask, every & mask])
            below = bounds
            if len(starts) == len(first):
                break
            width *= FANOUT
        # Bits a parent already holds are factored out of its children.
        for level, upper in zip(self.levels, self.levels[1:]):
            parent = np.repeat(np.arange(len(upper[2])), np.diff(upper[0]))
            level[2] = level[2] & ~upper[2][parent]
            level[3] = level[3] & level[2]
        self.leaf_mask = np.zeros(len(patterns), np.uint64)  # bits held on the way to an item
        for _, bounds, mask, _ in self.levels:
            self.leaf_mask |= np.repeat(mask, np.diff(bounds))
        self.root_of = number
        self.group_size = size[number]

    def components(self, radius: int = RADIUS) -> np.ndarray:
        """Index of the first member of each item's component, by links within ``radius``."""
        parent = np.arange(len(self.items))
        work = np.cumsum(self.group_size)
        at = 0
        while at < len(self.items):
            end = max(at + 1, int(np.searchsorted(work, work[at] + _FRONTIER)))
            self._search(np.arange(at, end), parent, radius)
            at = end
        find_roots(parent)
        return parent

    def _search(self, query: np.ndarray, parent: np.ndarray, radius: int) -> None:
        find_roots(parent)
        node, apart = self.root_of[query], np.zeros(len(query), np.int8)
        for depth in range(len(self.levels) - 1, -1, -1):
            children, bounds, mask, value = self.levels[depth]
            apart = apart + _distance((self.items[query] & mask[node]) ^ value[node])
            # A node is one component if its least and greatest roots agree.
            low = np.minimum.reduceat(parent, bounds[:-1])
            high = np.maximum.reduceat(parent, bounds[:-1])
            known = (low[node] == high[node]) & (low[node] == parent[query])
            keep = (apart <= radius) & ~known & (bounds[node + 1] > query + 1)
            query, node, apart = query[keep], node[keep], apart[keep]
            if not len(query):
                return
            count = children[node + 1] - children[node]
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            node = np.repeat(children[node], count) + offset
            query, apart = np.repeat(query, count), np.repeat(apart, count)
        later = node > query
        query, node, apart = query[later], node[later], apart[later]
        rest = (self.items[query] ^ self.items[node]) & ~self.leaf_mask[node]
        near = apart + _distance(rest) <= radius
        unite(parent, query[near], node[near])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group and Gray rank: index whole groups, return spanning edges."""

    def linked(rows):
        block, key, cell, fp = rows
        turn = (block * 16).astype(np.uint64)
        raw = fp.view(np.uint64)
        turned = np.where(turn == 0, raw, (raw << turn) | (raw >> (np.uint64(64) - turn) % np.uint64(64)))
        edge = np.r_[True, (block[1:] != block[:-1]) | (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]
        group = np.cumsum(edge)
        order = np.lexsort((gray_rank(turned), group))
        index = GrayIndex(turned[order], group[order])
        root = index.components()
        child = np.flatnonzero(root != np.arange(len(root)))
        fp = fp[order]
        return pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[root[child]])], ["a", "b"])

    held, size = [], 0
    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)])
        size += batch.num_rows
        if size < 1 << 18:
            continue
        rows = [np.concatenate(c) for c in zip(*held, strict=True)]
        same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1])
        cut = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield linked([c[:cut] for c in rows])
        held, size = [[c[cut:] for c in rows]], len(same) - cut
    if size:
        yield linked([np.concatenate(c) for c in zip(*held, strict=True)])


def links(prints: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints of column ``fp`` (bigint).

    The edges span every component that links of at most 3 bits form inside a group; each edge is a
    pair of fingerprints of one component.
    """
    routed = prints.select(
        "fp", F.explode(F.array(*(F.lit(k) for k in range(4)))).alias("block")
    ).withColumn("key", F.expr("shiftrightunsigned(fp, 48 - 16 * block) & 65535"))
    sizes = routed.groupBy("block", "key").agg(F.count(F.lit(1)).alias("rows"))
    large = sizes.filter(F.col("rows") > group_rows).select(
        "block", "key", F.least(F.ceil(F.log2(F.col("rows") / group_rows)), F.lit(12)).cast("int").alias("bits")
    )
    # The cell of a row: the bits that follow the key in the rotated fingerprint.
    own = F.expr("shiftrightunsigned(if(block = 3, fp, shiftleft(fp, 16 * block + 16)), 64 - bits)")
    cells = F.expr(
        "filter(transform(sequence(0, shiftleft(1, bits) - 1), m -> if(bit_count(m) <= 3, own ^ m, -1L)), "
        "c -> c >= 0 AND c <= own)"
    )
    cut = (
        routed.join(large, ["block", "key"])
        .withColumn("own", own)
        .select("block", "key", F.explode(cells).alias("cell"), "fp")
    )
    whole = routed.join(large, ["block", "key"], "left_anti").select(
        "block", "key", F.lit(0).cast("long").alias("cell"), "fp"
    )
    keys = ["block", "key", "cell"]
    return (
        whole.unionAll(cut)
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_forest, "a long, b long")
    )


def _hashed(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """Columns ``keep`` and the fingerprint ``fp`` of every row, stored."""

    def setup():
        def work(texts):
            found = np.fromiter((fingerprint(text) for text in texts), np.uint64, len(texts))
            return [found.view(np.int64)]

        return work

    return store(map_texts(docs, setup, "fp long", keep, text_col), "fingerprints")


def _rooted(prints: DataFrame) -> DataFrame:
    """``prints`` (one row per ``fp``) with ``root``, the fingerprint that stands for the component."""
    roots = connected(links(prints.select("fp"))).withColumnRenamed("node", "fp")
    return prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most 3 bits.  Rows with a NULL
    id take part in links but never name a component.
    """
    hashed = _hashed(docs, [id_col], text_col)
    prints = store(hashed.groupBy("fp").agg(F.min(id_col).alias("least")), "prints")
    rooted = _rooted(prints)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return hashed.join(named, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row left of every component: smallest id, then smallest hash of the text.

    Ids need not be unique: components are told apart by fingerprints, rows by id and text.  Of rows
    equal in both one stays.  Rows with a NULL id cannot be told apart and all stay.
    """
    text_hash = unused("_text_hash", docs.columns)
    marked = docs.withColumn(text_hash, F.xxhash64(text_col))
    hashed = _hashed(marked, [id_col, text_hash], text_col)
    named = F.when(F.col(id_col).isNotNull(), F.struct(F.col(id_col).alias("id"), F.col(text_hash).alias("hash")))
    prints = store(hashed.groupBy("fp").agg(F.min(named).alias("least")), "prints")
    first = _rooted(prints).groupBy("root").agg(F.min("least").alias("least")).filter("least IS NOT NULL")
    first = store(first.select(F.col("least.id").alias(id_col), F.col("least.hash").alias(text_hash)), "first")
    keys = [id_col, text_hash]
    kept = marked.join(first, keys, "left_semi").select(*marked.columns)
    repeated = hashed.join(first, keys, "left_semi").groupBy(*keys).count().filter("count > 1").select(*keys)
    if not repeated.isEmpty():
        # Combined on the map side: a row that was loaded very often is no single task.
        order = F.xxhash64(*(name for name, kind in docs.dtypes if "map<" not in kind))
        many = kept.join(repeated, keys, "left_semi").groupBy(*keys).agg(
            F.min_by(F.struct(*docs.columns), order).alias("_row")
        )
        kept = kept.join(repeated, keys, "left_anti").select(*docs.columns).unionByName(many.select("_row.*"))
    return kept.select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))
