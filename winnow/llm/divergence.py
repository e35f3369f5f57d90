"""Source divergence audit: how the word use of every source differs from its language's other sources.

Terms are maximal runs of ASCII letters and of characters above U+007F, A-Z in lower case.  A language
keeps the terms that at least ``min_docs`` of its documents hold.  A group of ``N`` occurrences of the
``V`` kept terms gives a term that it holds ``c`` times the share ``1 + floor(10**9 (c + 1) / (N + V))``;
``divergence(p, q) = floor((p - q)**2 / q)``.  All arithmetic is on whole numbers.

The sum over all terms for a pair of sources falls into parts:

* ``V`` times the value for two counts of zero;
* what a single nonzero count changes, from the histogram of the counts of each source;
* what two nonzero counts change beyond that, from a frequent-pattern tree.  The row of a term is its
  nonzero (source, count) list in source order.  Equal rows become one with a multiplicity, and rows
  sorted by path form the tree: a node is a prefix, its multiplicity the sum of the rows behind it.  A
  node adds one correction per ancestor and direction, times its multiplicity.

At scale: rows are distinct after the merge, so ranges of sorted rows are even whatever source, term or
language is frequent; each range holds a tree of its own, and only nodes at its two ends are counted
in two parts, which sums allow.  A task holds one batch of rows at a time.

NULL texts, languages and sources are read as ''.  Rows with repeated ids are documents of their own.
Groups without terms have shares too; a language without kept terms has pairs of value 0 and no terms.
An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.bundles import ranges
from winnow.llm.common import forget, rows_of, store

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 10**9
SALTS = 64
HELD_TERMS = 400_000  # counts that a task holds before it passes them on
COMBINATIONS = 1 << 20  # of nodes and ancestors at a time
_CUT = bytes(
    code if code >= 0x80 or 0x61 <= code <= 0x7A else code + 32 if 0x41 <= code <= 0x5A else 0x20
    for code in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text, as UTF-8, in order."""
    return (text or "").encode("utf-8", "replace").translate(_CUT).split()


def count_terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``lang, source, term, n, df``: occurrences and documents; several rows per key, to be summed."""
    read = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences, documents = defaultdict(Counter), defaultdict(Counter)

        def flush():
            for (lang, source), count in occurrences.items():
                terms, found = list(count), documents[lang, source]
                for at in range(0, len(terms), 1 << 16):
                    some = terms[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(some)), pa.array([source] * len(some)),
                            pa.array(some, pa.binary()).cast(pa.string()),
                            pa.array([count[t] for t in some], pa.int64()),
                            pa.array([found[t] for t in some], pa.int64()),
                        ],
                        ["lang", "source", "term", "n", "df"],
                    )
            occurrences.clear()
            documents.clear()

        rows = 0
        for batch in batches:
            for lang, source, text in rows_of(batch):
                terms = terms_of(text)
                occurrences[lang, source].update(terms)
                documents[lang, source].update(set(terms))
                rows += 1
                if rows % 256 == 0 and sum(map(len, occurrences.values())) >= HELD_TERMS:
                    yield from flush()
        yield from flush()

    return docs.select(*(c.alias(n) for c, n in zip(read, ("lang", "source", "text"), strict=True))).mapInArrow(
        counted, "lang string, source string, term string, n long, df long"
    )


def share_sql(n: str, total: str, terms: str) -> str:
    """``1 + floor(SCALE * (n + 1) / (total + terms))``, exact for counts of any size."""
    above = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 1 AS DECIMAL(19,0))"
    return f"({above}) div CAST(greatest({total} + {terms}, 1) AS DECIMAL(19,0)) + 1"


def divergence_sql(p: str, q: str) -> str:
    return f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})"


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def tree_corrections(
    path: np.ndarray, many: np.ndarray, lang: np.ndarray, source: np.ndarray, p: np.ndarray, zero: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Pair corrections of the tree of some sorted rows, as arrays ``source, other`` and their sums.

    ``path`` holds the ends of the rows in the entry arrays ``source, p, zero`` (a source, its share
    for the count, its share for no count), ``many`` and ``lang`` one value per row.  Sources are
    numbers that differ between languages.
    """
    first = np.r_[0, path[:-1]]
    length = path - first
    # Entries that a row shares with the row before it, from the left.
    shared = np.zeros(len(path), np.int64)
    same = np.r_[False, lang[1:] == lang[:-1]]
    for depth in range(int(length.max(initial=0))):
        at = np.flatnonzero(same & (length > depth))
        at = at[length[at - 1] > depth]
        here, before = first[at] + depth, first[at - 1] + depth
        same[:] = False
        same[at[(source[here] == source[before]) & (p[here] == p[before])]] = True
        if not same.any():
            break
        shared[same] += 1
    # A node is an entry that its row does not share; its rows end where less than it is shared.
    weight = np.zeros(len(source), np.int64)
    for depth in range(int(length.max(initial=0))):
        opens = np.flatnonzero(shared <= depth)
        sums = np.add.reduceat(many, opens)
        own = length[opens] > depth
        weight[first[opens[own]] + depth] = sums[own]
    node = np.flatnonzero(weight)
    row = np.searchsorted(path, node, side="right")
    above = node - first[row]  # ancestors
    after = np.cumsum(above)
    kinds = int(source.max(initial=0)) + 1
    at = 0
    while at < len(node):
        end = max(at + 1, int(np.searchsorted(after, (after[at - 1] if at else 0) + COMBINATIONS, side="right")))
        mine = np.repeat(node[at:end], above[at:end])
        other = ranges(first[row[at:end]], above[at:end])
        times = weight[mine]
        a, b = (mine, other), (other, mine)
        keys = [source[x] * kinds + source[y] for x, y in (a, b)]
        change = [
            divergences(p[x], p[y]) - divergences(p[x], zero[y]) - divergences(zero[x], p[y]) + divergences(zero[x], zero[y])
            for x, y in (a, b)
        ]
        keys, change, times = np.concatenate(keys), np.concatenate(change), np.r_[times, times]
        kept, place = np.unique(keys, return_inverse=True)
        most = float(np.abs(change).max(initial=0)) * float(times.max(initial=0)) * len(times)
        sums = np.zeros(len(kept), np.int64 if most < 2.0**62 else object)
        if sums.dtype == object:
            change, times = change.astype(object), times.astype(object)
        np.add.at(sums, place, change * times)
        yield kept // kinds, kept % kinds, sums.tolist()
        at = end


def tree_sums(paths: DataFrame) -> DataFrame:
    """``lang, source, item, part``: sums of pair corrections from ``lang, many, path``, in parts."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, int] = defaultdict(int)

        def flush():
            keys = list(held)
            columns = [*zip(*keys, strict=True)] if keys else [[], [], []]
            types = [pa.string()] * 4
            values = [*columns, [str(held[k]) for k in keys]]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, types, strict=True)], ["lang", "source", "item", "part"]
            )

        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            lang = langs.indices.to_numpy()
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()[1:].astype(np.int64) - lists.offsets[0].as_py()
            entries = lists.flatten()
            names = entries.field(0).dictionary_encode()
            spelled, tongues = names.dictionary.to_pylist(), langs.dictionary.to_pylist()
            of_row = np.repeat(lang, np.diff(np.r_[0, ends]))
            source = names.indices.to_numpy().astype(np.int64) * len(tongues) + of_row
            found = tree_corrections(
                ends, batch.column(1).to_numpy(), lang, source,
                entries.field(1).to_numpy(), entries.field(2).to_numpy(),
            )
            for own, other, sums in found:
                for s, r, value in zip(own.tolist(), other.tolist(), sums, strict=True):
                    lang_of = tongues[s % len(tongues)]
                    held[lang_of, spelled[s // len(tongues)], spelled[r // len(tongues)]] += value
            if len(held) >= HELD_TERMS:
                yield flush()
        yield flush()

    found = paths.mapInArrow(summed, "lang string, source string, item string, part string")
    return found.withColumn("part", F.col("part").cast("decimal(38,0)"))


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources (``pair``) and terms (``term``) by value."""
    spark = docs.sparkSession
    counts = (
        count_terms(docs, text_col, lang_col, source_col)
        .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    )
    rows = store(
        counts.groupBy("lang", "term")
        .agg(
            F.sum("df").alias("df"), F.sum("n").alias("in_lang"),
            F.array_sort(F.collect_list(F.struct("source", "n"))).alias("row"),
        )
        .filter(F.col("df") >= min_docs)
        .drop("df"),
        "rows",
    )
    cells = rows.select("lang", "term", "in_lang", F.inline("row"))
    langs = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("in_lang").alias("lang_total"))
    groups = store(
        docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))))
        .distinct()
        .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang", "source",
            *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "lang_total")),
        )
        .withColumn("zero", F.expr(share_sql("0", "total", "terms"))),
        "groups",
    )
    found = _terms(cells, groups, top).unionByName(_pairs(spark, rows, cells, groups))
    return found.select("lang", "source", "part", "item", "value", "rank")


def _terms(cells: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The terms that a source uses more than its language, by divergence."""
    shares = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        F.expr(share_sql("n", "total", "terms")).alias("p"),
        F.expr(share_sql("in_lang", "lang_total", "terms")).alias("q"),
    )
    valued = shares.filter("p > q").select("lang", "source", "item", F.expr(divergence_sql("p", "q")).alias("value"))
    best = [F.desc("value"), F.asc("item")]
    # Ranks inside salted groups first: the last ranking meets at most SALTS * top rows of a group.
    salted = Window.partitionBy("lang", "source", "salt").orderBy(*best)
    first = (
        valued.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS)))
        .withColumn("rank", F.row_number().over(salted))
        .filter(F.col("rank") <= top)
        .drop("salt", "rank")
    )
    return (
        first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*best)))
        .filter(F.col("rank") <= top)
        .withColumn("part", F.lit("term"))
    )


def _pairs(spark, rows: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Each other source of the language, by the divergence summed over all kept terms."""
    wide = "decimal(38,0)"
    others = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"))
    both_zero = (
        groups.join(others, "lang").filter("source != item")
        .withColumn("part", F.expr(f"CAST(terms AS DECIMAL(19,0)) * CAST({divergence_sql('zero', 'other_zero')} AS DECIMAL(19,0))").cast(wide))
        .select("lang", "source", "item", "part")
    )
    salt = F.pmod(F.xxhash64("source", "n"), F.lit(SALTS))
    histogram = (
        cells.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("many"))
        .join(groups, ["lang", "source"])
        .select("lang", "source", "zero", "many", F.expr(share_sql("n", "total", "terms")).alias("p"), salt.alias("salt"))
    )
    one_zero = histogram.join(
        others.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["lang", "salt"]
    ).filter("source != item")
    change = "(({0}) - ({1})) * CAST(many AS DECIMAL(18,0))".format
    as_p = change(divergence_sql("p", "other_zero"), divergence_sql("zero", "other_zero"))
    as_q = change(divergence_sql("other_zero", "p"), divergence_sql("other_zero", "zero"))
    singles = one_zero.select(
        "lang",
        F.inline(
            F.expr(
                f"array(named_struct('source', source, 'item', item, 'part', CAST({as_p} AS DECIMAL(38,0))), "
                f"named_struct('source', item, 'item', source, 'part', CAST({as_q} AS DECIMAL(38,0))))"
            )
        ),
    )
    # Equal rows become one; its entries get their shares and come together again by its number.
    merged = store(
        rows.groupBy("lang", "row").agg(F.count(F.lit(1)).alias("many"))
        .withColumn("number", F.monotonically_increasing_id()),
        "merged",
    )
    entry = F.struct("source", F.expr(share_sql("n", "total", "terms")).alias("p"), "zero")
    paths = store(
        merged.filter(F.size("row") > 1).select("lang", "number", "many", F.inline("row"))
        .join(groups, ["lang", "source"])
        .groupBy("number")
        .agg(
            F.first("lang").alias("lang"), F.first("many").alias("many"),
            F.array_sort(F.collect_list(entry)).alias("path"),
        ),
        "paths",
    )
    forget(spark, merged.stored_at)
    doubles = tree_sums(
        paths.select("lang", "many", "path").repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    )
    summed = (
        both_zero.unionByName(singles).unionByName(doubles)
        .groupBy("lang", "source", "item").agg(F.sum("part").cast("long").alias("value"))
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return summed.withColumn("rank", F.row_number().over(best)).withColumn("part", F.lit("pair"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT row, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS in_lang FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 3),
cells AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(in_lang) AS total FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(l.total, 0) AS lang_total, coalesce(t.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN langs l USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL) t USING (lang, source)),
shares AS (
  SELECT lang, g.source, term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (g.total + v) AS p,
         1 + (1000000000::HUGEINT * (in_lang + 1)) // (lang_total + v) AS q
  FROM groups g JOIN kept USING (lang) LEFT JOIN cells c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, b.source, 0 FROM groups a JOIN groups b USING (lang)
  WHERE a.source <> b.source AND a.v = 0),
terms AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value FROM terms),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "C")::INTEGER AS rank
  FROM ranked)
SELECT * FROM numbered WHERE part = 'pair' OR rank <= 200
"""
