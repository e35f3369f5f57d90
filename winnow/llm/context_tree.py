"""LM scoring: context-tree weighting over bytes, decomposed into binary decisions.

The text model is a sequence of tokens: words (A-Z lower-cased) and one end.  As bytes that is the
words joined by blanks and the byte FF, which UTF-8 never holds.  Each byte is eight binary
decisions; each of the 255 decision nodes has a context tree over the ``DEPTH`` bytes before.
Every tree node keeps the number of zeros and ones seen in learning rows, its
Krichevsky-Trofimov block estimate ``Pe`` and the weighted ``Pw``: ``Pe`` at full depth, else half
``Pe`` plus half the product over its children.  A byte is predicted by mixing the estimates of
all depths on its context path, each with the posterior weight that the learning rows give it.
The tree is frozen while scoring, so the score of a text is a proper probability, and learning
rows and held-out rows go through the same code.

At scale:

* Texts are packed into bundles of some megabytes.  A bundle sends its *distinct* byte windows and
  words with counts to the shuffle (see ``bundles``), never its positions.
* Counts of one context depend on its counts alone, so the tree is folded bottom-up in shards
  dealt out by the last three context bytes.  The windows of one such context number at most
  ``256**3`` (``DEPTH`` is 5).  Depths 2 to 0 have at most ``256**2 * 255`` nodes and a 255th of
  that on top; they are the only thing that is broadcast.  In UTF-8 a byte can follow only some
  others, so real text stays far below: tens of thousands of nodes for a few languages.
* A word or window that occurs everywhere counts once per bundle, so no key is hot.
* A window per byte exists for ``PIECE_BYTES`` of a bundle at a time; a bundle as a whole is held as its
  texts and its distinct windows.

NULL and empty texts consist of the end alone.  Repeated rows are scored each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm import bundles as bd
from winnow.llm.bundles import END
from winnow.llm.common import log_gamma, mixed, runs, store

DEPTH = 5
ROOT_DEPTH = 3  # trees below this depth are folded inside one task
PIECE_BYTES = 1 << 20  # of texts whose windows a task holds at a time; a longer text is a piece of its own
PIECE_CODES = 1 << 17  # of windows whose chances are mixed at a time
_HALF = math.log(0.5)


def _tokens(text: str | None) -> bytes:
    """The words of a text, lower-cased and joined by single blanks."""
    return b" ".join((text or "").encode("utf-8", "replace").lower().split())


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Window code of every byte and end of the texts, in order, and where each text starts.

    A code is the context, latest byte first, followed by the byte itself.
    """
    joined = END * DEPTH + (END * DEPTH).join(texts) + END
    raw = np.frombuffer(joined, np.uint8).astype(np.int64)
    code = np.zeros(len(raw) - DEPTH, np.int64)
    for back in range(1, DEPTH + 1):
        code = (code << 8) | raw[DEPTH - back : len(raw) - back]
    code = (code << 8) | raw[DEPTH:]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    gaps = sizes + (DEPTH - 1)  # an end is followed by DEPTH - 1 bytes of padding
    first = np.concatenate([[0], np.cumsum(gaps)[:-1]])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.arange(sizes.sum()) + np.repeat(first - starts, sizes)
    return code[at], starts


def pieces_of(texts: list[bytes]) -> Iterator[slice]:
    """The texts of a bundle, some at a time: up to ``PIECE_BYTES``, or one text."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        if k > first and size + len(text) >= PIECE_BYTES:
            yield slice(first, k)
            first, size = k, 0
        size += len(text) + 1
    yield slice(first, len(texts))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of several sorted parts, and the sums of their counts."""
    code, n = (np.concatenate(part) for part in zip(*parts, strict=True))
    order = np.argsort(code, kind="stable")  # of sorted runs
    code = code[order]
    edge = runs(code)
    return code[edge], np.add.reduceat(n[order], edge)


def _window_counts(texts: list[bytes], learned: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of a bundle, with their counts in learning rows."""
    parts = []
    for piece in pieces_of(texts):
        code, starts = windows(texts[piece])
        own = np.repeat(np.array(learned[piece], np.int64), np.diff(np.r_[starts, len(code)]))
        code <<= 1
        code |= own
        code.sort()
        n = code & 1
        code >>= 1
        edge = runs(code)
        parts.append((code[edge], np.add.reduceat(n, edge)))
    return _merged(parts)


def _word_counts(texts: list[bytes], learned: list[bool]) -> dict[bytes, int]:
    """Distinct words of a bundle, with their counts in learning rows."""
    counts: Counter = Counter()
    others: set = set()
    for text, own in zip(texts, learned, strict=True):
        (counts if own else others).update(text.split(b" ") if text else ())
    for word in others:
        counts.setdefault(word, 0)
    return counts


def _shard_of(shards: int):
    shift = 8 * (DEPTH - ROOT_DEPTH + 1)
    return lambda code: (mixed(code >> shift) % np.uint64(shards)).astype(np.int64)


def _estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov block probability."""
    return (
        log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)
    )


def _mix(chance, weight, zeros, ones, bit):
    """Mix the estimate of a node for ``bit`` into the chance from the deeper nodes."""
    own = (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1.0)
    return own if chance is None else weight * own + (1.0 - weight) * chance


def fold_tree(code: np.ndarray, n: np.ndarray, top: int = ROOT_DEPTH):
    """Fold the trees of complete contexts down to depth ``top``.

    Gives the chance of each window's eight decisions, mixed over depths ``DEPTH`` to ``top``, and
    the nodes at depth ``top``: key (context and decision), zeros, ones and log ``Pw``.
    """
    chances = np.empty((len(code), 8), np.float32)
    byte = code & 255
    context = code >> 8
    nodes = []
    for k in range(8):
        bit = (byte >> (7 - k)) & 1
        key, inverse = np.unique((context << 8) | (1 << k) | (byte >> (8 - k)), return_inverse=True)
        ones = np.bincount(inverse, n * bit, len(key))
        zeros = np.bincount(inverse, n * (1 - bit), len(key))
        weighted = _estimate(zeros, ones)
        levels = [(inverse, zeros, ones, None)]
        for _ in range(DEPTH - top):
            key, up = np.unique(((key >> 16) << 8) | (key & 255), return_inverse=True)
            ones, zeros, below = (np.bincount(up, v, len(key)) for v in (ones, zeros, weighted))
            own = _estimate(zeros, ones)
            weighted = _HALF + np.logaddexp(own, below)
            inverse = up[inverse]
            levels.append((inverse, zeros, ones, np.exp(_HALF + own - weighted)))
        chance = None
        for index, zeros_at, ones_at, weight in levels:
            chance = _mix(
                chance, None if weight is None else weight[index], zeros_at[index], ones_at[index], bit
            )
        chances[:, k] = chance
        nodes.append((key, zeros, ones, weighted))
    return chances, tuple(np.concatenate(part) for part in zip(*nodes, strict=True))


def _fold_shard(packs: pa.Table) -> pa.Table:
    """Sum the windows of one shard over all bundles and fold their trees.

    One row holds the windows with their chances; the others hold sums of the nodes one depth
    further up, which several shards share.
    """
    pa.default_memory_pool().release_unused()  # of earlier groups in this worker
    code, n = _merged(
        [
            (bd.numbers_of(keys.as_py()), bd.expand_numbers(data.as_py(), np.int64))
            for keys, data in zip(packs.column("keys"), packs.column("data"))
        ]
    )
    chances, (key, *sums) = fold_tree(code, n)
    key, up = np.unique(((key >> 16) << 8) | (key & 255), return_inverse=True)
    sums = [np.bincount(up, values, len(key)) for values in sums]
    blank = pa.nulls(1, pa.float64())
    return pa.table(
        {
            "shard": pa.array([packs.column("shard")[0].as_py()] * (len(key) + 1), pa.int32()),
            "codes": pa.array([bd.squeeze_numbers(np.diff(code, prepend=0)), *[None] * len(key)], pa.binary()),
            "chances": pa.array([bd.squeeze_numbers(chances), *[None] * len(key)], pa.binary()),
            "node": pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(key)]),
            "zeros": pa.concat_arrays([blank, pa.array(sums[0])]),
            "ones": pa.concat_arrays([blank, pa.array(sums[1])]),
            "weighted": pa.concat_arrays([blank, pa.array(sums[2])]),
        }
    )


def _count_shard(packs: pa.Table) -> pa.Table:
    """Total count of every word of one shard, back in the order of each pack."""
    words = [bd.words_of(raw) for raw in packs.column("keys").to_pylist()]
    total: dict[bytes, int] = {}
    for own, raw in zip(words, packs.column("data").to_pylist(), strict=True):
        for word, n in zip(own, bd.expand_numbers(raw, np.int64).tolist(), strict=True):
            total[word] = total.get(word, 0) + n
    known = sum(n > 0 for n in total.values())
    data = [bd.squeeze_numbers(np.fromiter(map(total.__getitem__, own), np.int64, len(own))) for own in words]
    return pa.table(
        {
            "shard": packs.column("shard"), "bundle": packs.column("bundle"), "keys": packs.column("keys"),
            "data": pa.array(data, pa.binary()),
            "known": pa.array([known, *[0] * (len(words) - 1)], pa.int64()),
            "total": pa.array([sum(total.values()), *[0] * (len(words) - 1)], pa.int64()),
        }
    )


def top_tables(nodes: pd.DataFrame) -> list[tuple[np.ndarray, ...]]:
    """Sorted keys, weights, zeros and ones of the levels from ``ROOT_DEPTH - 1`` up to the root."""
    nodes = nodes.sort_values("node")
    key, zeros, ones, below = (
        nodes[name].to_numpy(kind)
        for name, kind in (("node", np.int64), ("zeros", float), ("ones", float), ("weighted", float))
    )
    levels = []
    while True:
        own = _estimate(zeros, ones)
        weighted = _HALF + np.logaddexp(own, below)
        levels.append((key, np.exp(_HALF + own - weighted), zeros, ones))
        if len(levels) == ROOT_DEPTH:
            return levels
        key, up = np.unique(((key >> 16) << 8) | (key & 255), return_inverse=True)
        zeros, ones, below = (np.bincount(up, v, len(key)) for v in (zeros, ones, weighted))


def _log_chance(code: np.ndarray, chances: np.ndarray, levels: list) -> np.ndarray:
    """log10 of the chance of each window's byte, after mixing in the upper levels."""
    byte = code & 255
    total = np.zeros(len(code))
    for k in range(8):
        bit = (byte >> (7 - k)) & 1
        node = (1 << k) | (byte >> (8 - k))
        chance = chances[:, k]
        for depth, (key, weight, zeros, ones) in zip(range(ROOT_DEPTH - 1, -1, -1), levels):
            wanted = ((code >> (8 * (DEPTH + 1 - depth))) << 8) | node
            at = np.searchsorted(key, wanted)
            chance = _mix(chance, weight[at], zeros[at], ones[at], bit)
        total += np.log10(chance)
    return total


def score_texts(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, token counts, unigram ``base_score`` and ``score``.

    ``learn`` is a condition on the columns of ``docs`` that marks the learning rows.  ``n_bytes``
    counts the modelled bytes; ``bits_per_byte`` is the code length per byte.
    """
    spark = docs.sparkSession
    bundles = bd.make_bundles(docs, _tokens, id_col, text_col, learn)
    shards = bd.shard_count(bundles)

    words = store(
        bd.word_packs(bundles, _word_counts, shards, "words").groupBy("shard").applyInArrow(
            _count_shard, bd.PACK_FIELDS + ", known long, total long"
        ),
        "counts",
    )
    totals = words.agg(F.sum("known"), F.sum("total")).first()
    train_texts = bundles.agg(F.sum(F.size(F.filter("learned", lambda x: x)))).first()[0] or 0
    # The end is a token like any other: its count is the number of learning rows.
    train_tokens = (totals[1] or 0) + train_texts
    vocabulary = (totals[0] or 0) + (train_texts > 0)

    packs = bd.number_packs(bundles, _window_counts, _shard_of(shards), "windows")
    tree = store(
        packs.groupBy("shard").applyInArrow(
            _fold_shard,
            "shard int, codes binary, chances binary, node long, zeros double, ones double, weighted double",
        ),
        "tree",
    )
    upper = (
        tree.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")))
        .toPandas()  # at most 256**2 * 255 nodes
    )
    top = spark.sparkContext.broadcast(top_tables(upper))

    def answer(asked: pa.Table, folded: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # of earlier groups in this worker
        code = bd.numbers_of(folded.column("codes")[0].as_py())
        chances = bd.expand_numbers(folded.column("chances")[0].as_py(), np.float32).reshape(-1, 8)
        logs = np.empty(len(code), np.float32)
        for at in range(0, len(code), PIECE_CODES):
            some = slice(at, at + PIECE_CODES)
            logs[some] = _log_chance(code[some], chances[some].astype(np.float64), top.value)
        data = [
            bd.squeeze_numbers(logs[np.searchsorted(code, bd.numbers_of(raw.as_py()))])
            for raw in asked.column("keys")
        ]
        return pa.table(
            {
                "shard": asked.column("shard"), "bundle": asked.column("bundle"),
                "keys": pa.nulls(len(data), pa.binary()), "data": pa.array(data, pa.binary()),
            }
        )

    answers = (
        packs.select("shard", "bundle", "keys").groupBy("shard")
        .cogroup(tree.filter("node IS NULL").select("shard", "codes", "chances").groupBy("shard"))
        .applyInArrow(answer, bd.PACK_FIELDS)
    )
    facts = answers.unionByName(words.select("shard", "bundle", "keys", "data"))

    denominator = train_tokens + vocabulary + 1
    id_type = bundles.schema["ids"].dataType.elementType.simpleString()
    shard_of = _shard_of(shards)

    def scored(bundle: pa.Table, found: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # of earlier groups in this worker
        texts = bd.texts_of(bundle.column("body")[0].as_py())
        end = math.log10((train_texts + 1) / denominator)
        unknown = math.log10(1 / denominator)
        chance_of: dict[bytes, float] = {}
        logs_of: dict[int, bytes] = {}
        for shard, keys, data in zip(*(found.column(c) for c in ("shard", "keys", "data")), strict=True):
            shard, keys, data = shard.as_py(), keys.as_py(), data.as_py()
            if keys is None:
                logs_of[shard] = data
            else:
                n = bd.expand_numbers(data, np.int64)
                logs = np.log10((n + 1) / denominator)
                own = bd.words_of(keys)
                chance_of.update((own[i], float(logs[i])) for i in np.flatnonzero(n))
        n_tokens, n_known, base = [], [], []
        for text in texts:
            split = text.split(b" ") if text else []
            hits = [chance for chance in map(chance_of.get, split) if chance is not None]
            n_tokens.append(len(split) + 1)
            n_known.append(len(hits) + (train_texts > 0))
            base.append(math.fsum(hits) + (len(split) - len(hits)) * unknown + end)
        del chance_of
        everything, _ = _window_counts(texts, [False] * len(texts))
        value = np.empty(len(everything), np.float64)
        for shard, at in bd.shards_in_order(shard_of(everything)).items():
            value[at] = bd.expand_numbers(logs_of.pop(shard), np.float32)
        index, scores, sizes = pd.Index(everything), [], []
        for piece in pieces_of(texts):
            code, starts = windows(texts[piece])
            scores.append(np.add.reduceat(value[index.get_indexer(code)], starts))
            sizes.append(np.diff(np.r_[starts, len(code)]))
        score, n_bytes = np.concatenate(scores), np.concatenate(sizes)
        return pa.table(
            {
                "id": bundle.column("ids").combine_chunks().flatten(),
                "learned": bundle.column("learned").combine_chunks().flatten(),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array([train_tokens] * len(texts), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(score),
                "n_bytes": pa.array(n_bytes),
                "bits_per_byte": pa.array(-score / n_bytes * math.log2(10)),
            }
        )

    result = (
        bundles.select("bundle", "ids", "learned", "body").groupBy("bundle")
        .cogroup(facts.groupBy("bundle"))
        .applyInArrow(
            scored,
            f"id {id_type}, learned boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double, n_bytes long, bits_per_byte double",
        )
    )
    return result.withColumnRenamed("id", id_col)
