"""Cross-tokenizer alignment: where a byte-level BPE and a SentencePiece model cut the same bytes.

Both tokenizers read a blank and the text.  Token ends are sorted lists of byte offsets.  The shorter
list of a document drives a galloping search into the longer one: from the place of the last answer
the step doubles until it passes the wanted offset, then a binary search closes in.  Many stretches of the
lists advance together, one element per round, as numpy arrays.  Offsets found in both lists cut the
tokens into groups, and the ranks of neighbouring ends give the range of tokens that a token overlaps.

How often an id pair is linked in the whole corpus is counted from the distinct pairs of bundles of
documents: summed by pair, compared with the other pairs of the same id, and sent back to the bundles
that hold the pair.  Links themselves stay in the stored bundles.  All of it are rows of fixed
size under distinct keys, so no key, document or source makes a large group.

Control strings are plain text to both tokenizers.  NULL and empty texts, and texts that the tokens of
either side do not spell, have no tokens: zeros and ''.  Repeated rows and NULL ids are kept as
rows of their own.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm import chunk_tokens
from winnow.llm.bundles import expand_planes, ranges, squeeze_planes
from winnow.llm.common import rows_of, store, write

BLANK = "▁"
BUNDLE_CHARS = 4 << 20
SLICE_CHARS = 1 << 20  # aligned at a time
LANES = 4096
# One number for a pair: the id of the second tokenizer is above that of the first.
PAIR_BITS = 32


class Pieces:
    """A SentencePiece model as an encoder of chunks; raises if chunks could not be encoded alone."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = _piece_bytes(self.model)
        self.lengths = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))

    def __call__(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Behind a line feed, which joins nothing, the chunk has no blank put in front.
        found = self.model.encode(["\n" + chunk for chunk in new], num_threads=1)
        return chunk_tokens.in_a_row([ids[2:] for ids in found])


def _piece_bytes(model) -> list[bytes]:
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            tokens.append(bytes([int(piece[3:5], 16)]))
        else:
            tokens.append(piece.replace(BLANK, " ").encode())
            inner = piece.lstrip(BLANK)
            if BLANK in inner or "\n" in piece or "\t" in piece:
                raise ValueError(f"piece {piece!r} joins chunks")
    head = model.encode("\n")
    if len(head) != 2 or model.id_to_piece(head[0]) != BLANK or not model.is_byte(head[1]):
        raise ValueError("the model does not put a blank in front, or has no bytes")
    return tokens


class Aligner:
    """The two tokenizers with a cache of chunks and the spelled ids."""

    def __init__(self, bytes_path: str, pieces_path: str):
        self.a, self.b = chunk_tokens.ByteLevel(bytes_path, special=False), Pieces(pieces_path)
        self.cache = chunk_tokens.ChunkCache([self.a, self.b], self.spelled)
        self.names = [_spelled_ids(self.a, (b",", b"|")), _spelled_ids(self.b, (b",", b";"))]

    def spelled(self, new: list[str], *found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Which chunks the tokens of both sides spell."""
        right = np.ones(len(new), bool)
        raw = [chunk.encode("utf-8", "replace") for chunk in new]
        length, whole = np.fromiter(map(len, raw), np.int64, len(raw)), b"".join(raw)
        for side, (ids, size) in zip((self.a, self.b), found, strict=True):
            tokens, at = [side.tokens[i] for i in ids.tolist()], 0
            after = np.r_[0, np.cumsum(side.lengths[ids])][np.r_[0, np.cumsum(size)]]
            if np.array_equal(np.diff(after), length) and b"".join(tokens) == whole:
                continue
            for k, n in enumerate(size.tolist()):
                right[k] &= b"".join(tokens[at : at + n]) == raw[k]
                at += n
        return right

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides and their number per text; a text without tokens counts zero."""
        ids, counts, right = self.cache.encode([" " + t if t else "" for t in texts])
        if not right.all():
            ids = [i[np.repeat(right, n)] for i, n in zip(ids, counts, strict=True)]
            counts = [n * right for n in counts]
        return ids, counts


def _spelled_ids(speller, marks: tuple[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids with either mark behind them at ``2 * id`` and ``2 * id + 1``, and their lengths."""
    names = [b"%d%s" % (i, mark) for i in range(len(speller.tokens)) for mark in marks]
    return np.array(names), np.fromiter(map(len, names), np.int64, len(names))


def gallop(short: np.ndarray, long: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """For every element of ``short`` the number of smaller elements of ``long``; both ascend.

    ``short`` is cut into stretches that advance together; each keeps its own place in ``long``.
    """
    count, size = len(short), len(long)
    if not count:
        return np.zeros(0, np.int64)
    each = -(-count // lanes)
    starts = np.arange(0, count, each)
    rank = np.empty(count, np.int64)
    place = np.searchsorted(long, short[starts])  # every stretch finds its own start
    padded = np.r_[long, np.iinfo(np.int64).max]
    for step in range(each):
        if starts[-1] + step >= count:
            starts, place = starts[:-1], place[:-1]
        wanted = short[starts + step]
        low, width = place.copy(), np.ones(len(starts), np.int64)
        open_ = np.flatnonzero(padded[low] < wanted)
        high = low.copy()
        while len(open_):  # exponential: everything up to ``low`` is smaller, look ``width`` further
            low[open_] += 1
            probe = np.minimum(low[open_] + width[open_] - 1, size)
            smaller = padded[probe] < wanted[open_]
            high[open_] = probe
            low[open_[smaller]] = probe[smaller]
            width[open_] *= 2
            open_ = open_[smaller]
        open_ = np.flatnonzero(low < high)
        while len(open_):  # binary, between the last smaller element and the first that is not
            middle = (low[open_] + high[open_]) >> 1
            smaller = padded[middle] < wanted[open_]
            low[open_[smaller]] = middle[smaller] + 1
            high[open_[~smaller]] = middle[~smaller]
            open_ = open_[low[open_] < high[open_]]
        rank[starts + step] = place = low
    return rank


def groups_and_links(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From the ends of both sides: is each short end common, ranks, first overlapped token, their number."""
    rank = gallop(short, long)
    common = long[np.minimum(rank, len(long) - 1)] == short
    first = np.r_[0, (rank + common)[:-1]]
    return common, rank, first, rank - first + 1


class Slice:
    """Documents of which one side, ``swapped`` or not, has no more tokens than the other, aligned."""

    def __init__(self, aligner: Aligner, ids: list[np.ndarray], counts: list[np.ndarray], swapped: bool):
        ends = [np.cumsum(s.lengths[i]) for s, i in zip((aligner.a, aligner.b), ids, strict=True)]
        small, large = (1, 0) if swapped else (0, 1)
        common, rank, first, size = groups_and_links(ends[small], ends[large])
        self.counts, self.after = counts, [np.r_[0, np.cumsum(n)] for n in counts]
        # Tokens up to the end of every group, on either side.
        cut = [None, None]
        cut[small], cut[large] = np.flatnonzero(common) + 1, rank[common] + 1
        self.n_groups = np.diff(np.searchsorted(cut[0], self.after[0], side="right"))
        self.n_links = np.add.reduceat(size, self.after[small][:-1])
        mine, other = np.repeat(ids[small], size), ids[large][ranges(first, size)]
        pair = (other, mine) if swapped else (mine, other)
        self.pairs = (pair[1].astype(np.int64) << PAIR_BITS) | pair[0]
        self.text, self.text_at = self._spell(aligner, ids, cut)

    def _spell(self, aligner: Aligner, ids: list[np.ndarray], cut: list[np.ndarray]) -> tuple[bytes, np.ndarray]:
        """All groups as text, and where the documents begin in it."""
        out = np.empty(len(ids[0]) + len(ids[1]), f"S{max(names.itemsize for names, _ in aligner.names)}")
        length = np.empty(len(out), np.int64)
        for side in (0, 1):
            last = np.zeros(len(ids[side]), np.int64)
            last[cut[side] - 1] = 1
            group = np.cumsum(last) - last
            before = np.r_[0, cut[1 - side]][group + side]  # tokens of the other side in front
            at = np.arange(len(ids[side])) + before
            names, sizes = aligner.names[side]
            key = 2 * ids[side].astype(np.int64) + last
            out[at], length[at] = names[key], sizes[key]
        text_at = np.r_[0, np.cumsum(length)][self.after[0] + self.after[1]]
        return out.tobytes().translate(None, b"\0"), text_at

    def digests(self) -> list[str]:
        view = memoryview(self.text)
        spans = zip(self.text_at[:-1].tolist(), self.text_at[1:].tolist())
        return [hashlib.sha256(view[a : b - 1]).hexdigest() for a, b in spans]

    def spelled(self) -> list[str]:
        text = self.text.decode()
        spans = zip(self.text_at[:-1].tolist(), self.text_at[1:].tolist())
        return [text[a : b - 1] for a, b in spans]


def align(
    docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``
    and ``groups``, the ids of every group (``a1,a2|b1;a3|b2,b3``), or with ``digest`` their SHA-256."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = source.schema["_id"].dataType.simpleString()
    fields = (
        f"kind string, bundle long, ids array<{id_type}>, groups array<string>, "
        "counts binary, links binary, pairs array<long>, times array<long>"
    )
    names = ["kind", "bundle", "ids", "groups", "counts", "links", "pairs", "times"]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = chunk_tokens.held(("align", bytes_path, pieces_path), lambda: Aligner(bytes_path, pieces_path))
        start, made = TaskContext.get().partitionId() << 30, 0
        keys, texts, chars, held = [], [], 0, 0
        ids, groups, counts, pairs = [], [], [], []

        def read():
            nonlocal keys, texts, chars
            flat, n = aligner.encode(texts)
            has, b_first = n[0] > 0, n[1] < n[0]
            for chosen, swapped in ((has & ~b_first, False), (has & b_first, True)):
                if not chosen.any():
                    continue
                mine = [f[np.repeat(chosen, m)] for f, m in zip(flat, n, strict=True)]
                some = Slice(aligner, mine, [m[chosen] for m in n], swapped)
                ids.extend(keys[k] for k in np.flatnonzero(chosen))
                groups.extend(some.digests() if digest else some.spelled())
                counts.append(np.stack([*some.counts, some.n_groups, some.n_links]))
                pairs.append(some.pairs)
            empty = np.flatnonzero(~has)
            ids.extend(keys[k] for k in empty)
            groups.extend([""] * len(empty))
            counts.append(np.zeros((4, len(empty)), np.int64))
            keys, texts, chars = [], [], 0

        def bundle(kind):
            nonlocal made, held, ids, groups, counts, pairs
            place, distinct = pd.factorize(np.concatenate([np.zeros(0, np.int64), *pairs]))
            times = np.bincount(place, minlength=len(distinct))
            packed = [squeeze_planes(np.concatenate(counts, axis=1)), squeeze_planes(place)]
            rows = [
                ("body", start + made, ids, groups, *packed, None, None),
                ("pair", start + made, None, None, None, None, distinct, times),
            ]
            types = [
                pa.string(), pa.int64(), pa.list_(kind), pa.list_(pa.string()), pa.binary(), pa.binary(),
                pa.list_(pa.int64()), pa.list_(pa.int64()),
            ]
            made, held, ids, groups, counts, pairs = made + 1, 0, [], [], [], []
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names
            )

        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            for i, text in rows_of(batch):
                keys.append(i)
                texts.append(text or "")
                chars += len(texts[-1])
                held += len(texts[-1]) + 64
                if chars >= SLICE_CHARS or len(keys) >= 1 << 14:
                    read()
                    if held >= BUNDLE_CHARS:
                        yield bundle(kind)
        if keys:
            read()
        if ids:
            yield bundle(kind)

    path = write(source.mapInArrow(aligned, fields), "aligned", by="kind")
    bodies = spark.read.schema(fields).parquet(path).filter("kind = 'body'").select("bundle", "ids", "groups", "counts", "links")
    pairs = spark.read.schema(fields).parquet(path).filter("kind = 'pair'").select(
        "bundle", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "both")
    ).select("bundle", "place", F.col("both.pairs").alias("pair"), F.col("both.times").alias("times"))
    # Corpus counts; those that are the highest of their id on the second side turn negative.
    second = F.shiftrightunsigned("pair", PAIR_BITS).alias("second")
    totals = pairs.groupBy("pair").agg(F.sum("times").alias("count")).select("pair", "count", second)
    counted = store(totals, "counts")
    highest = counted.groupBy("second").agg(F.max("count").alias("highest"))
    best = F.col("count") == F.col("highest")
    known = counted.join(highest, "second").select("pair", F.when(best, -F.col("count")).otherwise(F.col("count")).alias("count"))
    answers = pairs.select("bundle", "place", "pair").join(known, "pair").select("bundle", "place", "count")
    out = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    def tallied(body: pa.Table, answered: pa.Table) -> pa.Table:
        n = expand_planes(body.column("counts")[0].as_py()).astype(np.int64).reshape(4, -1)
        count = np.empty(answered.num_rows, np.int64)
        count[answered.column("place").to_numpy()] = answered.column("count").to_numpy()
        linked = count[expand_planes(body.column("links")[0].as_py())]
        after = np.r_[0, np.cumsum(n[3])]
        tally = [np.diff(np.r_[0, np.cumsum(x)][after]) for x in (linked < 0, np.abs(linked))]
        columns = [
            body.column("ids").combine_chunks().flatten(), *map(pa.array, n), *map(pa.array, tally),
            body.column("groups").combine_chunks().flatten(),
        ]
        return pa.table(dict(zip(out, columns, strict=True)))

    counts = ", ".join(f"{name} long" for name in out[1:-1])
    result = (
        bodies.groupBy("bundle").cogroup(answers.groupBy("bundle"))
        .applyInArrow(tallied, f"id {id_type}, {counts}, groups string")
    )
    return result.withColumnRenamed("id", id_col)
