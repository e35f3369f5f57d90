"""Bundles of texts and packs of their distinct keys: look-ups without a row per position.

A bundle is some megabytes of texts in one stored row.  What a bundle has to ask of the whole corpus
(counts of its words, ids of its words, chances of its byte windows) travels as packs: one row per
bundle and shard that holds the bundle's distinct keys of that shard.  A shard meets the packs of
all bundles in one task, and its answers go back to the bundles in the order of the keys.  The
number of shards follows the bytes of text, so neither side outgrows a task, and a key that
occurs everywhere counts once per bundle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import rows_of, store, write

END = b"\xff"  # never part of UTF-8
BUNDLE_BYTES = 8 << 20
NUMBERED_BYTES = 8 << 20  # of bundles that also hold a table of their words
BUNDLE_ROWS = 1 << 16
SHARD_BYTES = 16 << 20
PACK_FIELDS = "shard int, bundle long, keys binary, data binary"


def squeeze(raw: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(raw)


def expand(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def squeeze_numbers(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes; the kind of number is up to the reader."""
    return squeeze(np.ascontiguousarray(values).tobytes())


def expand_numbers(raw: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(expand(raw), kind)


def squeeze_planes(values: np.ndarray) -> bytes:
    """Small 32-bit numbers, byte plane by byte plane: the upper planes are nearly constant."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return squeeze(planes.tobytes(), 1)


def expand_planes(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(expand(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def squeeze_ranks(values: np.ndarray) -> bytes:
    """Numbers of which the small ones are frequent: a byte each, for the number itself or for its size and
    its upper bits, and the lower bits of each size after those of the next smaller one."""
    if len(values) and values.max() >= 1 << 23:
        return b"P" + squeeze_planes(values)
    values = values.astype("<u4")
    width = (np.maximum(np.frexp(values.astype(np.float32))[1] - 4, 0) * (values > 127)).astype(np.uint8)
    code = np.where(width > 0, 96 + 8 * width + ((values >> width) & 7), values).astype(np.uint8)
    order, edges = _by_width(width)
    parts = values[order].view(np.uint8).reshape(-1, 4)
    lower = [
        np.packbits(np.unpackbits(parts[edges[w] : edges[w + 1]], axis=1, count=w, bitorder="little")).tobytes()
        for w in range(4, 20)
    ]
    head = squeeze(code.tobytes())
    return b"R" + len(head).to_bytes(4, "little") + head + b"".join(lower)


def _by_width(width: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Places of the numbers with lower bits, by how many these are, and where each number of bits begins."""
    some = np.flatnonzero(width)
    edges = np.cumsum(np.bincount(width[some], minlength=20))
    return some[np.argsort(width[some], kind="stable")], [0, *edges.tolist()]


def expand_ranks(raw: bytes) -> np.ndarray:
    if raw[:1] == b"P":
        return expand_planes(raw[1:]).astype(np.int64)
    end = 5 + int.from_bytes(raw[1:5], "little")
    code = np.frombuffer(expand(raw[5:end]), np.uint8)
    width = np.where(code > 127, (code - 96) >> 3, 0).astype(np.uint8)
    values = np.where(code > 127, (8 | code & 7).astype(np.int64) << width, code)
    order, edges = _by_width(width)
    lower, at = np.frombuffer(raw, np.uint8, offset=end), 0
    found = np.zeros((len(order), 4), np.uint8)
    for w in range(4, 20):
        many = edges[w + 1] - edges[w]
        size = -(-many * w // 8)
        bits = np.unpackbits(lower[at : at + size], count=many * w).reshape(-1, w)
        found[edges[w] : edges[w + 1], : -(-w // 8)] = np.packbits(bits, axis=1, bitorder="little")
        at += size
    values[order] |= found.view("<u4").ravel()
    return values


def make_bundles(
    docs: DataFrame, prepare: Callable[[str | None], bytes], id_col: str, text_col: str,
    learn: Column | None = None, name: str = "bundles",
) -> DataFrame:
    """Stored rows ``bundle, ids, learned, body, n_bytes``; ``prepare`` makes the bytes of a text.

    A text above the size of a bundle has a bundle of its own.
    """
    source = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.lit(True) if learn is None else learn, F.lit(False)).alias("_learn"),
        F.col(text_col).cast("string").alias("_text"),
    )
    id_type = source.schema["_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = TaskContext.get().partitionId() << 30
        count, size, ids, learned, texts = 0, 0, [], [], []

        def bundle(kind):
            nonlocal count, size, ids, learned, texts
            row = [[start + count], [ids], [learned], [squeeze(END.join(texts), 3)], [size]]
            types = [pa.int64(), pa.list_(kind), pa.list_(pa.bool_()), pa.binary(), pa.int64()]
            count, size, ids, learned, texts = count + 1, 0, [], [], []
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types, strict=True)],
                ["bundle", "ids", "learned", "body", "n_bytes"],
            )

        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            for i, own, text in rows_of(batch):
                ids.append(i)
                learned.append(own)
                texts.append(prepare(text))
                size += len(texts[-1]) + 1
                if size >= BUNDLE_BYTES or len(ids) >= BUNDLE_ROWS:
                    yield bundle(kind)
        if ids:
            yield bundle(kind)

    return store(
        source.mapInArrow(
            pack, f"bundle long, ids array<{id_type}>, learned array<boolean>, body binary, n_bytes long"
        ),
        name,
    )


def texts_of(body: bytes) -> list[bytes]:
    return expand(body).split(END)


def shard_count(table: DataFrame, size: str | Column = "n_bytes") -> int:
    """Shards by the bytes of all texts; ``size`` gives those of a row."""
    total = table.agg(F.sum(size)).first()[0] or 0
    return max(16, -(-total // SHARD_BYTES))


def word_shards(words: Sequence[bytes], shards: int) -> np.ndarray:
    """Shard of every word: XXH64 as Spark's ``xxhash64`` computes it, modulo the shards."""
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(word, 42) for word in words), np.uint64, len(words))
    return hashes.view(np.int64) % shards


def word_shard(word: Column, shards: int) -> Column:
    """The same shard in the DataFrame API."""
    return F.pmod(F.xxhash64(word), F.lit(shards)).cast("int")


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    edges = np.flatnonzero(np.r_[True, shard[order][1:] != shard[order][:-1]]) if len(order) else []
    for at, end in zip(edges, [*edges[1:], len(order)], strict=True):
        yield int(shard[order[at]]), order[at:end]


def shards_in_order(shard: np.ndarray) -> dict[int, np.ndarray]:
    """Places of the keys of every shard, in the order in which a pack holds them."""
    return dict(_by_shard(shard))


def _packs(bundle: int, parts: Iterator[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    rows = list(parts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()), pa.array([bundle] * len(rows), pa.int64()),
            pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary()),
        ],
        ["shard", "bundle", "keys", "data"],
    )


def word_packs(
    bundles: DataFrame, count: Callable[[list[bytes], list[bool]], dict[bytes, int]], shards: int, name: str
) -> DataFrame:
    """Stored packs of the distinct words of each bundle; ``data`` holds a number per word (int64).

    ``count`` maps the texts of a bundle, and whether they are learned from, to those numbers.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, learned, body in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                counts = count(texts_of(body), learned)
                words = sorted(counts)
                numbers = np.fromiter(map(counts.__getitem__, words), np.int64, len(words))
                yield _packs(
                    bundle,
                    (
                        (shard, squeeze(END.join([words[i] for i in at])), squeeze_numbers(numbers[at]))
                        for shard, at in _by_shard(word_shards(words, shards))
                    ),
                )

    return store(bundles.select("bundle", "learned", "body").mapInArrow(packed, PACK_FIELDS), name)


def words_of(keys: bytes) -> list[bytes]:
    return expand(keys).split(END)


def number_packs(
    bundles: DataFrame, count: Callable[[list[bytes], list[bool]], tuple[np.ndarray, np.ndarray]],
    shard_of: Callable[[np.ndarray], np.ndarray], name: str,
) -> DataFrame:
    """Stored packs of distinct whole numbers, sorted; ``count`` gives numbers and their counts."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, learned, body in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                values, n = count(texts_of(body), learned)
                yield _packs(
                    bundle,
                    (
                        (shard, squeeze_numbers(np.diff(values[at], prepend=0)), squeeze_numbers(n[at]))
                        for shard, at in _by_shard(shard_of(values))
                    ),
                )

    return store(bundles.select("bundle", "learned", "body").mapInArrow(packed, PACK_FIELDS), name)


def numbers_of(keys: bytes) -> np.ndarray:
    return np.cumsum(expand_numbers(keys, np.int64))


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges ``first .. first + size``, one after the other."""
    after = np.cumsum(size)
    return np.arange(after[-1] if len(after) else 0) + np.repeat(first - (after - size), size)


class _Numbers(dict):
    """Word to number, in order of first appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def number_words(
    docs: DataFrame, setup: Callable[[], tuple], shards: int, id_col: str, text_col: str, name: str
) -> tuple[DataFrame, DataFrame, str, str]:
    """Texts as sequences of word numbers, and packs of the words that they number.

    Returns stored bundles (``bundle, ids, keys`` with the words per text, ``data`` with the numbers),
    stored packs (``shard, bundle, keys, data`` with the steps between the numbers of the keys) and
    their paths.  ``setup`` makes two functions, once per task: one splits a text into chunks, the
    other cuts a list of distinct chunks into words and gives the number of words of each chunk.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = source.schema["_id"].dataType.simpleString()
    names = ["kind", "shard", "bundle", "ids", "keys", "data"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # of earlier tasks in this worker
        split, cut = setup()
        start = TaskContext.get().partitionId() << 30
        count, size, ids, parts, chunks = 0, 0, [], [], _Numbers()

        def bundle(kind):
            nonlocal count, size, ids, parts, chunks
            numbers = _Numbers()
            cuts, per_chunk = cut(list(chunks))
            words_of_chunk = np.fromiter(map(numbers.__getitem__, cuts), np.int32, len(cuts))
            words = [word.encode() for word in numbers]
            in_chunks = np.concatenate([np.zeros(0, np.int32), *parts])
            many = per_chunk[in_chunks]
            sequence = words_of_chunk[ranges((np.cumsum(per_chunk) - per_chunk)[in_chunks], many)]
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            # Frequent words get small numbers, which pack well.
            order = np.argsort(-np.bincount(sequence, minlength=len(words)), kind="stable")
            place = np.empty(len(words), np.uint32)
            place[order] = np.arange(len(words))
            shard = word_shards(words, shards)[order]
            sizes = np.diff(np.r_[0, np.cumsum(many)][np.r_[0, ends]]).astype(np.uint32)
            rows = [("body", -1, ids, squeeze_numbers(sizes), squeeze_ranks(place[sequence]))]
            rows += [
                (
                    "pack", one, None, squeeze(END.join([words[i] for i in order[at]]), 3),
                    squeeze_numbers(np.diff(at, prepend=0).astype(np.uint32)),
                )
                for one, at in _by_shard(shard)
            ]
            columns = list(zip(*rows, strict=True))
            columns.insert(2, [start + count] * len(rows))
            types = [pa.string(), pa.int32(), pa.int64(), pa.list_(kind), pa.binary(), pa.binary()]
            count, size, ids, parts, chunks = count + 1, 0, [], [], _Numbers()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            for i, text in rows_of(batch):
                found = split(text) if text else []
                ids.append(i)
                parts.append(np.fromiter(map(chunks.__getitem__, found), np.int32, len(found)))
                size += len(text or "") + 1
                if size >= NUMBERED_BYTES or len(ids) >= BUNDLE_ROWS:
                    yield bundle(kind)
        if ids:
            yield bundle(kind)

    fields = f"kind string, shard int, bundle long, ids array<{id_type}>, keys binary, data binary"
    path = write(source.mapInArrow(pack, fields), name, by="kind")
    # An empty table has no folders of kinds; the filters on the partition column serve both cases.
    found = docs.sparkSession.read.schema(fields).parquet(path)
    return (
        found.filter("kind = 'body'").select("bundle", "ids", "keys", "data"),
        found.filter("kind = 'pack'").select("shard", "bundle", "keys", "data"),
        f"{path}/kind=body",
        f"{path}/kind=pack",
    )
