"""Packing by concatenation: all ids in one line, cut every ``length`` ids.

Two passes.  The first encodes the texts and stores them in bundles; a bundle knows how many ids its
task put out before it, so one total per task is all that the prefix sums need.  Their sums,
taken in blocks of tasks, give every bundle its place in the line.  The second pass cuts the bundles at
the multiples of ``length``.  Windows inside a bundle are finished there; what a bundle holds of the
windows at its two ends leaves as boundary records, which alone are shuffled and joined by window.

Only the last sequence of all can be short.  The line follows the partitions of the input.

NULL and empty texts are the end id alone.  Repeated rows, and rows with a NULL id, are documents
of their own.  An empty table gives no sequence.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm import chunk_tokens
from winnow.llm.bundles import expand_planes, squeeze_planes
from winnow.llm.common import prefix_sums, rows_of, store

LENGTH = 1024
END_ID = 0
BUNDLE_IDS = 1 << 20
READ_CHARS = 1 << 22  # encoded at a time; words that recur among them are looked up once


def encode_bundles(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """Stored rows ``part, inside, n, docs, sizes, ids``: documents in a row, ``inside`` ids before them."""
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = source.schema["_id"].dataType.simpleString()
    names = ["part", "inside", "n", "docs", "sizes", "ids"]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = chunk_tokens.byte_cache(tokenizer_path)
        part, inside = TaskContext.get().partitionId(), 0
        keys, sizes, flat, texts, chars = [], [], [], [], 0

        def read():
            nonlocal texts, chars
            (ids,), (size,), _ = cache.encode(texts)
            flat.append(np.insert(ids, np.cumsum(size), np.uint32(end_id)))
            sizes.append(size + 1)
            texts, chars = [], 0

        def bundle(kind):
            nonlocal inside, keys, sizes, flat
            size, ids = np.concatenate(sizes), np.concatenate(flat)
            row = [[part], [inside], [len(ids)], [keys], [squeeze_planes(size)], [squeeze_planes(ids)]]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(kind), pa.binary(), pa.binary()]
            inside, keys, sizes, flat = inside + len(ids), [], [], []
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types, strict=True)], names
            )

        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            for i, text in rows_of(batch):
                keys.append(i)
                texts.append(text or "")
                chars += len(texts[-1])
                if chars >= READ_CHARS or len(texts) >= 1 << 14:
                    read()
                    if sum(map(len, flat)) >= BUNDLE_IDS:
                        yield bundle(kind)
        if texts:
            read()
        if keys:
            yield bundle(kind)

    fields = f"part long, inside long, n long, docs array<{id_type}>, sizes binary, ids binary"
    return store(source.mapInArrow(encoded, fields), "packing")


def pack(
    docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per sequence: ``sequence_id``, ``n`` (ids), ``ids`` (binary, little-endian u32) and
    ``pieces``, an array of ``doc, start, length, doc_tokens, offset`` in the order of the sequence."""
    bundles = encode_bundles(docs, tokenizer_path, id_col, text_col, end_id)
    totals = bundles.groupBy("part").agg(F.sum("n").alias("total"))
    # One short row per task of the first pass; stored, so that its size is known when it is joined.
    bases = store(prefix_sums(totals, "part", "total", "base"), "bases")
    placed = bundles.join(bases.select("part", "base"), "part").select(
        (F.col("base") + F.col("inside")).alias("base"), "docs", "sizes", "ids"
    )
    id_type = bundles.schema["docs"].dataType.elementType.simpleString()
    piece = f"struct<doc: {id_type}, start: long, length: long, doc_tokens: long, offset: long>"

    def cutter(whole: bool):
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    rows = cut_bundle(
                        batch.column(0)[k].as_py(), batch.column(1)[k].values,
                        expand_planes(batch.column(2)[k].as_py()).astype(np.int64),
                        expand_planes(batch.column(3)[k].as_py()), length,
                    )
                    full = np.equal(rows.column("n"), length)
                    yield rows.filter(pa.array(full if whole else ~full))

        return cut

    fields = f"sequence_id long, at long, n long, ids binary, pieces array<{piece}>"
    # A window that a bundle holds whole is done.  The bundles are read once more for the few others,
    # so that only these boundary records are shuffled.
    whole = placed.mapInArrow(cutter(True), fields).select("sequence_id", "n", "ids", "pieces")
    joined = (
        placed.mapInArrow(cutter(False), fields)
        .groupBy("sequence_id")
        .agg(
            F.sum("n").alias("n"),
            F.array_sort(F.collect_list(F.struct("at", "ids", "pieces"))).alias("parts"),
        )
        .select(
            "sequence_id", "n",
            F.aggregate(
                "parts", F.lit(bytearray()), lambda line, one: F.concat(line, one["ids"])
            ).alias("ids"),
            F.flatten(F.transform("parts", lambda one: one["pieces"])).alias("pieces"),
        )
    )
    return whole.unionByName(joined)


def cut_bundle(
    base: int, keys: pa.Array, sizes: np.ndarray, ids: np.ndarray, length: int
) -> pa.RecordBatch:
    """Rows ``sequence_id, at, n, ids, pieces`` of the documents that begin at place ``base`` of the line."""
    total = len(ids)
    doc_start = np.cumsum(sizes) - sizes
    cuts = np.arange(-(-base // length) * length - base, total, length)
    cuts = cuts[cuts > 0]
    starts = np.union1d(doc_start, cuts)  # of the pieces
    ends = np.r_[starts[1:], total]
    doc = np.searchsorted(doc_start, starts, side="right") - 1
    windows = np.r_[0, cuts]
    sequence = (base + windows) // length
    first = np.searchsorted(starts, windows)
    pieces = pa.StructArray.from_arrays(
        [
            keys.take(pa.array(doc)), pa.array(starts - doc_start[doc]), pa.array(ends - starts),
            pa.array(sizes[doc]), pa.array((base + starts) % length),
        ],
        ["doc", "start", "length", "doc_tokens", "offset"],
    )
    raw = np.ascontiguousarray(ids.astype("<u4"))
    offsets = pa.array(np.r_[windows, total].astype(np.int32) * 4)
    binary = pa.Array.from_buffers(
        pa.binary(), len(windows), [None, offsets.buffers()[1], pa.py_buffer(raw)]
    )
    lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(starts)].astype(np.int32)), pieces)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(sequence), pa.array((base + windows) % length),
            pa.array(np.diff(np.r_[windows, total])), binary, lists,
        ],
        ["sequence_id", "at", "n", "ids", "pieces"],
    )
