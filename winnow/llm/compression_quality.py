"""Quality classifier: zstandard dictionaries of good and bad text, calibrated size difference.

Fit: labels of the learning rows are ordered by a hash of their id, and the first
``sample_rows`` rows per class (a documented bound) are looked up in the documents.  Windows of
``window`` bytes of one half of them train one dictionary per class; the size differences of the
other half calibrate a logistic curve.  Only the bounded sample, the two dictionaries and the
two coefficients ever reach the driver.

Score: the whole text is cut into windows; each is compressed on its own with either dictionary,
so a long text cannot drown the dictionary with its own repeats.  The difference of the summed
sizes per byte of text goes through the curve.  NULL and empty texts have difference 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import fit_logistic, map_texts, sigmoid


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    window: int = 512
    level: int = 3

    def differ(self):
        """A function from a text to the size difference per byte; one per task."""
        compress = []
        for raw in (self.good, self.bad):
            held = zstandard.ZstdCompressionDict(raw)
            held.precompute_compress(level=self.level)
            compress.append(
                zstandard.ZstdCompressor(
                    level=self.level, dict_data=held, write_content_size=False, write_dict_id=False
                ).compress
            )
        good, bad, size = *compress, self.window

        def differ(text: str | None) -> float:
            raw = (text or "").encode()
            total = 0
            for at in range(0, len(raw), size):
                piece = raw[at : at + size]
                total += len(bad(piece)) - len(good(piece))
            return total / (len(raw) + 1)

        return differ

    def calibrated(self, differences: np.ndarray) -> np.ndarray:
        return sigmoid(np.asarray(differences) * self.weights[0] + self.weights[1])


def _sample(labels: DataFrame, keys: list[str], quality: int, rows: int, half: Column) -> DataFrame:
    picked = labels.filter((F.col("_quality") == quality) & half)
    return picked.orderBy(F.xxhash64("_id"), *keys).limit(rows // 2)


def _windows(batches: Iterator[pa.RecordBatch], size: int, most: int) -> Iterator[pa.RecordBatch]:
    """Up to ``most`` windows of each sampled text, spread evenly over the whole of it."""
    for batch in batches:
        kinds, pieces = [], []
        for kind, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
            raw = (text or "").encode()
            count = -(-len(raw) // size)
            for k in sorted({i * count // most for i in range(most)} if count > most else range(count)):
                kinds.append(kind)
                pieces.append(raw[k * size : (k + 1) * size])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array(pieces, pa.binary())], ["quality", "piece"]
        )


def _dictionary(pieces: list[bytes], size: int) -> bytes:
    """A trained dictionary; with too little text to train on, the text itself."""
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:] or b"no text"


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column,
    id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality",
    sample_rows: int = 4000, windows_per_text: int = 4, window: int = 512, level: int = 3,
    dictionary_bytes: int = 32768,
) -> Model:
    """Train on the rows of ``labels`` that satisfy ``learn``, a condition on the id column.

    Without labelled rows of both classes every text scores 0.5 or the share of the one class.
    Where ids repeat, the least text of an id stands for it.  The model depends on the sampled
    texts, not on the order of rows.
    """
    known = labels.filter(learn & F.col(quality_col).isin(0, 1)).select(
        F.col(id_col).alias("_id"), F.col(quality_col).cast("int").alias("_quality")
    )
    # xxhash64 with a second argument is another hash than the one that orders the rows.
    first = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(2)) == 0

    def texts(half: Column) -> DataFrame:
        sample = _sample(known, ["_id"], 1, sample_rows, half).unionAll(
            _sample(known, ["_id"], 0, sample_rows, half)
        )
        found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
            F.broadcast(sample.distinct()), "_id"  # at most ``sample_rows`` rows of an id and a label
        )
        # Combined before the shuffle: at most one text for each sampled row goes on.
        return found.groupBy("_id", "_quality").agg(F.min("_text").alias("_text"))

    pieces = (
        texts(first).select("_quality", "_text")
        .mapInArrow(lambda it: _windows(it, window, windows_per_text), "quality int, piece binary")
        .toPandas()
    )
    parts = [
        _dictionary(sorted(bytes(p) for p in pieces.piece[pieces.quality == kind]), dictionary_bytes)
        for kind in (1, 0)
    ]
    model = Model(*parts, weights=(1.0, 0.0), window=window, level=level)

    def setup():
        differ = model.differ()
        return lambda batch: [[differ(text) for text in batch]]

    held = map_texts(texts(~first), setup, "difference double", ["_quality"], "_text").toPandas()
    held = held.sort_values(["_quality", "difference"])
    y = held["_quality"].to_numpy(float)
    if len(set(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(*parts, (0.0, float(np.log(share / (1 - share)))), window, level)
    weights = fit_logistic(held["difference"].to_numpy()[:, None] * 100, y)
    return Model(*parts, (float(weights[0] * 100), float(weights[1])), window, level)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.7
) -> DataFrame:
    """One row per row of ``docs``: its id, ``difference``, ``score`` and ``predicted``."""

    def setup():
        differ = model.differ()

        def work(texts):
            differences = np.array([differ(text) for text in texts], np.float64)
            return differences, model.calibrated(differences)

        return work

    scored = map_texts(docs, setup, "difference double, score double", [id_col], text_col)
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))
