"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

* Features: hashed two- and three-letter sequences (anything but letters reads as one blank), weighted by
  share in the text times inverse document frequency.  Document frequencies are counted over
  all learning rows; the table has ``BUCKETS`` entries at any size of the input.
* Training: follow the regularised leader with L1 and L2 penalties, over a bounded sample
  (``sample_rows`` texts per language, by hash of the id).  Most weights end as exact zeros.
* Calibration: one temperature, fitted on a fifth of the sample that training did not see.
* Scoring: whole texts in numpy slices; a text without a letter, or NULL, is ``und`` with score 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.common import map_texts, runs

BUCKETS = 1 << 16
SCALE = 30.0  # texts sum to about this weight, whatever their length
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]+")  # with numerals such as U+00BD, which are no letters
_SLICE = 1 << 18  # n-grams of a kind handled at once


def has_letter(text: str | None) -> bool:
    return any(any(map(str.isalpha, found[0])) for found in _LETTER.finditer(text or ""))


@cache
def _letters() -> np.ndarray:
    """For every code point: itself if a letter, else a blank."""
    points = np.arange(0x110000, dtype=np.uint32)
    keep = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(keep, points, 32).astype(np.uint32)


def letters(text: str, table: np.ndarray) -> np.ndarray:
    """Letters of a text as code points, with one blank for all between them and at both ends."""
    x = table[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)]
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    return x[keep]


def grams(x: np.ndarray, most: int | None = None) -> np.ndarray:
    """Hashed n-grams that begin at the first ``most`` places, repeats included."""
    two = x[:-1] * np.uint32(0x9E3779B1) + x[1:] * np.uint32(0x85EBCA77)
    three = (two[:-1] ^ (two[:-1] >> np.uint32(15))) * np.uint32(0xC2B2AE3D) + x[2:] * np.uint32(0x27D4EB2F)
    shift = np.uint32(16)
    return np.concatenate([two[:most] >> shift, three[:most] >> shift]).astype(np.int64)


def buckets(text: str, table: np.ndarray) -> np.ndarray:
    return grams(letters(text, table))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # BUCKETS x languages, inverse document frequency folded in
    bias: np.ndarray
    temperature: float

    def predictor(self):
        table = _letters()
        weights = self.weights.astype(np.float32)

        def logits(text: str) -> np.ndarray:
            total, count = np.zeros(weights.shape[1]), 0
            x = letters(text, table)
            for at in range(0, len(x) - 1, _SLICE):  # n-grams of long texts in turn
                found = grams(x[at : at + _SLICE + 2], _SLICE)
                total += weights[found].sum(axis=0, dtype=np.float64)
                count += len(found)
            return total * (SCALE / max(1, count)) + self.bias

        def predict(text: str | None) -> tuple[str, float]:
            if not text or not self.languages or not has_letter(text):
                return UNDETERMINED, 0.0
            z = logits(text) / self.temperature
            p = np.exp(z - z.max())
            best = int(p.argmax())
            return self.languages[best], float(p[best] / p.sum())

        return predict


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """Number of texts, and for each bucket the number of texts that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen, rows = _letters(), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rows += 1
                mark = np.zeros(BUCKETS, bool)
                x = letters(text or "", table)
                for at in range(0, len(x) - 1, _SLICE):
                    mark[grams(x[at : at + _SLICE + 2], _SLICE)] = True
                seen += mark
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[some, -1]), pa.array(np.r_[seen[some], rows])], ["bucket", "n"]
        )

    # Each task sends at most BUCKETS + 1 rows, and so does the sum over tasks.
    counted = docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(
        count, "bucket long, n long"
    )
    frame = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    values, total = np.zeros(BUCKETS, np.int64), 0
    for bucket, n in zip(frame.bucket, frame.n, strict=True):
        if bucket < 0:
            total = int(n)
        else:
            values[bucket] = n
    return total, values


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]], languages: int, epochs: int = 3,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.001,
) -> tuple[np.ndarray, np.ndarray]:
    """Follow the regularised leader over sparse rows ``(buckets, values, class)``."""
    z = np.zeros((BUCKETS + 1, languages))  # the last row is the bias
    n = np.zeros_like(z)

    def weights(at):
        zs, ns = z[at], n[at]
        shrunk = np.sign(zs) * l1 - zs
        return np.where(np.abs(zs) <= l1, 0.0, shrunk / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for found, values, kind in rows:
            at = np.r_[found, BUCKETS]
            x = np.r_[values, 1.0]
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[kind] -= 1.0
            g = x[:, None] * p[None, :]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, kinds: np.ndarray) -> float:
    """The temperature of least log loss, from a fine geometric grid."""
    if not len(kinds):
        return 1.0
    best, least = 1.0, np.inf
    for t in np.geomspace(0.2, 5.0, 81):
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        loss = (np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(kinds)), kinds]).mean()
        if loss < least:
            best, least = float(t), loss
    return best


def fit(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", sample_rows: int = 1000,
) -> Model:
    """Train on rows with a language and a text that satisfy ``learn`` (a condition on the id).

    Where ids repeat, the least text of an id and language stands for it.
    """
    rows = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    total, df = document_frequencies(rows, text_col)
    idf = np.log((1.0 + total) / (1.0 + df)) + 0.1

    # The ids of smallest hash.  A threshold from the counts lets about twice as many rows of a language
    # reach its window, however many it has.  The table of thresholds has a row per language, as many as the
    # model has columns of BUCKETS weights; sent to the keys, it drops rows before they move.
    keys = rows.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang")).withColumn("_hash", F.xxhash64("_id"))
    limits = keys.groupBy("_lang").agg((F.lit(2.0**65 * sample_rows) / F.count(F.lit(1)) - 2.0**63).alias("_limit"))
    place = Window.partitionBy("_lang").orderBy("_hash", "_id")
    picked = (
        keys.join(F.broadcast(limits), "_lang").filter(F.col("_hash") <= F.col("_limit"))
        .withColumn("_place", F.row_number().over(place))
        .filter(F.col("_place") <= sample_rows)  # pushed before the shuffle as a group limit
        .select("_id", "_lang")
        .distinct()
    )
    sample = rows.select(
        F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text")
    ).join(F.broadcast(picked), ["_id", "_lang"])  # bounded: sample_rows per language
    sample = sample.groupBy("_id", "_lang").agg(F.min("_text").alias("_text"))  # combined before the shuffle

    def setup():
        table = _letters()

        def work(texts):
            found, counts = [], []
            for text in texts:
                a = np.sort(buckets(text, table))
                starts = runs(a)
                found.append(a[starts])
                counts.append(np.diff(np.r_[starts, len(a)]))
            return found, counts

        return work

    frame = map_texts(
        sample, setup, "found array<int>, counts array<int>", ["_id", "_lang"], "_text"
    ).toPandas()
    languages = tuple(sorted(set(frame["_lang"])))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    kind_of = {lang: k for k, lang in enumerate(languages)}
    frame = frame.sort_values("_id", kind="stable")
    prepared = []
    for lang, found, counts in zip(frame["_lang"], frame["found"], frame["counts"], strict=True):
        found, counts = np.asarray(found, np.int64), np.asarray(counts, np.float64)
        prepared.append((found, counts / max(1.0, counts.sum()) * SCALE * idf[found], kind_of[lang]))
    order = np.random.default_rng(7).permutation(len(prepared))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    weights, bias = train([prepared[i] for i in used], len(languages))
    logits = np.array([prepared[i][1] @ weights[prepared[i][0]] + bias for i in held])
    kinds = np.array([prepared[i][2] for i in held], np.int64)
    return Model(languages, weights * idf[:, None], bias, fit_temperature(logits, kinds))


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
    keep: Sequence[str] | None = None, out: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """One row per row of ``docs``: its id (or the columns ``keep``), language and calibrated score.

    ``out`` names the two new columns.
    """

    def setup():
        predict = model.predictor()

        def work(texts):
            found = [predict(text) for text in texts]
            return [f[0] for f in found], [f[1] for f in found]

        return work

    fields = f"`{out[0]}` string, `{out[1]}` double"
    return map_texts(docs, setup, fields, keep or [id_col], text_col)
