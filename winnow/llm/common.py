"""Shared pieces of the operators: Arrow maps over texts, folds, stored tables, small numpy tools.

Conventions of all operators here: a NULL text counts as empty unless the operator says
otherwise; rows are never merged, so a repeated id gives repeated result rows; columns other
than the named id and text columns are never read, so extra or clashing names do no harm;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The six bytes between words: blank and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def fold_of(value: object, folds: int) -> int:
    """The same fold for one value, for tests."""
    return zlib.crc32(("" if value is None else str(value)).encode()) % folds


# For the time of one write: its shuffle files go once the table is there, and batches to and from
# Python stay small whatever the length of the texts.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


_lists: list[list[str]] = []


@contextmanager
def written() -> Iterator[list[str]]:
    """The paths of all tables that ``write`` makes meanwhile."""
    _lists.append([])
    try:
        yield _lists[-1]
    finally:
        _lists.pop()


def write(df: DataFrame, name: str, by: str | None = None) -> str:
    """Write ``df`` to the shared folder named by ``spark.checkpoint.dir``; returns the path."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{folder.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    for paths in _lists:
        paths.append(path)
    before = {key: spark.conf.get(key, None) for key in _WRITING}
    for key, value in _WRITING.items():
        spark.conf.set(key, value)
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back.

    The table survives lost executors, and whatever follows does not compute ``df`` again.
    """
    path = write(df, name)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that nothing will read again."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def prefix_sums(rows: DataFrame, key: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """``rows``, one per whole number ``key``, with ``out``: the sum of ``value`` over smaller keys.

    Sums run inside blocks of keys; only the block totals, one row per ``block`` keys, are ordered as a
    whole.
    """
    blocked = rows.withColumn("_block", F.floor(F.col(key) / block))
    earlier = (Window.unboundedPreceding, -1)
    shifts = blocked.groupBy("_block").agg(F.sum(value).alias("_total")).select(
        F.col("_block").alias("_b"),
        F.coalesce(F.sum("_total").over(Window.orderBy("_block").rowsBetween(*earlier)), F.lit(0)).alias("_shift"),
    )
    inside = F.sum(value).over(Window.partitionBy("_block").orderBy(key).rowsBetween(*earlier))
    return (
        blocked.withColumn(out, F.coalesce(inside, F.lit(0)))
        .join(shifts, F.col("_block") == F.col("_b"))
        .withColumn(out, F.col(out) + F.col("_shift"))
        .drop("_block", "_b", "_shift")
    )


def slices_of(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Views of a batch, so that only part of its texts are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch as Python values."""
    for part in slices_of(batch):
        yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def unused(name: str, columns: Sequence[str]) -> str:
    """``name``, lengthened until no column is called so (Spark ignores case)."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_texts(
    df: DataFrame,
    setup: Callable[[], Callable[[list], Sequence]],
    fields: str,
    keep: Sequence[str],
    text: str,
) -> DataFrame:
    """Columns ``keep`` unchanged, plus ``fields`` computed from whole texts, batch by batch.

    ``setup`` runs once per task and returns the function from a list of texts (``str`` or
    ``None``) to one list or array per field.
    """
    spark = df.sparkSession
    read = unused("_text", keep)
    source = df.select(*keep, F.col(text).cast("string").alias(read))
    made = spark.createDataFrame([], fields).schema
    schema = source.drop(read).schema
    for field in made:
        schema = schema.add(field)
    names = [field.name for field in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        pa.default_memory_pool().release_unused()  # of earlier tasks in this worker
        types = [to_arrow_type(field.dataType) for field in made]
        work = setup()
        for whole in batches:
            for batch in slices_of(whole):
                columns = work(batch.column(batch.num_columns - 1).to_pylist())
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(batch.num_columns - 1)), *arrays], names
                )

    return source.mapInArrow(run, schema)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads the bits of each value (published splitmix constants)."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Start of every run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Coefficients of a small logistic regression by Newton steps (last one: the constant)."""
    design = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(design.shape[1])
    for _ in range(steps):
        p = sigmoid(design @ w)
        gradient = design.T @ (y - p) - ridge * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for positive arguments (Stirling's series)."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    z = x.copy()
    for _ in range(7):
        small = z < 7.0
        if not small.any():
            break
        shift[small] += np.log(z[small])
        z[small] += 1.0
    inv = 1.0 / z
    series = inv * (1 / 12 - inv * inv * (1 / 360 - inv * inv * (1 / 1260)))
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - shift
