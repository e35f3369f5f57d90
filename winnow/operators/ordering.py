"""Order-dependent operators that stay exact under any partitioning.

Row order is data here: every relation carries an ``ord`` column.  "First" always means
smallest ``ord``, found by an aggregate with map-side combine, so a key that holds a third
of all rows leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.staging import stored

# A numbering block spans 2**BLOCK_BITS values of ``ord``: the most rows one window group holds.
BLOCK_BITS = 16


def keep_first(df: DataFrame, keys: Sequence[str], ord_col: str = "ord") -> DataFrame:
    """First row per key, for narrow rows: they travel inside the aggregate."""
    rest = [name for name in df.columns if name not in keys]
    first = F.min_by(F.struct(*rest), F.col(ord_col)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def keep_first_wide(df: DataFrame, key: Column, ord_col: str = "ord") -> DataFrame:
    """First row per key, for wide rows: only ``(key, ord)`` is aggregated.

    The payload is fetched by a semi join on the winning ``ord`` values.
    """
    winners = (
        df.select(key.alias("_key"), F.col(ord_col))
        .groupBy("_key")
        .agg(F.min(ord_col).alias(ord_col))
        .select(ord_col)
    )
    return df.join(winners, ord_col, "left_semi")


def ordered_distinct(df: DataFrame, item: str, ord_col: str = "ord") -> DataFrame:
    """Distinct items with the place of their first occurrence."""
    return df.groupBy(item).agg(F.min(ord_col).alias(ord_col))


def _block(ord_col: str, bits: int) -> Column:
    return F.shiftright(F.col(ord_col).cast("bigint"), bits)


def _block_starts(rows: DataFrame, keys: Sequence[str], ord_col: str, amount: Column, bits: int) -> DataFrame:
    """Per key and block of ``ord`` values the sum over the key's earlier blocks, as ``_start``.

    Totals are added up in levels of ``BLOCK_BITS`` bits each: a block is shifted by the earlier ones
    under the same parent, a parent by the parents before it.  As a bigint has 64 bits, no window
    sees more than ``2**BLOCK_BITS`` rows, the last one included, however sparse ``ord`` is.
    """
    totals = rows.groupBy(*keys, _block(ord_col, bits).alias("_block")).agg(F.sum(amount).alias("_sum"))
    return _scanned(totals, keys, 64 - bits)


def _scanned(totals: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    if width <= BLOCK_BITS:
        group = [*keys] or [F.lit(0)]
        return totals.select(*keys, "_block", _before("_sum", Window.partitionBy(*group).orderBy("_block")).alias("_start"))
    raised = totals.withColumn("_parent", F.shiftright("_block", BLOCK_BITS))
    parents = raised.groupBy(*keys, F.col("_parent").alias("_block")).agg(F.sum("_sum").alias("_sum"))
    upper = _scanned(parents, keys, width - BLOCK_BITS).withColumnsRenamed({"_block": "_parent", "_start": "_upper"})
    inside = _before("_sum", Window.partitionBy(*keys, "_parent").orderBy("_block"))
    return (
        raised.withColumn("_inside", inside)
        .join(upper, [*keys, "_parent"])
        .select(*keys, "_block", (F.col("_upper") + F.col("_inside")).alias("_start"))
    )


def _before(amount: str, window) -> Column:
    earlier = F.sum(amount).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(earlier, F.lit(0))


def running_total(
    df: DataFrame, ord_col: str, amount: str, out: str, block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Sum of ``amount`` over all rows with a smaller ``ord`` (a unique whole number)."""
    blocked = df.withColumn("_block", _block(ord_col, block_bits))
    starts = _block_starts(df, [], ord_col, F.col(amount), block_bits)
    inside = _before(amount, Window.partitionBy("_block").orderBy(ord_col))
    return (
        blocked.withColumn("_inside", inside)
        .join(starts, "_block")
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .select(*df.columns, out)
    )


def number_in_group(
    df: DataFrame,
    keys: Sequence[str],
    ord_col: str,
    out: str,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """0-based number of each row within its key, exact for keys of any size.

    A key is cut into blocks of ``ord`` values.  Rows are numbered inside their block and
    shifted by the rows of the key's earlier blocks, so no task holds a whole hot key.
    """
    blocked = df.withColumn("_block", _block(ord_col, block_bits))
    starts = _block_starts(df, keys, ord_col, F.lit(1), block_bits)
    inside = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(ord_col)) - 1
    return (
        blocked.withColumn("_inside", inside)
        .join(starts, [*keys, "_block"])
        .withColumn(out, (F.col("_start") + F.col("_inside")).cast("bigint"))
        .select(*df.columns, out)
    )


def numbered(df: DataFrame, key: str, out: str) -> DataFrame:
    """``df`` with the 0-based place of each row in the order of ``key``, of any type that has an order.

    Rows are range-partitioned, sorted and stored with their task and place in it; tasks are shifted by a
    scan over one row per task.  Equal keys get consecutive numbers.  Give narrow rows.
    """
    placed = stored(df.orderBy(key).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    # The upper bits of a monotonic id name the task, the lower 33 the row in it.
    marked = placed.withColumns({"_task": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = marked.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_task", _before("_n", Window.orderBy("_task")).alias("_start"))
    return marked.join(starts, "_task").select(*df.columns, (F.col("_start") + F.col("_row")).alias(out))
