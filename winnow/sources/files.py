"""Readers of post pages, URL lists, label records and stored corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.operators.ordering import ordered_distinct
from winnow.schemas import LABEL, LISTING_PAGE

ERRORS = ("null", "raise", "quarantine")


def read_listing_pages(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, errors: str = "null"
) -> DataFrame:
    """Nested post pages of JSON arrays or JSON lines, with ``page_idx`` in file order.

    A record that is no post page, or one only in part, becomes NULL fields (``null``), stops the job
    (``raise``), or stands with its text in a further column ``_error`` (``quarantine``).  A multi-line
    file is one record or one array, so its damage is that of the whole file.
    """
    if errors not in ERRORS:
        raise ValueError(f"unknown errors: {errors}")
    schema, options = LISTING_PAGE, {"mode": "FAILFAST" if errors == "raise" else "PERMISSIVE"}
    if errors == "quarantine":
        schema = T.StructType([*LISTING_PAGE, T.StructField("_error", T.StringType())])
        options["columnNameOfCorruptRecord"] = "_error"
    pages = spark.read.options(**options).schema(schema).json(path, multiLine=multi_line)
    return with_row_number(pages, "page_idx")


def read_url_list(
    spark: SparkSession, path: str | list[str], drop_duplicates: bool = False
) -> DataFrame:
    """Lines of URL lists with their place ``ord``; repeated lines keep the first place."""
    lines = with_row_number(spark.read.text(path), "ord").withColumnRenamed("value", "url")
    return ordered_distinct(lines, "url") if drop_duplicates else lines


def read_labels(spark: SparkSession, path: str | list[str], ord_col: str | None = None) -> DataFrame:
    """Label records; ``ord_col`` names a column for their place in the files."""
    labels = spark.read.schema(LABEL).json(path)
    if ord_col is None:
        return labels.select("data.*")
    return with_row_number(labels, ord_col).select(ord_col, "data.*")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_row_number(rows: DataFrame, name: str) -> DataFrame:
    """Dense row number by file name and place in the file.

    A scan split is one ordered run of rows; splits are numbered by one row each.
    """
    columns = rows.columns
    marked = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seen"),
    )
    split = ["_file", "_block"]
    earlier = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        marked.groupBy(*split)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*split, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy(*split).orderBy("_seen")) - 1
    return (
        marked.withColumn("_inside", inside)
        .join(starts, split)
        .select((F.col("_start") + F.col("_inside")).alias(name), *columns)
    )
