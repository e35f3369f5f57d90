"""Intermediate tables on the shared folder of the cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors must share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/winnow/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet on the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> None:
    """Delete the stage tables of this process, once its results are written."""
    while _made:
        place = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
