"""Intermediate tables under the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import ensure_checkpoint_dir


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: what follows starts from files that survive lost
    executors. The folder goes with the application."""
    return written_at(df, what)[0]


def written_at(df: DataFrame, what: str, **options: str) -> tuple[DataFrame, str]:
    """``written`` with options of the Parquet writer, and the folder, for callers that remove it sooner."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    folder, files = _folder(spark, path)
    files.deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())
