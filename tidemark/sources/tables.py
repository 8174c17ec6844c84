"""Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(folder, name))


def stream_path(path: str) -> str:
    """The path as a pattern that matches only itself: a file stream takes a single file only by a pattern."""
    return path[:-1] + f"[{path[-1]}]"
