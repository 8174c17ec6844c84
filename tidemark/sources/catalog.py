"""Views over a folder of tables, and what the session knows about them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import file_system
from tidemark.sources.tables import table


def register_views(spark: SparkSession, folder: str) -> list[str]:
    """A temporary view for every ``<name>.parquet`` of a folder, so that plain SQL can be run over it."""
    fs, path = file_system(spark, folder)
    names = sorted(os.path.basename(s.getPath().toString().rstrip("/"))[:-8] for s in fs.listStatus(path) if s.getPath().getName().endswith(".parquet"))
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)
    return names


def tables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()], "table_name string, table_type string, temporary boolean")


def columns(spark: SparkSession, *names: str) -> DataFrame:
    """``(table_name, position, column_name, data_type)`` of tables and views."""
    rows = [(n, i, f.name, f.dataType.simpleString()) for n in names for i, f in enumerate(spark.table(n).schema)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")


def check_contract(rows: DataFrame, declared: str) -> None:
    """Names and types must be exactly those declared, e.g. ``"order_id string, amount double"``."""
    empty = rows.sparkSession.createDataFrame([], declared)
    want, have = [(f.name, f.dataType) for f in empty.schema], [(f.name, f.dataType) for f in rows.schema]
    if want != have:
        raise TypeError(f"columns {[f'{n} {t.simpleString()}' for n, t in have]} are not {declared}")
