"""Queries of the text operators over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import keyword_pages, mixing, packing, tokens
from tidemark.session import work_dir
from tidemark.sources.tables import table


def _sizes(spark: SparkSession, sf: str, path: str, *keep: str) -> DataFrame:
    """Token counts of whole texts, stored: tokenizing is the costly step and is done once."""
    tokens.with_tokens(table(spark, sf, "documents"), "doc_id", *keep).write.parquet(path)
    return spark.read.parquet(path)


def p8_pack(spark: SparkSession, sf: str) -> DataFrame:
    path, kinds = work_dir(spark, "p8"), table(spark, sf, "container_sizes")
    sizes = _sizes(spark, sf, f"{path}/sizes")
    return packing.with_empty(packing.pack(spark, sizes, kinds, f"{path}/rounds"), sizes, kinds)


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill(p8_pack(spark, sf), table(spark, sf, "container_sizes"))


def _by_source(spark: SparkSession, sf: str) -> DataFrame:
    return _sizes(spark, sf, f"{work_dir(spark, 'p9')}/sizes", "source").withColumn("sources", F.array("source"))


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_by_source(spark, sf), table(spark, sf, "mix_targets"))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    sizes, targets = _by_source(spark, sf), table(spark, sf, "mix_targets")
    return mixing.shares_reached(mixing.mix(sizes, targets), targets, mixing.wanted_tokens(sizes, targets))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return keyword_pages.keyword_pages(table(spark, sf, "documents")).select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p8_pack, p8_fill, p9_mix, p9_shares, p10_found)}
