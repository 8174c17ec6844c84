"""Queries of the data-processing operators over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import compaction, counters, dedup, drift, lsm, orphans, profile
from tidemark.session import work_dir
from tidemark.sources import files as control
from tidemark.sources.tables import table, table_path

REFERENCE_TABLES = ("stg_orders", "stg_order_items", "stg_customers", "removed_keys")


def _references(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [table(spark, sf, t) for t in REFERENCE_TABLES]


#: Batches in which p2 and p6 take their table; p2 compacts at 8 runs, so a run comes after the compaction.
P2_BATCHES, P6_BATCHES = 9, 4


def sliced(spark: SparkSession, source: str, path: str, by: str, batches: int, columns: tuple[str, ...] = ()) -> tuple[str, int]:
    """A copy of a table (of ``columns``, all by default) in files by ranges of ``by``, and how many of them make one of ``batches``: a file stream cannot divide a single file."""
    each = spark.sparkContext.defaultParallelism
    rows = spark.read.parquet(source)
    rows.select(*(columns or rows.columns)).repartitionByRange(batches * each, by).write.parquet(path)
    return path, each


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return orphans.find_orphans(*_references(spark, sf))


def p1_counts(spark: SparkSession, sf: str) -> DataFrame:
    return orphans.orphan_counts(*_references(spark, sf))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return p2_state(spark, sf).select("order_id", "business_version", "kafka_offset")


def p2_state(spark: SparkSession, sf: str) -> DataFrame:
    work = work_dir(spark, "p2")
    source, each = sliced(spark, table_path(sf, "order_changes"), f"{work}/feed", "kafka_offset", P2_BATCHES)
    applied = lsm.apply_feed(spark, source, work, max_files=each)
    control.delete(spark, source)
    return applied.read()


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return drift.find_changes(spark, table(spark, sf, "landing_files"), work_dir(spark, "p3"))


def _own_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of producers. Those without one were made from other files: their records are in these."""
    return table(spark, sf, "landing_files").filter("producer IS NOT NULL")


def p3_rows(spark: SparkSession, sf: str) -> DataFrame:
    return drift.ingest(spark, _own_files(spark, sf), work_dir(spark, "p3"))


#: Fields without a target column that are approved for columns of their own.
P3_APPROVED = {"currency": "string", "channel": "string", "coupon_code": "string", "warehouse_hint": "string", "is_gift": "boolean", "priority": "int"}


def p3_promoted(spark: SparkSession, sf: str) -> DataFrame:
    """Records with an approved field, replayed from ``rescued`` into its column."""
    rows = drift.promote(drift.ingest_files(_own_files(spark, sf)), P3_APPROVED).select("file_id", "line_no", *P3_APPROVED)
    return rows.filter(F.coalesce(*[F.col(c).cast("string") for c in P3_APPROVED]).isNotNull())


def p3_unreadable(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that are no complete JSON object, as rescued."""
    rows = drift.ingest_files(_own_files(spark, sf), unreadable=True).select("file_id", "line_no", F.get_json_object("rescued", "$._unreadable").alias("line"))
    return rows.filter("line IS NOT NULL")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _consolidated(spark, sf).select("file_id").distinct()


def _consolidated(spark: SparkSession, sf: str) -> DataFrame:
    return compaction.compact_stream(spark, table_path(sf, "landing_files"), table(spark, sf, "file_log"), work_dir(spark, "p4"))


def p4_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every record of the consolidated files, once."""
    return _consolidated(spark, sf).filter("record IS NOT NULL").select("event_date", "file_id", "line_no", "record")


def p4_log_balance(spark: SparkSession, sf: str) -> DataFrame:
    return compaction.log_balance(table(spark, sf, "file_log"), table(spark, sf, "lakehouse_metrics"))


def _payment_patterns(baseline: DataFrame) -> dict[str, str]:
    """Value patterns by column; the baseline is a fixed small table."""
    rows = baseline.filter("table_name = 'stg_order_payments' AND metric = 'pattern_share'").select("column_name", "value_pattern").collect()
    return {r.column_name: r.value_pattern for r in rows if r.value_pattern is not None}


def _payment_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    """Unpivoted and counted once, stored: profile, quantiles and drift all read these counts."""
    path = work_dir(spark, "p5")
    profile.frequencies(table(spark, sf, "stg_order_payments"), "ingest_date").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    baseline = table(spark, sf, "load_baseline")
    outside = profile.outside_baseline(profile.profile(_payment_frequencies(spark, sf), _payment_patterns(baseline)), "stg_order_payments", baseline)
    return outside.unionByName(profile.wrong_counts(table(spark, sf, "pipeline_runs"), table(spark, sf, "stg_order_items")))


def p5_profile(spark: SparkSession, sf: str) -> DataFrame:
    shown = profile.profile(_payment_frequencies(spark, sf), _payment_patterns(table(spark, sf, "load_baseline")))
    shares = ("null_share", "blank_share", "top_share", "pattern_share")
    return shown.select("load_day", "column_name", "rows", *[F.round(c, 9).alias(c) for c in shares], "distinct_count", "min_value", "max_value", "median_value")


def p5_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The three columns of few values, value by value; ``p5_drift_all`` has every column."""
    columns = ["payment_type", "payment_installments", "payment_sequential"]
    return profile.load_drift(profile.frequencies(table(spark, sf, "stg_order_payments"), "ingest_date", columns))


def p5_drift_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every column: few values one by one, many numbers by bins of the earlier load, many texts by their form."""
    freq = _payment_frequencies(spark, sf)
    return profile.load_drift(freq, measures=profile.rulers(freq))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.kept_copies(_seen(spark, sf).messages(), repeated_only=True)


def _seen(spark: SparkSession, sf: str) -> dedup.SeenStore:
    work = work_dir(spark, "p6")
    source, each = sliced(spark, table_path(sf, "bronze_orders"), f"{work}/arrivals", "kafka_timestamp", P6_BATCHES, (*dedup.KEY, "kafka_timestamp", "kafka_partition", "kafka_offset"))
    seen = dedup.dedup_stream(spark, source, work, max_files=each)
    control.delete(spark, source)
    return seen


def p6_rows(spark: SparkSession, sf: str) -> DataFrame:
    """bronze_orders with one row per message."""
    return dedup.one_copy(table(spark, sf, "bronze_orders"), _seen(spark, sf).messages())


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return counters.late_rows(spark, table(spark, sf, "streaming_orders"), work_dir(spark, "p7"))


def p7_totals(spark: SparkSession, sf: str) -> DataFrame:
    return counters.daily_totals(spark, table(spark, sf, "streaming_orders"), work_dir(spark, "p7"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_counts, p2_found, p2_state, p3_found, p3_rows, p3_promoted, p3_unreadable, p4_found, p4_records, p4_log_balance, p5_found, p5_profile, p5_drift, p5_drift_all, p6_found, p6_rows, p7_found, p7_totals)
}
