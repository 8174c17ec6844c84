"""Order events: parsing, classification with an ordered chain of reasons, and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

EVENT = T.StructType(
    [
        T.StructField(n, t)
        for n, t in (
            ("order_id", T.StringType()), ("customer", T.StringType()), ("amount", T.DoubleType()), ("country", T.StringType()), ("status", T.StringType()), ("event_time", T.TimestampType()),
            ("business_version", T.LongType()), ("source_epoch_id", T.StringType()), ("event_id", T.StringType()), ("canonical_payload", T.StringType()), ("canonical_payload_hash", T.StringType()),
        )
    ]
)
TRANSPORT = ("kafka_timestamp", "kafka_partition", "kafka_offset")


def digest_differs(payload: Column, digest: Column) -> Column:
    """True where both are given and the digest is not that of the payload's own bytes."""
    return payload.isNotNull() & digest.isNotNull() & (F.lower(digest) != F.sha2(F.encode(payload, "UTF-8"), 256))


def parse(messages: DataFrame) -> DataFrame:
    """Messages ``(value, timestamp, partition, offset)`` to the raw text, the parsed ``order`` and the transport columns."""
    raw = F.col("value").cast("string")
    return messages.select(raw.alias("raw_payload"), F.from_json(raw, EVENT).alias("order"), F.col("timestamp").alias("kafka_timestamp"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"))


def classify(parsed: DataFrame, epoch: str | None = None) -> DataFrame:
    """Adds ``dead_letter_reason``, NULL for a valid row; the first reason that holds counts.

    Text that is no JSON gives a struct of NULLs, hence ``missing_order_id``; only a NULL payload is ``invalid_json_or_schema``.
    """
    order = lambda c: F.col(f"order.{c}")
    reason = F.when(F.col("order").isNull(), "invalid_json_or_schema").when(order("order_id").isNull(), "missing_order_id")
    if epoch is not None:
        reason = (
            reason.when(order("source_epoch_id").isNull(), "missing_source_epoch_id")
            .when(order("source_epoch_id") != epoch, "source_epoch_mismatch")
            .when(order("event_id").isNull(), "missing_event_id")
            .when(order("canonical_payload").isNull() | order("canonical_payload_hash").isNull(), "missing_canonical_lineage")
        )
    return parsed.withColumn("dead_letter_reason", reason.when(digest_differs(order("canonical_payload"), order("canonical_payload_hash")), "canonical_payload_hash_mismatch"))


def valid(classified: DataFrame) -> DataFrame:
    return classified.filter("dead_letter_reason IS NULL").select("order.*", *TRANSPORT).withColumn("event_date", F.to_date("event_time"))


def dead_letters(classified: DataFrame) -> DataFrame:
    return classified.filter("dead_letter_reason IS NOT NULL").select("raw_payload", "dead_letter_reason", *TRANSPORT).withColumn("dead_letter_date", F.to_date("kafka_timestamp"))


def reconciliation(classified: DataFrame, *by: str) -> DataFrame:
    """Observed, valid and dead-lettered rows with the bounds of partitions and offsets; without ``by`` one row, zeros if empty."""
    bad = F.col("dead_letter_reason").isNotNull()
    measures = [
        F.count(F.lit(1)).alias("observed"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("dead_letter"),
        F.min("kafka_partition").alias("min_partition"), F.max("kafka_partition").alias("max_partition"), F.min("kafka_offset").alias("min_offset"), F.max("kafka_offset").alias("max_offset"),
    ]
    return classified.groupBy(*by).agg(*measures) if by else classified.agg(*measures)
