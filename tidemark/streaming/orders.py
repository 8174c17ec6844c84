"""The order stream: classify, land, dead-letter, serve and reconcile, in four queries with checkpoints of their own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.functions.money import TOTAL
from tidemark.operators import events, versions
from tidemark.sources import files as control
from tidemark.sources.snapshots import SnapshotTable

SERVING = ["order_id", "customer", "amount", "country", "status", "event_time", "business_version", "kafka_timestamp", "kafka_partition", "kafka_offset", "batch_id"]


@dataclass(frozen=True)
class Paths:
    """Where the stream writes. An epoch gives checkpoints of its own, so a new source epoch never resumes an old one's offsets; an explicit ``checkpoint`` wins."""

    root: str
    epoch: str | None = None
    checkpoint: str | None = None

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def dead_letter(self) -> str:
        return f"{self.root}/dead_letter"

    @property
    def receipts(self) -> str:
        return f"{self.root}/receipts"

    @property
    def serving(self) -> str:
        return f"{self.root}/serving"

    @property
    def totals(self) -> str:
        return f"{self.root}/country_totals"

    def checkpoint_of(self, query: str) -> str:
        base = self.checkpoint or (f"{self.root}/checkpoints/epoch={self.epoch}" if self.epoch else f"{self.root}/checkpoints/legacy")
        return f"{base}/{query}"


def deduplicated(orders: DataFrame, delay: str = "1 day") -> DataFrame:
    """The first arrival of each event id; state older than the delay is dropped, so it stays bounded. Rows without event time pass."""
    return orders.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])


def serve(spark: SparkSession, paths: Paths, batch: DataFrame, batch_id: int) -> None:
    """Merge a batch into the serving table: an unknown key is inserted, a known one replaced by a higher version only.

    Merging a batch again changes nothing. The totals per country are made anew from the merged table.
    """
    rows = batch.withColumn("amount", F.col("amount").try_cast("decimal(14,2)")).withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*SERVING)
    newest = versions.newest_in_batch(rows).persist()
    try:
        if newest.isEmpty():
            return
        table = SnapshotTable(spark, paths.serving, layout="bucket")
        if table.snapshot() is None:
            take = newest
        else:
            stored = table.read_keys(newest.select("order_id")).select(F.col("order_id").alias("k"), F.col("business_version").alias("had"))
            known, version, had = F.col("k").isNotNull(), F.col("business_version"), F.col("had")
            take = newest.join(stored, F.col("order_id") == F.col("k"), "left").filter(~known | (version.isNotNull() & (had.isNull() | (version > had)))).select(*SERVING)
        made, _ = table.replace_keys(take, {"batch-id": str(batch_id)})
        if made is not None or not control.exists(spark, paths.totals):
            country_totals(table.read()).coalesce(1).write.mode("overwrite").parquet(paths.totals)
    finally:
        newest.unpersist()


def country_totals(serving: DataFrame) -> DataFrame:
    return serving.groupBy(F.coalesce("country", F.lit("UNKNOWN")).alias("country")).agg(
        F.count(F.lit(1)).alias("orders_count"), F.coalesce(F.sum("amount"), F.lit(0)).cast(TOTAL).alias("total_amount"), F.coalesce(F.avg("amount"), F.lit(0)).cast(TOTAL).alias("avg_amount"), F.max("event_time").alias("last_event_time")
    )


def write_receipt(paths: Paths, batch: DataFrame, batch_id: int) -> None:
    """One receipt per batch, replaced if the batch runs again; bounds per partition beside the totals."""
    events.reconciliation(batch, "kafka_partition").withColumn("batch_id", F.lit(batch_id)).coalesce(1).write.mode("overwrite").parquet(f"{paths.receipts}/batch_id={batch_id}")


def receipts(spark: SparkSession, paths: Paths) -> DataFrame:
    """What all batches have seen, per partition; observed = valid + dead_letter."""
    return spark.read.parquet(paths.receipts).groupBy("kafka_partition").agg(
        *[F.sum(c).alias(c) for c in ("observed", "valid", "dead_letter")], F.min("min_offset").alias("min_offset"), F.max("max_offset").alias("max_offset")
    )


def start(spark: SparkSession, messages: DataFrame, paths: Paths, trigger: dict | None = None) -> list[StreamingQuery]:
    """Start the four queries over one source. ``trigger`` as for ``writeStream.trigger``; every 10 seconds by default."""
    when = trigger or {"processingTime": "10 seconds"}
    classified = events.classify(events.parse(messages), paths.epoch)
    orders = events.valid(classified)
    if paths.epoch:
        orders = deduplicated(orders)
    dead = events.dead_letters(classified)

    def sink(rows: DataFrame, name: str, path: str, by: str) -> StreamingQuery:
        return rows.writeStream.queryName(name).format("parquet").partitionBy(by).option("path", path).option("checkpointLocation", paths.checkpoint_of(name)).trigger(**when).start()

    def each(rows: DataFrame, name: str, work) -> StreamingQuery:
        return rows.writeStream.queryName(name).foreachBatch(work).option("checkpointLocation", paths.checkpoint_of(name)).trigger(**when).start()

    return [
        sink(orders, "landing", paths.landing, "event_date"),
        sink(dead, "dead_letter", paths.dead_letter, "dead_letter_date"),
        each(orders.drop("event_date"), "serving", lambda batch, n: serve(spark, paths, batch, n)),
        each(classified, "reconciliation", lambda batch, n: write_receipt(paths, batch, n)),
    ]


def run_available(spark: SparkSession, messages: DataFrame, paths: Paths) -> list[StreamingQuery]:
    """Process all that is there and stop. The first query that fails raises."""
    queries = start(spark, messages, paths, {"availableNow": True})
    try:
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    return queries


class ProgressLog(StreamingQueryListener):
    """Keeps one row per batch and query: rows in, rate, rows that came later than the watermark, state size."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.failed: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(int(s.numRowsDroppedByWatermark or 0) for s in p.stateOperators)
        kept = sum(int(s.numRowsTotal or 0) for s in p.stateOperators)
        self.rows.append((p.name, p.batchId, p.numInputRows, float(p.processedRowsPerSecond or 0), late, kept))

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failed.append(str(event.exception))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "query string, batch bigint, rows bigint, rows_per_second double, late_rows bigint, state_rows bigint")
