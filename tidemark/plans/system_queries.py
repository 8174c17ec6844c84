"""Queries that run the tables, cycles, streams and loads of the engine over the tables of one folder, whole, and show what comes out."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.canonical import canonical_json, payload_digest
from tidemark.operators import quality
from tidemark.plans import publish, reports
from tidemark.plans.lakehouse import Lakehouse
from tidemark.plans.warehouse import Warehouse
from tidemark.session import work_dir
from tidemark.sources import catalog, external
from tidemark.sources.snapshots import SnapshotTable
from tidemark.sources.tables import stream_path, table, table_path
from tidemark.streaming import orders

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def rows_of():
    return F.count(F.lit(1))


# --- snapshotted tables ----------------------------------------------------------------------------------------------------
def _replaced(spark: SparkSession, sf: str) -> SnapshotTable:
    """The earlier state as a table by buckets, whose keys with later rows are then replaced."""
    current, incoming = reports._sides(spark, sf)
    made = SnapshotTable(spark, work_dir(spark, "snapshots"), layout="bucket")
    made.append(current, {"load-id": "earlier"})
    made.replace_keys(incoming, {"load-id": "later"})
    return made


@query
def snapshot_replace(spark: SparkSession, sf: str) -> DataFrame:
    return _replaced(spark, sf).read().select("order_id", "business_version", "kafka_partition", "kafka_offset")


@query
def snapshot_history(spark: SparkSession, sf: str) -> DataFrame:
    """Both snapshots as listed, and the rows read from each by its id."""
    made = _replaced(spark, sf)
    listed = made.snapshots().select("snapshot_id", "parent_id", "operation", F.element_at("summary", "total-records").alias("listed_rows"))
    counted = [made.read(n).agg(rows_of().alias("read_rows"), F.max("business_version").alias("max_version")).select(F.lit(n).cast("bigint").alias("snapshot_id"), "read_rows", "max_version") for n in made.versions()]
    return listed.join(reduce(DataFrame.unionByName, counted), "snapshot_id")


@query
def snapshot_keyed_read(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the orders that the serving table holds as created; files are chosen by bucket and span."""
    made = SnapshotTable(spark, work_dir(spark, "snapshots"), layout="bucket")
    made.append(reports.silver(spark, sf))
    return made.read_keys(table(spark, sf, "streaming_orders").filter("status = 'created'").select("order_id")).select("order_id", "business_version", "country")


@query
def snapshot_services(spark: SparkSession, sf: str) -> DataFrame:
    """Appends per topic partition, then optimized, expired and cleaned: the same rows per day in one version, no orphan left."""
    rows, now = reports.bronze(spark, sf), [0.0]
    made = SnapshotTable(spark, work_dir(spark, "snapshots"), clock=lambda: now[0])
    for n in (0, 1, 2):
        made.append(rows.filter(F.pmod(F.coalesce("kafka_partition", F.lit(0)), F.lit(3)) == n))
        now[0] += 1
    made.optimize(1 << 40)
    made.expire_snapshots(older_than=10.0, retain_last=1)
    made.remove_orphans(older_than=1e12)
    found = made.remove_orphans(older_than=1e12)
    per_day = made.read().groupBy("event_date").agg(rows_of().alias("rows"))
    return per_day.select("event_date", "rows", F.lit(len(made.versions())).alias("versions"), F.lit(found).alias("orphans"))


@query
def snapshot_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Rows written before a column came read NULL there; after a truncate earlier snapshots still read."""
    rows = reports.bronze(spark, sf)
    made = SnapshotTable(spark, work_dir(spark, "snapshots"), layout=None)
    made.append(rows.filter("business_version IS NULL").drop("business_version"))
    last = made.append(rows.filter("business_version IS NOT NULL"))
    made.truncate()
    whole = made.read(last.snapshot_id).groupBy(F.col("business_version").isNull().alias("unversioned")).agg(rows_of().alias("rows"))
    return whole.withColumn("rows_now", F.lit(made.read().count()))


@query
def audit_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Audit rows first inserted as running, then replaced by their outcome where there is one by then."""
    runs = table(spark, sf, "pipeline_runs").select("run_id", "status", "stg_orders", "null_key_rows")
    made = SnapshotTable(spark, work_dir(spark, "audit"), key="run_id", day=None, layout=None)
    made.replace_keys(runs.withColumn("status", F.lit("running")))
    made.replace_keys(runs.filter("status = 'success'"))
    return made.read()


# --- lakehouse cycles ------------------------------------------------------------------------------------------------------
def _later(rows: DataFrame) -> DataFrame:
    """A second load: paid orders come again, delivered and a version higher."""
    return rows.filter("status = 'paid' AND business_version IS NOT NULL").withColumn("status", F.lit("delivered")).withColumn("business_version", F.col("business_version") + 1)


def _house(spark: SparkSession, sf: str) -> Lakehouse:
    """Two loads of the serving rows with a key and a version, landed by a file stream and projected cycle by cycle, each compared with a rebuild."""
    root = work_dir(spark, "lake")
    rows = table(spark, sf, "streaming_orders").filter("order_id IS NOT NULL AND order_id <> '' AND business_version IS NOT NULL").withColumn("event_date", F.to_date("event_time")).withColumn("amount", F.col("amount").cast("double"))
    rows = rows.select("order_id", "customer", "amount", "country", "status", "event_time", "kafka_timestamp", "kafka_partition", "kafka_offset", "event_date", "business_version")
    house = Lakehouse(spark, f"{root}/house")
    for n, load in enumerate((rows, _later(rows))):
        load.write.mode("append").parquet(f"{root}/in/load={n}")
        stream = spark.readStream.schema(load.schema).parquet(f"{root}/in/load=*")
        stream.writeStream.format("parquet").partitionBy("event_date").option("path", f"{root}/landing").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        house.ingest(f"{root}/landing")
        house.cycle()
    return house


@query
def lake_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _house(spark, sf).silver.read().select("order_id", "business_version", "status", "event_date")


@query
def lake_gold(spark: SparkSession, sf: str) -> DataFrame:
    return _house(spark, sf).gold.read().select("event_date", "country", "status", "orders_count", "total_amount", "distinct_customers")


@query
def lake_receipts(spark: SparkSession, sf: str) -> DataFrame:
    house = _house(spark, sf)
    bronze = house.bronze.snapshots().select(F.col("snapshot_id").alias("sequence"), F.element_at("summary", "added-records").alias("bronze_rows"))
    return house.receipts().select("sequence", "result", "changed_keys").join(bronze, "sequence")


# --- the order stream ------------------------------------------------------------------------------------------------------
def _streamed(spark: SparkSession, sf: str, epoch: str | None = None) -> orders.Paths:
    """bronze_orders sent as messages through the four queries, which are then started once more without new input."""
    stored = spark.readStream.schema(spark.read.parquet(table_path(sf, "bronze_orders")).schema).parquet(stream_path(table_path(sf, "bronze_orders")))
    event = F.struct("order_id", "customer", "amount", "country", "status", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"), "business_version", "source_epoch_id", "event_id", "canonical_payload", "canonical_payload_hash")
    messages = stored.select(F.to_json(event).alias("value"), F.col("kafka_timestamp").cast("timestamp").alias("timestamp"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"))
    paths = orders.Paths(work_dir(spark, "stream"), epoch)
    for _ in range(2):
        orders.run_available(spark, messages, paths)
    return paths


@query
def stream_receipts(spark: SparkSession, sf: str) -> DataFrame:
    return orders.receipts(spark, _streamed(spark, sf))


@query
def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(_streamed(spark, sf).landing).groupBy(F.col("event_date").cast("date").alias("event_date")).agg(rows_of().alias("rows"), F.countDistinct("order_id").alias("orders"))


@query
def stream_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    schema = "raw_payload string, dead_letter_reason string, kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint, dead_letter_date date"
    return spark.read.schema(schema).parquet(_streamed(spark, sf).dead_letter).groupBy("dead_letter_date", "dead_letter_reason").agg(rows_of().alias("rows"))


@query
def stream_serving(spark: SparkSession, sf: str) -> DataFrame:
    return SnapshotTable(spark, _streamed(spark, sf).serving, layout="bucket").read().select("order_id", "business_version", "kafka_offset")


EPOCH = "epoch-2015-03-01"


@query
def stream_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """One source epoch: rows of others are dead letters, and an event id lands once. A row not after the first watermark, 1970, is late and dropped."""
    paths = _streamed(spark, sf, EPOCH)
    landed = spark.read.parquet(paths.landing).agg(rows_of().alias("rows")).select(F.lit("landed").alias("outcome"), "rows")
    return landed.unionByName(spark.read.parquet(paths.dead_letter).groupBy(F.col("dead_letter_reason").alias("outcome")).agg(rows_of().alias("rows")))


# --- loads, publishing, catalog, texts -------------------------------------------------------------------------------------
@query
def csv_staging(spark: SparkSession, sf: str) -> DataFrame:
    """The staging tables written as CSV and loaded again: records in the files, rows loaded, rows that differ."""
    out = []
    for name, declared in external.STAGING.items():
        path, rows = f"{work_dir(spark, 'csv')}/{name}", table(spark, sf, f"stg_{name}")
        columns = [c.split()[0] for c in declared.split(", ")]
        rows.select(*columns).write.option("header", True).option("escape", '"').option("quoteAll", True).option("emptyValue", "").option("nullValue", "\\N").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        loaded = external.staged_csv(spark, path, name, "2020-01-01", null="\\N").select(*columns)
        external.loaded_whole({t: external.csv_records(spark, path) if t == name else 1 for t in external.STAGING}, {t: loaded.count() if t == name else 1 for t in external.STAGING})
        counts = [f.agg(rows_of().alias("n")).first().n for f in (loaded, loaded.exceptAll(rows.select(*columns)), rows.select(*columns).exceptAll(loaded))]
        out.append((name, external.csv_records(spark, path), *counts))
    return spark.createDataFrame(out, "table_name string, file_records bigint, loaded_rows bigint, only_loaded bigint, only_stored bigint")


@query
def published_marts(spark: SparkSession, sf: str) -> DataFrame:
    """Two marts shown by one change of a pointer, then read as published."""
    w, root = Warehouse(spark, sf), work_dir(spark, "published")
    publish.publish_together(spark, root, {"sales_daily": w.sales_daily, "customer_state_daily": w.customer_state_daily}, {"sales_daily": ["sales_date"], "customer_state_daily": ["sales_date", "customer_state"]})
    daily = publish.published(spark, root, "sales_daily").select("sales_date", F.lit("sales_daily").alias("mart"), "orders_cnt", "items_cnt", "gross_sales")
    states = publish.published(spark, root, "customer_state_daily").select("sales_date", F.lit("customer_state_daily").alias("mart"), "orders_cnt", "items_cnt", "gross_sales")
    return daily.unionByName(states)


@query
def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of the order tables as the session's catalog gives them."""
    catalog.register_views(spark, sf)
    shown = catalog.columns(spark, "stg_orders", "stg_order_items", "stg_order_payments", "stg_customers", "bronze_orders", "streaming_orders")
    return shown.select("table_name", "position", "column_name")


@query
def canonical_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical texts of the serving rows, their digests summed per country: the same whatever the order of rows."""
    text = canonical_json({c: F.col(c) for c in ("order_id", "customer", "country", "status", "business_version")})
    part = F.conv(F.substring(payload_digest(text), 1, 15), 16, 10).cast("decimal(20,0)")
    return table(spark, sf, "streaming_orders").groupBy("country").agg(rows_of().alias("rows"), F.sum(F.length(text)).alias("characters"), F.sum(part).cast("decimal(38,0)").cast("string").alias("digest"))


@query
def equal_as_multisets(spark: SparkSession, sf: str) -> DataFrame:
    """Tables compared as multisets, in which repeats count and order does not."""
    rows = table(spark, sf, "stg_order_payments")
    copy = rows.select(*rows.columns).repartition("order_id")
    checks = [("itself", rows, copy), ("without repeats", rows, rows.distinct()), ("orders and items", rows.select("order_id"), table(spark, sf, "stg_order_items").select("order_id"))]
    return spark.createDataFrame([(name, quality.same_multiset(a, b)) for name, a, b in checks], "compared string, equal boolean")


@query
def files_never_landed(spark: SparkSession, sf: str) -> DataFrame:
    """Files that the log adds and the landing zone lacks, and the other way round."""
    logged = table(spark, sf, "file_log").filter("log_action = 'add'").select("file_id")
    return quality.expect_same_rows(logged, table(spark, sf, "landing_files").select("file_id"))


@query
def synthetic_orders(spark: SparkSession, sf: str) -> DataFrame:
    """As many generated events as there are orders: keys are unique, amounts, countries and states within their domain."""
    n = table(spark, sf, "stg_orders").count()
    rows = external.synthetic_events(spark, n)
    fits = F.col("amount").between(5, 500) & F.col("country").isin("UK", "US", "ES", "DE", "FR") & F.col("status").isin("created", "paid", "shipped", "delivered") & (F.col("business_version") == 1)
    return rows.agg(rows_of().alias("rows"), F.countDistinct("order_id").alias("keys"), F.count_if(~fits).alias("outside"))
