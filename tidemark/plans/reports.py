"""Named queries over the warehouse and the lakehouse tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.money import TOTAL, mean, total
from tidemark.functions.text import day_text
from tidemark.operators import events, quality, versions
from tidemark.plans.warehouse import Warehouse
from tidemark.session import work_dir
from tidemark.sources.tables import table

#: Arrivals from this moment on form the incoming side of the merge queries, earlier ones the current state.
SPLIT_AT = "2015-03-20 00:00:00"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def rows_of() -> Column:
    return F.count(F.lit(1))


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "bronze_orders").select(*versions.STATE)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return versions.latest_version(bronze(spark, sf))


def gold(state: DataFrame) -> DataFrame:
    """Per day, country and status: orders with an id, amounts and customers; NULL keys are groups of their own."""
    amount = F.col("amount").try_cast(TOTAL)
    return state.groupBy("event_date", "country", "status").agg(
        F.count("order_id").alias("orders_count"), total(amount).alias("total_amount"), mean(F.sum(amount), F.count("amount")).alias("avg_amount"), F.countDistinct("customer").alias("distinct_customers")
    )


# --- lakehouse -------------------------------------------------------------------------------------------------------------
@query
def gold_daily_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return gold(silver(spark, sf))


@query
def silver_latest(spark: SparkSession, sf: str) -> DataFrame:
    return silver(spark, sf)


@query
def silver_blend_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return versions.latest_blended(bronze(spark, sf))


@query
def collapse_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return versions.conflicts(bronze(spark, sf))


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = bronze(spark, sf).filter("order_id IS NOT NULL AND order_id <> '' AND business_version IS NOT NULL")
    late = F.col("kafka_timestamp") >= F.lit(SPLIT_AT).cast("timestamp_ntz")
    return versions.latest_version(rows.filter(~late)), versions.latest_version(rows.filter(late))


@query
def resolve_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return versions.decisions(*_sides(spark, sf)).select("order_id", "business_version", "current_version", "decision")


@query
def conditional_merge(spark: SparkSession, sf: str) -> DataFrame:
    current, incoming = _sides(spark, sf)
    newer = F.col("s.business_version") > F.col("t.business_version")
    return versions.conditional_merge(current, incoming, newer, check=False).select("order_id", "business_version", "kafka_partition", "kafka_offset", "amount", "status")


@query
def serving_upsert(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["order_id", "customer", "amount", "country", "status", "business_version", "kafka_partition", "kafka_offset"]
    stored = table(spark, sf, "streaming_orders").select(*columns)
    batch = bronze(spark, sf).filter("order_id IS NOT NULL").withColumn("amount", F.col("amount").try_cast("decimal(14,2)")).select(*columns)
    return versions.conditional_merge(stored, versions.newest_in_batch(batch), versions.newer_version(), check=False)


@query
def country_totals(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "streaming_orders").groupBy(F.coalesce("country", F.lit("UNKNOWN")).alias("country"))
    return rows.agg(
        rows_of().alias("orders_count"), F.coalesce(total("amount"), F.lit(0)).cast(TOTAL).alias("total_amount"), F.coalesce(mean(F.sum("amount"), F.count("amount")), F.lit(0.0)).alias("avg_amount"), F.max("event_time").cast("timestamp_ntz").alias("last_event_time")
    )


@query
def quality_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.violations(bronze(spark, sf))


@query
def quality_valid_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze(spark, sf)
    return rows.groupBy("event_date", quality.is_valid(rows.columns).alias("valid")).agg(rows_of().alias("rows"))


@query
def shadow_compare(spark: SparkSession, sf: str) -> DataFrame:
    """The blended state against the whole-row state: where they differ, versions have been mixed."""
    rows = bronze(spark, sf)
    return versions.compare_states(versions.latest_blended(rows), versions.latest_version(rows))


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    """bronze_orders as classified messages: the canonical text parsed, beside the digest that came with it."""
    rows = table(spark, sf, "bronze_orders")
    payload = F.from_json("canonical_payload", events.EVENT)
    parsed = rows.select(
        F.when(payload.isNotNull(), payload.withField("canonical_payload", F.col("canonical_payload")).withField("canonical_payload_hash", F.col("canonical_payload_hash"))).alias("order"), F.col("canonical_payload").alias("raw_payload"), *events.TRANSPORT, "event_date"
    )
    return events.classify(parsed)


@query
def dead_letter_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return _messages(spark, sf).groupBy(F.coalesce("dead_letter_reason", F.lit("valid")).alias("reason")).agg(rows_of().alias("rows"))


@query
def reconciliation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return events.reconciliation(_messages(spark, sf), "kafka_partition").drop("min_partition", "max_partition")


@query
def event_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The first arrival of every event id, as stored."""
    rows = table(spark, sf, "bronze_orders").filter("event_id IS NOT NULL")
    return rows.groupBy("event_id").agg(F.min(F.struct("kafka_timestamp", "kafka_partition", "kafka_offset")).alias("k")).select("event_id", "k.kafka_timestamp", "k.kafka_partition", "k.kafka_offset")


@query
def payload_hash_check(spark: SparkSession, sf: str) -> DataFrame:
    payload, digest = F.col("canonical_payload"), F.col("canonical_payload_hash")
    verdict = F.when(payload.isNull() | digest.isNull(), "absent").when(events.digest_differs(payload, digest), "differs").otherwise("matches")
    return table(spark, sf, "bronze_orders").groupBy("event_date", verdict.alias("verdict")).agg(rows_of().alias("rows"))


@query
def semantic_current_orders(spark: SparkSession, sf: str) -> DataFrame:
    return silver(spark, sf).select("order_id", "customer", "amount", "country", "status", "event_time", "event_date", "business_version")


@query
def semantic_daily_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return gold_daily_metrics(spark, sf).withColumnRenamed("event_date", "order_date")


@query
def legacy_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Eight counts over rows without a version: may they all be given version 1?"""
    rows = table(spark, sf, "bronze_orders")
    unversioned = F.col("business_version").isNull()
    payloads = rows.groupBy("order_id", *versions.PAYLOAD).agg(F.count_if(unversioned).alias("n"), F.count_if(~unversioned).alias("v"))
    keys = payloads.groupBy("order_id").agg(F.sum("n").alias("nulls"), F.count_if(F.col("n") > 0).alias("kinds"), F.sum("v").alias("versioned"))
    has = F.col("nulls") > 0
    return keys.agg(
        F.sum(F.col("nulls") + F.col("versioned")).alias("total_rows"), F.sum("nulls").alias("null_rows"), F.count_if(has).alias("distinct_null_order_ids"), F.count_if(F.col("nulls") > 1).alias("duplicate_order_ids"),
        F.count_if(F.col("kinds") > 1).alias("payload_conflict_order_ids"), F.count_if(has & (F.col("versioned") > 0)).alias("overlapping_order_ids"), F.sum("versioned").alias("versioned_rows"), F.sum(F.when(F.col("order_id").isNull(), F.col("nulls")).otherwise(0)).alias("null_order_ids"),
    )


@query
def layer_probes(spark: SparkSession, sf: str) -> DataFrame:
    raw = bronze(spark, sf).agg(rows_of().alias("bronze_rows"), F.max("business_version").alias("max_version"), F.countDistinct("order_id").alias("bronze_ids"))
    state = silver(spark, sf).agg(rows_of().alias("silver_rows"), F.countDistinct("order_id").alias("silver_ids"), F.count_if(F.col("order_id").isNull()).alias("null_ids"), F.count_if(F.col("country").isNull()).alias("null_countries"), F.count_if(F.col("event_date").isNull()).alias("null_days"))
    sums = gold_daily_metrics(spark, sf).agg(rows_of().alias("gold_rows"), F.sum("orders_count").alias("gold_orders"), total("total_amount").alias("gold_amount"))
    return raw.crossJoin(state).crossJoin(sums)  # one row each


@query
def latest_status_per_source(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lakehouse_metrics")
    best = rows.groupBy("source").agg(F.max(F.struct("metric_ts", "status", "duration_ms")).alias("m"), rows_of().alias("records"))
    return best.select("source", "m.status", "m.duration_ms", F.date_format("m.metric_ts", "yyyy-MM-dd HH:mm:ss").alias("metric_at"), "records")


@query
def metrics_by_status(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lakehouse_metrics").groupBy("source", "status")
    return rows.agg(rows_of().alias("records"), mean(F.sum("duration_ms"), F.count("duration_ms")).alias("avg_duration_ms"))


@query
def manifest_disposition(spark: SparkSession, sf: str) -> DataFrame:
    """Every load of the file log: are the files it added still live, all gone, or mixed?"""
    log = table(spark, sf, "file_log")
    last = log.groupBy("file_id").agg(F.max_by("log_action", "log_seq").alias("last_action"))
    entries = log.groupBy("load_id", "file_id").agg(F.max(F.when(F.col("log_action") == "add", 1).otherwise(0)).alias("added"), F.min("log_seq").alias("first_seq"))
    per = entries.join(last, "file_id").groupBy("load_id").agg(
        F.sum("added").alias("added_files"), F.count_if((F.col("added") == 1) & (F.col("last_action") == "add")).alias("live_files"), F.count_if(F.col("added") == 0).alias("removed_files")
    )
    verdict = F.when(F.col("added_files") == 0, "removes_only").when(F.col("live_files") == 0, "stale").when(F.col("live_files") == F.col("added_files"), "live").otherwise("mixed")
    return per.withColumn("disposition", verdict)


@query
def digest_set(spark: SparkSession, sf: str) -> DataFrame:
    """A digest of each load's set of files that depends on no order and gathers nothing: the sum of 60-bit hashes."""
    files = table(spark, sf, "file_log").select("load_id", "log_action", "file_id").distinct()
    part = F.conv(F.substring(F.md5(F.concat_ws("|", "log_action", F.col("file_id").cast("string"))), 1, 15), 16, 10).cast("decimal(20,0)")
    return files.groupBy("load_id").agg(rows_of().alias("files"), F.sum(part).cast("decimal(38,0)").cast("string").alias("digest"))


# --- warehouse -------------------------------------------------------------------------------------------------------------
@query
def core_orders(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).core_orders


@query
def core_order_items(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).core_order_items


@query
def order_items_wide(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).order_items_wide


@query
def sales_daily(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).sales_daily


@query
def customer_state_daily(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).customer_state_daily


@query
def reconcile_sales_daily(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).reconcile_sales_daily


@query
def reconcile_breaks(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).reconcile_sales_daily.filter(F.abs("diff_amount") > 0.01).orderBy("sales_date")


@query
def payment_type_daily(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).payment_type_daily


@query
def expected_vs_actual_full_join(spark: SparkSession, sf: str) -> DataFrame:
    """Payment types per day expected from core against those counted from staging, where they differ."""
    w = Warehouse(spark, sf)
    expected = w.payment_type_daily.select("sales_date", "main_payment_type", "orders_cnt", "payment_sum")
    orders = w.stg("orders").select("order_id", "ingest_date", F.to_date("order_purchase_timestamp").alias("sales_date"))
    actual = orders.join(w.payments_by_order, ["order_id", "ingest_date"], "left").groupBy("sales_date", "main_payment_type").agg(rows_of().alias("orders_cnt"), total("payment_value").alias("payment_sum"))
    e, a = expected.alias("e"), actual.alias("a")
    both = e.join(a, (F.col("e.sales_date") == F.col("a.sales_date")) & (F.col("e.main_payment_type") == F.col("a.main_payment_type")), "full")
    out = both.select(
        F.coalesce("e.sales_date", "a.sales_date").alias("sales_date"), F.coalesce("e.main_payment_type", "a.main_payment_type").alias("main_payment_type"),
        F.col("e.orders_cnt").alias("expected_orders"), F.col("a.orders_cnt").alias("actual_orders"), F.col("e.payment_sum").alias("expected_sum"), F.col("a.payment_sum").alias("actual_sum"),
    )
    return out.filter(~F.col("expected_orders").eqNullSafe(F.col("actual_orders")) | ~F.col("expected_sum").eqNullSafe(F.col("actual_sum")))


@query
def payment_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    staged = w.stg("order_payments").agg(F.coalesce(total("payment_value"), F.lit(0)).cast(TOTAL).alias("staging_payment_total"))
    core = w.core_orders.agg(F.coalesce(total("payment_value"), F.lit(0)).cast(TOTAL).alias("core_payment_total"))
    both = staged.crossJoin(core)  # one row each
    return both.withColumn("diff_amount", (F.col("staging_payment_total") - F.col("core_payment_total")).cast(TOTAL)).filter(F.abs("diff_amount") > 0.01)


def _rolled_up(w: Warehouse) -> DataFrame:
    return w.customer_state_daily.groupBy("sales_date").agg(F.sum("orders_cnt").alias("orders_cnt"), F.sum("items_cnt").alias("items_cnt"), total("gross_sales").alias("gross_sales"))


@query
def rollup_invariant(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    daily = w.sales_daily.select("sales_date", "orders_cnt", "items_cnt", "gross_sales")
    return quality.expect_same_rows(daily, _rolled_up(w))


@query
def except_both_ways(spark: SparkSession, sf: str) -> DataFrame:
    """Orders known to staging but not to core, and the other way round."""
    w = Warehouse(spark, sf)
    return quality.expect_same_rows(w.stg("orders").select("order_id", "ingest_date"), w.core_orders.select("order_id", "ingest_date"))


@query
def sales_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and their amount per day of the event stream."""
    rows = bronze(spark, sf).groupBy(F.to_date("event_time").alias("order_date"))
    return rows.agg(F.countDistinct("order_id").alias("orders"), total(F.col("amount").try_cast(TOTAL)).alias("amount"))


@query
def mart_first_days(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).sales_daily.filter("sales_date IS NOT NULL").orderBy("sales_date").limit(15)


@query
def top_states(spark: SparkSession, sf: str) -> DataFrame:
    per = Warehouse(spark, sf).customer_state_daily.groupBy("customer_state").agg(F.sum("orders_cnt").alias("orders_cnt"), F.sum("items_cnt").alias("items_cnt"), total("gross_sales").alias("gross_sales"))
    return per.orderBy(F.desc_nulls_last("gross_sales"), F.asc_nulls_last("customer_state")).limit(10)


def _span(rows: DataFrame, layer: str, name: str, day: str, counted: Column | None = None) -> DataFrame:
    text = lambda c: F.coalesce(day_text(c), F.lit("no data"))
    return rows.agg(text(F.min(day)).alias("date_from"), text(F.max(day)).alias("date_to"), (rows_of() if counted is None else counted).alias("rows_count")).select(F.lit(layer).alias("layer_name"), F.lit(name).alias("object_name"), "date_from", "date_to", "rows_count")


@query
def layer_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf, work_dir(spark, "warehouse"))
    orders = w.stg("orders").select("order_id", "ingest_date", F.to_date("order_purchase_timestamp").alias("day"))
    items = w.stg("order_items").select("order_id", "ingest_date", F.lit(1).alias("item")).join(orders, ["order_id", "ingest_date"], "left")
    parts = [
        _span(orders, "stg", "orders", "day"), _span(items, "stg", "order_items", "day", F.count("item")), _span(w.core_orders, "core", "orders", "order_purchase_date"),
        _span(w.core_order_items, "core", "order_items", "order_purchase_date"), _span(w.sales_daily, "marts", "sales_daily", "sales_date"), _span(w.customer_state_daily, "marts", "customer_state_daily", "sales_date"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    place = F.when(F.col("layer_name") == "stg", 1).when(F.col("layer_name") == "core", 2).otherwise(3)
    return out.orderBy(place, "object_name")


def _check(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(rows_of().alias("failed_rows")).select(F.lit(name).alias("check_name"), "failed_rows")


@query
def grain_checks(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    return _check(quality.expect_unique(w.order_items_wide, "order_id", "order_item_id"), "order_items_wide grain").unionByName(_check(quality.expect_unique(w.core_orders, "order_id"), "core_orders grain"))


@query
def null_keys(spark: SparkSession, sf: str) -> DataFrame:
    wide = Warehouse(spark, sf).order_items_wide
    grain, business = F.col("order_id").isNull() | F.col("order_item_id").isNull(), F.col("customer_id").isNull() | F.col("product_id").isNull() | F.col("seller_id").isNull()
    counted = wide.agg(F.count_if(grain).alias("grain"), F.count_if(business).alias("business"))
    return counted.select(F.inline(F.array(F.struct(F.lit("null grain keys").alias("check_name"), F.col("grain").alias("failed_rows")), F.struct(F.lit("null business keys").alias("check_name"), F.col("business").alias("failed_rows")))))


@query
def unique_check(spark: SparkSession, sf: str) -> DataFrame:
    return quality.expect_unique(Warehouse(spark, sf).stg("order_items"), "order_id", "order_item_id", "ingest_date")


@query
def accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return quality.expect_accepted(bronze(spark, sf), "status", quality.VALID_STATUSES)


def _measures(w: Warehouse) -> DataFrame:
    """One row of the figures that audits and scorecards share. Core tables should be stored; the wide items are read once for grain and keys."""
    no_key = F.lit(False)
    for c in ("order_id", "order_item_id", "customer_id", "product_id", "seller_id"):
        no_key = no_key | F.col(c).isNull()
    grains = w.order_items_wide.groupBy("order_id", "order_item_id").agg(rows_of().alias("copies"), F.count_if(no_key).alias("no_key"))
    parts = [
        w.stg("orders").agg(rows_of().alias("stg_orders")), w.stg("order_items").agg(rows_of().alias("stg_order_items")), w.core_order_items.agg(rows_of().alias("core_order_items")), w.sales_daily.agg(rows_of().alias("mart_sales_days")),
        grains.agg(F.count_if(F.col("copies") > 1).alias("duplicate_grain_rows"), F.coalesce(F.sum("no_key"), F.lit(0)).alias("null_key_rows")),
        w.reconcile_sales_daily.agg(F.coalesce(F.max(F.abs("diff_amount")), F.lit(0)).cast(TOTAL).alias("max_reconcile_diff")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.crossJoin(part)  # one row each
    return out


@query
def pipeline_audit(spark: SparkSession, sf: str) -> DataFrame:
    good = (F.col("duplicate_grain_rows") == 0) & (F.col("null_key_rows") == 0) & (F.col("max_reconcile_diff") <= 0.01)
    return _measures(Warehouse(spark, sf, work_dir(spark, "warehouse"))).withColumn("status", F.when(good, "success").otherwise("failed"))


@query
def quality_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    m = _measures(Warehouse(spark, sf, work_dir(spark, "warehouse")))
    line = lambda name, value, ok: F.struct(F.lit(name).alias("check_name"), value.cast(TOTAL).alias("metric_value"), F.when(ok, "ok").otherwise("fail").alias("status"))
    c = F.col
    difference = c("core_order_items") - c("stg_order_items")
    lines = F.array(
        line("stg_orders loaded", c("stg_orders"), c("stg_orders") > 0), line("stg_order_items loaded", c("stg_order_items"), c("stg_order_items") > 0), line("core matches stg order_items", difference, difference == 0),
        line("duplicate grain rows", c("duplicate_grain_rows"), c("duplicate_grain_rows") == 0), line("null business keys", c("null_key_rows"), c("null_key_rows") == 0), line("max reconcile diff", c("max_reconcile_diff"), c("max_reconcile_diff") <= 0.01),
    )
    return m.select(F.inline(lines)).orderBy(F.when(c("status") == "fail", 1).otherwise(2), "check_name")


@query
def warehouse_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf, work_dir(spark, "warehouse"))
    count = lambda rows, name: rows.agg(rows_of().alias(name))
    parts = [
        *[count(w.stg(t), f"stg_{t}") for t in ("orders", "order_items", "customers")], w.stg("order_payments").agg(rows_of().alias("stg_order_payments"), F.coalesce(total("payment_value"), F.lit(0)).cast(TOTAL).alias("staged_payments")),
        w.core_orders.agg(rows_of().alias("core_orders"), F.coalesce(total("payment_value"), F.lit(0)).cast(TOTAL).alias("core_payments")), count(w.core_order_items, "core_order_items"), count(w.sales_daily, "sales_days"), w.reconcile_sales_daily.agg(F.coalesce(F.max(F.abs("diff_amount")), F.lit(0)).cast(TOTAL).alias("max_reconcile_diff")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.crossJoin(part)  # one row each
    return out


@query
def recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The five newest runs of the audit table."""
    rows = table(spark, sf, "pipeline_runs").orderBy(F.desc("run_ts"), F.desc("run_id")).limit(5)
    return rows.select("run_id", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("run_at"), "status", "stg_orders", "stg_order_items", "core_order_items", "mart_sales_days", "duplicate_grain_rows", "null_key_rows", "max_reconcile_diff")


@query
def run_health(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "pipeline_runs").groupBy("ingestion_run_id")
    return rows.agg(rows_of().alias("runs"), F.bool_and(F.col("status") == "success").alias("all_good"), F.date_format(F.max("run_ts"), "yyyy-MM-dd HH:mm:ss").alias("last_run_at"))


@query
def multiset_match(spark: SparkSession, sf: str) -> DataFrame:
    """Item rows matched to payment rows of the same order and amount, each payment used at most once, earlier loads first."""
    w = Warehouse(spark, sf)
    there = w.stg("order_payments").groupBy("order_id", F.col("payment_value").alias("price")).agg(rows_of().alias("available"))
    claims = w.stg("order_items").filter("order_id IS NOT NULL AND price IS NOT NULL").groupBy("order_id", "price", "ingest_date").agg(rows_of().alias("claimed"))
    # counts, not rows, are put in order: a key with very many rows is one count a day
    earlier = Window.partitionBy("order_id", "price").orderBy("ingest_date").rowsBetween(Window.unboundedPreceding, -1)
    left = F.coalesce("available", F.lit(0)) - F.coalesce(F.sum("claimed").over(earlier), F.lit(0))
    matched = F.greatest(F.least(F.col("claimed"), F.col("left")), F.lit(0))
    numbered = claims.join(there, ["order_id", "price"], "left").withColumn("left", left)
    return numbered.groupBy("ingest_date").agg(F.sum(matched).alias("matched"), F.sum(F.col("claimed") - matched).alias("unmatched"))


@query
def like_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    """Runs by the way they were started, told by the run id's prefix."""
    run = F.col("ingestion_run_id")
    kind = F.when(run.like("scheduled%"), "scheduled").when(run.like("manual%"), "manual").when(run.isNull(), "unknown").otherwise("other")
    return table(spark, sf, "pipeline_runs").groupBy(kind.alias("started"), F.concat(F.col("status"), F.lit("/"), kind).alias("label")).agg(rows_of().alias("runs"))


@query
def file_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Stored files per day and size class: how far are they from well-sized?"""
    size = F.octet_length("body")
    kind = F.when(size == 0, "empty").when(size < 1024, "tiny").when(size < 8192, "small").otherwise("large")
    return table(spark, sf, "landing_files").groupBy("event_date", kind.alias("size_class")).agg(rows_of().alias("files"), F.sum(size).cast("bigint").alias("bytes"))


@query
def stale_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Sources by the time since their last success, measured at the newest metric of all."""
    rows = table(spark, sf, "lakehouse_metrics")
    good = F.when(F.col("status").isin("success", "ok", "noop"), F.unix_micros("metric_ts"))
    per = rows.groupBy("source").agg(F.max(good).alias("good"), F.count_if(good.isNull()).alias("failures"), F.max(F.unix_micros("metric_ts")).alias("newest"))
    latest = per.agg(F.max("newest").alias("now"))  # one row
    return per.crossJoin(latest).select("source", "failures", ((F.col("now") - F.col("good")) / 1_000_000).cast("bigint").alias("seconds_since_success"))


@query
def failure_increase(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes in which a source had failures in the ten minutes up to it: their increase and rate. Rows are counted per minute before minutes are put in order."""
    minute = F.floor(F.unix_micros("metric_ts") / 60_000_000)
    bad = F.col("status").isNotNull() & ~F.col("status").isin("success", "ok", "noop")
    per = table(spark, sf, "lakehouse_metrics").groupBy("source", minute.alias("minute")).agg(F.count_if(bad).alias("failures"))
    ten = Window.partitionBy("source").orderBy("minute").rangeBetween(-9, 0)
    return per.withColumn("increase", F.sum("failures").over(ten)).filter("increase > 0").select("source", "minute", "increase", F.round(F.col("increase") / 600, 9).alias("rate"))


@query
def current_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Incoming rows with the version of the current row but another amount or status."""
    current, incoming = _sides(spark, sf)
    c, i = current.alias("c"), incoming.alias("i")
    differs = ~F.col("c.amount").eqNullSafe(F.col("i.amount")) | ~F.col("c.status").eqNullSafe(F.col("i.status"))
    return i.join(c, (F.col("c.order_id") == F.col("i.order_id")) & (F.col("c.business_version") == F.col("i.business_version")) & differs).select("i.order_id", "i.business_version", F.col("c.amount").alias("current_amount"), F.col("i.amount").alias("incoming_amount"))


@query
def largest_payment(spark: SparkSession, sf: str) -> DataFrame:
    """The three largest known payments of each load."""
    order = Window.partitionBy("ingest_date").orderBy(F.desc("payment_value"), F.asc_nulls_last("order_id"), F.asc_nulls_last("payment_sequential"))
    rows = table(spark, sf, "stg_order_payments").filter("payment_value IS NOT NULL").dropDuplicates(["ingest_date", "order_id", "payment_sequential", "payment_value"])
    return rows.withColumn("place", F.row_number().over(order)).filter("place <= 3").select("ingest_date", "place", "payment_value")
