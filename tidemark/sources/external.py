"""Bulk CSV, JDBC and synthetic sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Staging tables and their columns in file order; the load's day is added on loading.
STAGING = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp_ntz, price decimal(12,2), freight_value decimal(12,2)",
    "order_payments": "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value decimal(12,2)",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
}


def staged_csv(spark: SparkSession, path: str, table: str, ingest_date: str, null: str | None = None) -> DataFrame:
    """A CSV file with header as a staging table. Any malformed row fails the load; an empty unquoted field, or the text ``null`` where it is given, is NULL, a quoted one is empty text."""
    reader = spark.read.schema(STAGING[table]).option("header", True).option("mode", "FAILFAST").option("multiLine", True).option("escape", '"').option("emptyValue", "").option("nullValue", null)
    return reader.csv(path).withColumn("ingest_date", F.lit(ingest_date).cast("date"))


def csv_records(spark: SparkSession, path: str) -> int:
    """Records of a CSV file without its header; a quoted field may hold line ends."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).count()


def loaded_whole(files: dict[str, int], loaded: dict[str, int]) -> None:
    """Every staging table must hold as many rows as its file, and not none."""
    wrong = {t: (files.get(t, 0), loaded.get(t, 0)) for t in STAGING if not files.get(t) or files.get(t) != loaded.get(t)}
    if wrong:
        raise ValueError(f"rows in file and table differ: {wrong}")


def jdbc_table(spark: SparkSession, url: str, table: str, driver: str | None = None, partition: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """A table over JDBC, read in parallel where ``partition`` names (column, lower, upper, parts)."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if driver:
        reader = reader.option("driver", driver)
    if partition:
        column, low, high, parts = partition
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()


def to_jdbc(rows: DataFrame, url: str, table: str, driver: str | None = None, **options: str) -> None:
    writer = rows.write.format("jdbc").options(url=url, dbtable=table, truncate="true", **options)
    (writer.option("driver", driver) if driver else writer).mode("overwrite").save()


def synthetic_events(spark: SparkSession, n: int, seed: int = 42, start: str = "2026-01-01 00:00:00") -> DataFrame:
    """Order events with version 1; the same seed gives the same events on any cluster."""
    pick = lambda values, salt: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(len(values))) + 1).cast("int"))
    return spark.range(n).select(
        F.md5(F.concat_ws("-", F.lit(seed), "id")).alias("order_id"), pick(["alice", "bob", "carol", "dave"], "c").alias("customer"), F.round(5 + F.pmod(F.xxhash64("id", F.lit(seed), F.lit("a")), F.lit(49_500)) / 100, 2).alias("amount"),
        pick(["UK", "US", "ES", "DE", "FR"], "k").alias("country"), pick(["created", "paid", "shipped", "delivered"], "s").alias("status"), (F.lit(start).cast("timestamp") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("event_time"), F.lit(1).cast("bigint").alias("business_version"),
    )
