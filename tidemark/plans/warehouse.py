"""Staging tables to core tables to marts, as lazily evaluated relations."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.money import TOTAL, mean, total
from tidemark.sources.tables import table


@dataclass
class Warehouse:
    """All relations over one folder; each is built when first asked for and stays a plan."""

    spark: SparkSession
    folder: str
    store: str | None = None  # a folder to which core tables are written once, for queries that use them several times

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        if self.store is None:
            return rows
        rows.write.mode("overwrite").parquet(f"{self.store}/{name}")
        return self.spark.read.parquet(f"{self.store}/{name}")

    def stg(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, f"stg_{name}")

    @cached_property
    def payments_by_order(self) -> DataFrame:
        """Payments reduced per order and load before any join; the largest payment (an unknown one counts as largest) names the type."""
        value, seq = F.col("payment_value"), F.col("payment_sequential")
        first = F.struct(value.isNotNull(), -value, seq.isNull(), seq, F.col("payment_type").isNull(), F.col("payment_type"))
        return self.stg("order_payments").groupBy("order_id", "ingest_date").agg(
            total(value).alias("payment_value"), F.min_by("payment_type", first).alias("main_payment_type"), F.max("payment_installments").alias("max_installments")
        )

    @cached_property
    def core_orders(self) -> DataFrame:
        customers = self.stg("customers").select("customer_id", "ingest_date", "customer_state")
        orders = self.stg("orders").select("order_id", "customer_id", "order_status", F.to_date("order_purchase_timestamp").alias("order_purchase_date"), "ingest_date")
        joined = orders.join(customers, ["customer_id", "ingest_date"]).join(self.payments_by_order, ["order_id", "ingest_date"], "left")
        return self._kept(joined.select("order_id", "customer_id", "customer_state", "order_status", "order_purchase_date", "payment_value", "main_payment_type", "max_installments", "ingest_date"), "core_orders")

    @cached_property
    def core_order_items(self) -> DataFrame:
        orders = self.core_orders.select("order_id", "order_purchase_date", "order_status", "customer_id", "customer_state")
        items = self.stg("order_items").join(orders, "order_id").select(
            "order_id", "order_item_id", "order_purchase_date", "order_status", "customer_id", "customer_state", "product_id", "seller_id", "price", "freight_value", "ingest_date"
        )
        return self._kept(items, "core_order_items")

    @cached_property
    def order_items_wide(self) -> DataFrame:
        orders = self.core_orders.select("order_id", F.col("payment_value").alias("order_payment_value"), "main_payment_type")
        items = self.core_order_items
        return items.join(orders, "order_id", "left").select(*[c for c in items.columns if c != "ingest_date"], "order_payment_value", "main_payment_type", "ingest_date")

    @cached_property
    def sales_daily(self) -> DataFrame:
        return self.core_order_items.groupBy(F.col("order_purchase_date").alias("sales_date")).agg(
            F.countDistinct("order_id").alias("orders_cnt"), F.count(F.lit(1)).alias("items_cnt"), total("price").alias("gross_sales"), total("freight_value").alias("freight_sum")
        )

    @cached_property
    def customer_state_daily(self) -> DataFrame:
        return self.core_order_items.groupBy(F.col("order_purchase_date").alias("sales_date"), "customer_state").agg(
            F.countDistinct("order_id").alias("orders_cnt"), F.count(F.lit(1)).alias("items_cnt"), total("price").alias("gross_sales")
        )

    @cached_property
    def reconcile_sales_daily(self) -> DataFrame:
        """Daily sales of the mart beside those of staging; NULL days never match each other."""
        orders = self.stg("orders").select("order_id", "ingest_date", F.to_date("order_purchase_timestamp").alias("source_date"))
        source = orders.join(self.stg("order_items").select("order_id", "ingest_date", "price"), ["order_id", "ingest_date"]).groupBy("source_date").agg(total("price").alias("source_sales"))
        mart, src = F.coalesce("gross_sales", F.lit(0)).cast(TOTAL), F.coalesce("source_sales", F.lit(0)).cast(TOTAL)
        both = self.sales_daily.select("sales_date", "gross_sales").join(source, F.col("sales_date") == F.col("source_date"), "full")
        return both.select(F.coalesce("sales_date", "source_date").alias("sales_date"), mart.alias("mart_gross_sales"), src.alias("source_gross_sales"), (mart - src).cast(TOTAL).alias("diff_amount"))

    @cached_property
    def payment_type_daily(self) -> DataFrame:
        return self.core_orders.groupBy(F.col("order_purchase_date").alias("sales_date"), "main_payment_type").agg(
            F.count(F.lit(1)).alias("orders_cnt"), total("payment_value").alias("payment_sum"), mean(F.sum("payment_value"), F.count("payment_value")).alias("avg_payment")
        )


