"""Physical cost of keyed updates by layout, and the time of lakehouse cycles. Prints one JSON line.

The set-up is that of the published operational measurements: 10 days, 10,000 orders, 4 appends a day, an update of 10 keys; and
cycles over 218,961 current orders, once for one changed key and once whole with the shadow comparison.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import Window, functions as F  # noqa: E402

from tidemark.operators import versions  # noqa: E402
from tidemark.plans.lakehouse import Lakehouse  # noqa: E402
from tidemark.plans.reports import gold  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.external import synthetic_events  # noqa: E402
from tidemark.sources.snapshots import SnapshotTable  # noqa: E402


def events(spark, n, days):
    """Orders numbered through each day, as the measured set-up has them."""
    rows = synthetic_events(spark, n).withColumn("n", F.monotonically_increasing_id()).withColumn("n", F.row_number().over(Window.orderBy("n")) - 1).withColumn("d", F.pmod("n", F.lit(days)))
    day = F.date_add(F.lit("2026-01-01").cast("date"), F.col("d").cast("int"))
    at = F.col("event_time").cast("timestamp_ntz")
    return rows.select(
        F.format_string("order-%02d-%05d", F.col("d").cast("int"), F.floor(F.col("n") / days)).alias("order_id"), "customer", "amount", "country", "status", at.alias("event_time"), at.alias("kafka_timestamp"), F.lit(0).alias("kafka_partition"), F.col("n").cast("bigint").alias("kafka_offset"), day.alias("event_date"), "business_version"
    )


def layouts(spark, root):
    out = {}
    data = events(spark, 10_000, 10).persist()
    keys = data.filter(F.col("order_id").endswith("-00000"))  # one key a day
    update = keys.withColumn("business_version", F.lit(2).cast("bigint")).withColumn("amount", F.lit(500.0))
    for layout in ("day", "bucket(16)"):
        table = SnapshotTable(spark, f"{root}/{layout}", layout=layout)
        for day in [r[0] for r in data.select("event_date").distinct().orderBy("event_date").collect()]:
            for part in range(4):
                table.append(data.filter((F.col("event_date") == F.lit(day)) & (F.floor(F.substring("order_id", 10, 5).cast("int") / 250) == part)))
        files, size = table.plan_cost()
        _, cost = table.replace_keys(update)
        out[layout] = {"initial_files": files, "initial_bytes": size, "planned_files": cost.files_planned, "planned_bytes": cost.bytes_planned, "removed": cost.files_removed, "added": cost.files_added}
    return out


def cycles(spark, root):
    house = Lakehouse(spark, f"{root}/lake")
    data = events(spark, 218_961, 10)

    def load(rows, name):
        made = house.bronze.append(rows, {"load-id": name})
        from tidemark.sources import files as control

        control.write_json(spark, f"{house.root}/outbox/{made.snapshot_id:09d}-{name}.json", {"version": 1, "load_id": name, "source_paths": [], "bronze_data_files": house.bronze.added_files(made), "row_count": 0})

    load(data, "l1")
    house.project()
    out = {}
    for i in range(3):
        load(data.orderBy("order_id").limit(1).withColumn("business_version", F.lit(i + 2).cast("bigint")), f"one-{i}")
        t = time.perf_counter()
        house.project()
        out["one_key_ms"] = round((time.perf_counter() - t) * 1000)
    for _ in range(2):
        t = time.perf_counter()
        pinned = house.bronze.snapshot().snapshot_id
        assert versions.compare_states(house.rebuild(pinned), house.silver.read()).isEmpty()
        out["rebuild_and_compare_ms"] = round((time.perf_counter() - t) * 1000)
        t = time.perf_counter()
        house.gold.overwrite(gold(house.silver.read()))
        out["gold_ms"] = round((time.perf_counter() - t) * 1000)
    return out


if __name__ == "__main__":
    spark = build_session("layout", cores=8, shuffle_partitions=8, **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    with tempfile.TemporaryDirectory() as root:
        print(json.dumps({"layout": layouts(spark, root), "cycle": cycles(spark, root)}))
