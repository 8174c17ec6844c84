"""References to records that do not exist on the day of the reference.

A parent's key exists over spans of days. With the day as integer, the sorted existing (key, day) pairs are compressed into
contiguous runs [start, end] per key; a reference is matched as of its day to the run that starts last before it and is an
orphan if there is none or if its day lies beyond the run's end. References are first reduced to distinct (key, day) pairs
with a row count, so a key that holds a third of all rows reaches its task as at most one row a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.text import epoch_day, plain_key

#: End of a run that no removal closes.
OPEN_END = 2_147_483_647


def existence_runs(rows: DataFrame, key: str, day: str, removals: DataFrame | None = None, removed_key: str = "key_value", removed_on: str = "removed_on") -> DataFrame:
    """Runs ``(key, run_start, run_end)`` of days on which a key exists.

    A key exists from the day of a row until the day before its next removal. Rows with a NULL or blank key or a NULL day
    are passed over; a row and a removal on one day count as a row. An empty table gives no runs.
    """
    events = rows.select(plain_key(key).alias("key"), epoch_day(day).alias("day"), F.lit(1).alias("state"))
    if removals is not None:
        events = events.unionByName(removals.select(plain_key(removed_key).alias("key"), epoch_day(removed_on).alias("day"), F.lit(0).alias("state")))
    states = events.filter("key IS NOT NULL AND day IS NOT NULL").groupBy("key", "day").agg(F.max("state").alias("state"))
    by_key = Window.partitionBy("key").orderBy("day")
    turns = states.withColumn("before", F.lag("state", 1, 0).over(by_key)).filter("state <> before")
    return (
        turns.withColumn("run_end", F.coalesce(F.lead("day").over(by_key) - 1, F.lit(OPEN_END)))
        .filter("state = 1")
        .select("key", F.col("day").alias("run_start"), "run_end")
    )


def compress_integers(keys: DataFrame, key: str, block: int = 1 << 20) -> DataFrame:
    """Contiguous runs ``(run_start, run_end)`` of an integer key column, for parents numbered by a sequence.

    Runs are built within blocks of ``block`` numbers, so no task sorts more than one block; a run that crosses a block's
    border comes out as one run per block, which the as-of match treats alike. NULL keys are passed over.
    """
    numbers = keys.select(F.col(key).cast("bigint").alias("k")).filter("k IS NOT NULL").distinct()
    in_block = Window.partitionBy("block").orderBy("k")
    numbered = numbers.withColumn("block", F.floor(F.col("k") / block)).withColumn("island", F.col("k") - F.row_number().over(in_block))
    return numbered.groupBy("block", "island").agg(F.min("k").alias("run_start"), F.max("k").alias("run_end")).select("run_start", "run_end")


def orphan_groups(references: DataFrame, runs: DataFrame) -> DataFrame:
    """Orphan groups ``(key, day, n)`` of references ``(key, day)``, by an as-of match to the preceding run start."""
    refs = references.filter("key IS NOT NULL AND day IS NOT NULL").groupBy("key", "day").agg(F.count(F.lit(1)).alias("n"))
    both = runs.select("key", F.col("run_start").alias("day"), F.lit(0).alias("kind"), "run_end", F.lit(None).cast("bigint").alias("n")).unionByName(
        refs.select("key", "day", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("run_end"), "n")
    )
    as_of = Window.partitionBy("key").orderBy("day", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matched = both.withColumn("end_before", F.last("run_end", ignorenulls=True).over(as_of))
    return matched.filter("kind = 1 AND (end_before IS NULL OR day > end_before)").select("key", "day", "n")


def orphan_rows(children: DataFrame, groups: DataFrame, salts: int = 16) -> DataFrame:
    """The rows of ``children`` (with ``key`` and ``day``) that belong to an orphan group.

    One orphan group may hold a third of the rows: rows are spread over ``salts`` and the groups, a small table already
    reduced to one row each, are repeated per salt. AQE splits what is still skewed.
    """
    salted = children.withColumn("salt", F.pmod(F.xxhash64(*children.columns), F.lit(salts)).cast("int"))
    repeated = groups.select("key", "day", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    return salted.join(repeated, ["key", "day", "salt"], "left_semi").drop("salt")


def order_references(orders: DataFrame, items: DataFrame, customers: DataFrame, removed: DataFrame) -> list[tuple[str, DataFrame, DataFrame]]:
    """(child table, its references, runs of its parent) for the two references of the order warehouse."""
    gone = {name: removed.filter(plain_key("table_name") == name) for name in ("stg_orders", "stg_customers")}
    item_refs = items.select(
        plain_key("order_id").alias("key"), epoch_day("ingest_date").alias("day"), plain_key("order_id").alias("child_order_id"), F.col("order_item_id").cast("int").alias("child_item_id")
    )
    order_refs = orders.select(
        plain_key("customer_id").alias("key"), epoch_day("ingest_date").alias("day"), F.lower(F.btrim(F.col("order_id"), F.lit(" \t"))).alias("child_order_id"), F.lit(0).alias("child_item_id")
    )
    return [
        ("stg_order_items", item_refs, existence_runs(orders, "order_id", "ingest_date", gone["stg_orders"])),
        ("stg_orders", order_refs, existence_runs(customers, "customer_id", "ingest_date", gone["stg_customers"])),
    ]


def find_orphans(orders: DataFrame, items: DataFrame, customers: DataFrame, removed: DataFrame) -> DataFrame:
    """Distinct ``(child_table, child_order_id, child_item_id, ingest_day)`` of all orphan references."""
    out = None
    for name, refs, runs in order_references(orders, items, customers, removed):
        found = orphan_rows(refs, orphan_groups(refs, runs)).select(
            F.lit(name).alias("child_table"), "child_order_id", "child_item_id", F.date_format(F.date_from_unix_date("day"), "yyyy-MM-dd").alias("ingest_day")
        ).distinct()
        out = found if out is None else out.unionByName(found)
    return out


def orphan_counts(orders: DataFrame, items: DataFrame, customers: DataFrame, removed: DataFrame) -> DataFrame:
    """Orphan rows and keys per child table and day; from the groups alone, without going back to the rows."""
    out = None
    for name, refs, runs in order_references(orders, items, customers, removed):
        found = orphan_groups(refs, runs).groupBy("day").agg(F.sum("n").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys")).select(
            F.lit(name).alias("child_table"), F.date_format(F.date_from_unix_date("day"), "yyyy-MM-dd").alias("ingest_day"), "orphan_rows", "orphan_keys"
        )
        out = found if out is None else out.unionByName(found)
    return out
