"""Current state by business version.

The highest ``business_version`` of a key decides, never the position in the topic; NULL is lowest. All choices are aggregates of
a struct, which are combined before the shuffle, so a key with a third of all rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEY, VERSION = "order_id", "business_version"
#: Columns that make up the business payload of an order event.
PAYLOAD = ("customer", "amount", "country", "status", "event_time", "event_date")
STATE = ("order_id", "customer", "amount", "country", "status", "event_time", "kafka_timestamp", "kafka_partition", "kafka_offset", "event_date", "business_version")


class VersionConflict(ValueError):
    """One key and version with different payloads."""


def _precedence(columns: list[str]) -> list[Column]:
    """Fields of the deciding struct: version, then first arrival, then all other columns so that ties are settled alike everywhere."""
    rest = [c for c in columns if c not in (KEY, VERSION, "kafka_partition", "kafka_offset")]
    return [F.col(VERSION), (-F.col("kafka_partition")).alias("__partition"), (-F.col("kafka_offset")).alias("__offset"), *[F.col(c) for c in rest]]


def latest_version(rows: DataFrame) -> DataFrame:
    """One whole row per key: highest version, among equals the first to arrive. NULL keys form one group, as any value does."""
    columns = rows.columns
    best = rows.groupBy(KEY).agg(F.max(F.struct(*_precedence(columns))).alias("__s"))
    back = {"kafka_partition": -F.col("__s.__partition"), "kafka_offset": -F.col("__s.__offset")}
    return best.select(*[F.col(KEY) if c == KEY else back.get(c, F.col(f"__s.`{c}`")).cast(dict(rows.dtypes)[c]).alias(c) for c in columns])


def latest_blended(rows: DataFrame, columns: tuple[str, ...] = (*PAYLOAD, VERSION)) -> DataFrame:
    """Column by column the value of the highest version that has one: the compatible form, which mixes versions where the newest has NULLs."""
    order = F.struct(F.col(VERSION), (-F.col("kafka_partition")).alias("p"), (-F.col("kafka_offset")).alias("o"))
    return rows.groupBy(KEY).agg(*[F.max(F.when(F.col(c).isNotNull(), F.struct(order.alias("k"), F.col(c).alias("v"))))["v"].alias(c) for c in columns])


def conflicts(rows: DataFrame) -> DataFrame:
    """``(order_id, business_version, payloads)`` where equal versions carry different payloads, at any version. NULLs compare equal."""
    kinds = rows.filter(F.col(KEY).isNotNull() & F.col(VERSION).isNotNull()).groupBy(KEY, VERSION, *PAYLOAD).agg(F.lit(1).alias("one"))
    return kinds.groupBy(KEY, VERSION).agg(F.count(F.lit(1)).alias("payloads")).filter("payloads > 1")


def collapse_delta(rows: DataFrame) -> DataFrame:
    """The batch reduced to one row per key. Raises before anything is written if a key is NULL or empty, a version is NULL or versions conflict."""
    bad = rows.agg(
        F.count_if(F.coalesce(F.col(KEY) == "", F.lit(True))).alias("keys"), F.count_if(F.col(VERSION).isNull()).alias("versions")
    ).first()
    if bad["keys"]:
        raise ValueError(f"{bad['keys']} rows have a null or empty {KEY}")
    if bad["versions"]:
        raise ValueError(f"{bad['versions']} rows have no {VERSION}")
    clash = conflicts(rows).limit(5).collect()
    if clash:
        raise VersionConflict("conflicting payloads: " + ", ".join(f"{r[KEY]} at {r[VERSION]}" for r in clash))
    return latest_version(rows)


def decisions(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """``incoming`` (one row per key) with ``decision``: insert, update, stale, replay or conflict against the current row."""
    now = current.select(F.col(KEY).alias("__key"), F.col(VERSION).alias("__version"), *[F.col(c).alias(f"__{c}") for c in PAYLOAD])
    same = F.lit(True)
    for c in PAYLOAD:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    version, had = F.col(VERSION), F.col("__version")
    decision = (
        F.when(F.col("__key").isNull(), "insert")
        .when(had.isNull() | (version > had), "update")
        .when(version < had, "stale")
        .when(same, "replay")
        .otherwise("conflict")
    )
    joined = incoming.join(now, F.col(KEY) == F.col("__key"), "left")
    return joined.select(*incoming.columns, F.col("__version").alias("current_version"), decision.alias("decision"))


def resolve(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows that must be written: inserts and updates. Raises if an equal version differs from the current row."""
    decided = decisions(current, collapse_delta(incoming))
    clash = decided.filter("decision = 'conflict'").limit(5).collect()
    if clash:
        raise VersionConflict("payload differs from the current row: " + ", ".join(f"{r[KEY]} at {r[VERSION]}" for r in clash))
    return decided.filter("decision IN ('insert', 'update')").select(*incoming.columns)


def conditional_merge(target: DataFrame, source: DataFrame, when_matched: Column, key: str = KEY, check: bool = True) -> DataFrame:
    """Target after a merge: matched rows are replaced where ``when_matched`` holds (over ``s.*`` and ``t.*``), others are inserted.

    A source with several rows for one key is an error, as in SQL. Rows with a NULL key never match.
    """
    if check and source.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").limit(1).count():
        raise ValueError(f"several source rows for one {key}")
    matched = F.col(f"s.{key}").isNotNull() & F.col(f"t.{key}").isNotNull()
    both = target.withColumn("__t", F.lit(True)).alias("t").join(source.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    take = F.when(matched, F.coalesce(when_matched, F.lit(False))).otherwise(F.col("t.__t").isNull())
    return both.select(*[F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns])


def newer_version() -> Column:
    """Guard of the serving upsert: the incoming version must be known and above the stored one, or the stored one unknown."""
    return F.col(f"s.{VERSION}").isNotNull() & (F.col(f"t.{VERSION}").isNull() | (F.col(f"s.{VERSION}") > F.col(f"t.{VERSION}")))


def newest_in_batch(rows: DataFrame) -> DataFrame:
    """One row per key for serving: highest version (NULL lowest), then highest offset (NULL highest)."""
    rest = [c for c in rows.columns if c not in (KEY, VERSION, "kafka_offset")]
    best = rows.groupBy(KEY).agg(F.max(F.struct(VERSION, F.col("kafka_offset").isNull().alias("__open"), "kafka_offset", *rest)).alias("__s"))
    return best.select(*[F.col(KEY) if c == KEY else F.col(f"__s.`{c}`").alias(c) for c in rows.columns])


def compare_states(left: DataFrame, right: DataFrame, columns: tuple[str, ...] = (VERSION, *PAYLOAD)) -> DataFrame:
    """``(order_id, mismatch_type, side, differing)`` between two states, transport columns aside.

    A key more than once on a side gives a ``duplicate_business_key`` row per surplus row and is compared by one of its rows.
    """
    out = None
    single = {}
    for side, rows in (("left", left), ("right", right)):
        packed = rows.groupBy(KEY).agg(F.min(F.struct(*columns)).alias(side), F.count(F.lit(1)).alias("n"))
        single[side] = packed.select(F.col(KEY).alias(f"{side}_key"), F.lit(True).alias(f"{side}_there"), side)
        surplus = packed.filter("n > 1").select(KEY, F.lit("duplicate_business_key").alias("mismatch_type"), F.lit(side).alias("side"), F.lit("").alias("differing"), F.explode(F.sequence(F.lit(2), F.col("n"))).alias("copy")).drop("copy")
        out = surplus if out is None else out.unionByName(surplus)
    both = single["left"].join(single["right"], F.col("left_key").eqNullSafe(F.col("right_key")), "full")
    differing = F.array_compact(F.array(*[F.when(~F.col(f"left.{c}").eqNullSafe(F.col(f"right.{c}")), F.lit(c)) for c in columns]))
    there = F.col("left_there").isNotNull() & F.col("right_there").isNotNull()
    kind = (
        F.when(F.col("left_there").isNull(), "missing_in_left")
        .when(F.col("right_there").isNull(), "missing_in_right")
        .when(F.concat_ws(",", differing) == VERSION, "business_version_mismatch")
        .when(F.size(differing) > 0, "payload_mismatch")
    )
    found = both.select(F.coalesce("left_key", "right_key").alias(KEY), kind.alias("mismatch_type"), F.lit("").alias("side"), F.when(there, F.concat_ws(",", differing)).otherwise("").alias("differing"))
    return out.unionByName(found.filter("mismatch_type IS NOT NULL"))
