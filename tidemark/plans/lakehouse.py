"""From landed files to bronze, silver and gold, with crash-safe progress.

Every step leaves evidence before the next begins: a pending load, a snapshot that carries the load's id, a manifest in the outbox,
a receipt, the progress state. A restart finds the last evidence and goes on from there, so no load is lost or applied twice.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.operators import quality, versions
from tidemark.plans.reports import gold
from tidemark.sources import files as control
from tidemark.sources.snapshots import Cost, SnapshotTable

#: Figures of a metric record, beside metric_ts, source, load_id and status.
FIGURES = (
    "rows_processed", "files_processed", "bronze_rows", "silver_rows", "gold_rows", "duplicates_removed", "quality_violations", "duration_ms", "work_available", "work_in_flight", "work_completed", "keys_processed",
    "lower_versions_ignored", "ff14_conflicts", "shadow_comparisons", "shadow_mismatches", "silver_duration_ms", "gold_duration_ms", "files_planned", "bytes_planned", "files_removed", "files_added", "bytes_removed", "bytes_added", "snapshot_delta",
)
#: Completed loads that the progress state keeps; receipts are never pruned.
MAX_COMPLETED = 100
NOTHING: Callable[[str], None] = lambda step: None


def plain_uri(uri: str, schemes: tuple[str, ...] = ("s3", "s3a", "s3n")) -> str:
    """``bucket/key`` of an object-store URI; a path without scheme stays, any other scheme is an error."""
    scheme, there, rest = uri.partition("://")
    if not there:
        return uri.lstrip("/") if uri.startswith("/") else uri
    if scheme.lower() not in schemes:
        raise ValueError(f"unknown scheme in {uri}")
    return rest


def seconds_of(duration: str, allow_zero: bool = False) -> int:
    """``90s``, ``15m``, ``2h`` or ``7d`` in seconds."""
    found = re.fullmatch(r"(\d+)([smhd])", duration.strip(), re.IGNORECASE)
    if not found:
        raise ValueError(f"{duration!r} is no duration")
    value = int(found[1]) * {"s": 1, "m": 60, "h": 3600, "d": 86_400}[found[2].lower()]
    if value == 0 and not allow_zero:
        raise ValueError("a duration must be positive")
    return value


def check_retention(retention: str, horizon: str, margin: str) -> int:
    """Seconds of retention; it must be longer than the recovery horizon and its margin together, or evidence could expire."""
    kept, needed = seconds_of(retention), seconds_of(horizon) + seconds_of(margin, allow_zero=True)
    if kept <= needed:
        raise ValueError(f"retention of {kept} s does not exceed {needed} s")
    return kept


def committed_files(spark: SparkSession, landing: str, done: set[str] = frozenset()) -> list[str]:
    """Data files that a stream's commit log names and that are not done yet, sorted. A log that can't be read is an error."""
    found = set()
    for path, _, _ in control.list_files(spark, f"{landing}/_spark_metadata"):
        lines = control.read_text(spark, path).splitlines()
        if not lines or not lines[0].startswith("v"):
            raise ValueError(f"{path} is no commit log")
        for line in lines[1:]:
            entry = json.loads(line)
            if entry.get("action", "add") == "add" and entry["path"].endswith(".parquet"):
                found.add(entry["path"])
    return sorted(found - done)


def overlapping(manifests: DataFrame, in_flight: DataFrame) -> DataFrame:
    """Manifests ``(load_id, source_paths, bronze_data_files)`` that share a load, a source or a data file with work in flight.

    Shared entries meet by an equi-join on the entry, so no manifest is compared with every other.
    """
    entries = lambda rows: rows.select("load_id", F.explode(F.array_union(F.array(F.concat(F.lit("load:"), "load_id")), F.concat(F.transform("source_paths", lambda p: F.concat(F.lit("source:"), p)), F.transform("bronze_data_files", lambda p: F.concat(F.lit("file:"), p))))).alias("entry"))
    return entries(manifests).join(entries(in_flight).select("entry").distinct(), "entry", "left_semi").select("load_id").distinct()


def backfill_versions(rows: DataFrame) -> DataFrame:
    """Version 1 for rows without one, where no key is NULL, repeated or known under a version as well; else an error."""
    open_rows = rows.filter(F.col("business_version").isNull())
    per = open_rows.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    bad = per.filter("n > 1 OR order_id IS NULL").limit(1).count() or per.join(rows.filter("business_version IS NOT NULL").select("order_id"), "order_id", "left_semi").limit(1).count()
    if bad:
        raise ValueError("rows without a version are not single")
    return rows.withColumn("business_version", F.coalesce("business_version", F.lit(1).cast("bigint")))


@dataclass
class Lakehouse:
    spark: SparkSession
    root: str
    clock: Callable[[], float] = time.time
    seam: Callable[[str], None] = NOTHING  # called between steps; tests raise in it
    metrics: list[dict] = field(default_factory=list)

    def __post_init__(self) -> None:
        table = lambda name, **o: SnapshotTable(self.spark, f"{self.root}/{name}", clock=self.clock, **o)
        self.bronze, self.silver, self.gold = table("bronze"), table("silver", layout="bucket"), table("gold", key="country", layout=None)

    def _state(self, name: str, empty: dict) -> dict:
        path = f"{self.root}/control/{name}.json"
        return control.read_json(self.spark, path) if control.exists(self.spark, path) else empty

    def _keep(self, name: str, value: dict) -> None:
        control.write_json(self.spark, f"{self.root}/control/{name}.json", value)

    def record(self, source: str, status: str, load_id: str | None = None, **figures: int) -> None:
        """A row of metrics, kept as a file of its own; best effort, it never fails the work it measures."""
        try:
            row = {"metric_ts": self.clock(), "source": source, "load_id": load_id, "status": status, **figures}
            self.metrics.append({k: v for k, v in row.items() if k != "load_id"})
            control.write_json(self.spark, f"{self.root}/metrics/{uuid.uuid4().hex}.json", row)
        except Exception:  # noqa: BLE001, S110
            pass

    def metric_rows(self) -> DataFrame:
        """All metrics of this lakehouse, by whichever process they were recorded; figures not given are NULL."""
        return self._kept_rows("metrics", "metric_ts double, source string, load_id string, status string, " + ", ".join(f"{f} bigint" for f in FIGURES))

    def audit_rows(self) -> DataFrame:
        """One row per table and maintenance run, failed ones included."""
        return self._kept_rows("audit", "run string, run_ts double, table string, before int, after int, status string")

    def _kept_rows(self, folder: str, schema: str) -> DataFrame:
        paths = [p for p, _, _ in control.list_files(self.spark, f"{self.root}/{folder}") if p.endswith(".json")]
        return self.spark.read.schema(schema).json(paths) if paths else self.spark.createDataFrame([], schema)

    # --- landing to bronze --------------------------------------------------------------------------------------------
    def ingest(self, landing: str) -> str | None:
        """Append all newly committed files as one load; returns the load id, or None if there is nothing new."""
        self.recover(landing)
        state = self._state("writer", {"done": [], "pending": {}})
        new = committed_files(self.spark, landing, set(state["done"]))
        if not new:
            return None
        load = f"load-{uuid.uuid4().hex}"
        state["pending"][load] = new
        self._keep("writer", state)
        self.seam("pending")
        self._load(landing, load, new)
        return load

    def _load(self, landing: str, load: str, paths: list[str]) -> None:
        if self.bronze.find(load_id=load) is None:
            rows = self.spark.read.option("basePath", landing).parquet(*paths)
            for c, t in rows.dtypes:
                rows = rows.withColumn(c, F.col(c).cast("timestamp_ntz")) if t == "timestamp" else rows
            self.bronze.append(rows.withColumn("event_date", F.col("event_date").cast("date")), {"load-id": load})
        self.seam("appended")
        made = self.bronze.find(load_id=load)
        added = self.bronze.added_files(made)
        control.write_json(self.spark, f"{self.root}/outbox/{made.snapshot_id:09d}-{load}.json", {"version": 1, "load_id": load, "source_paths": sorted(paths), "bronze_data_files": added, "row_count": made.summary["added-records"]})
        self.seam("published")
        state = self._state("writer", {"done": [], "pending": {}})
        state["pending"].pop(load, None)
        state["done"] = sorted({*state["done"], *paths})
        self._keep("writer", state)
        self.record("writer", "success", load, rows_processed=made.summary["added-records"], files_added=made.summary["added-files"])

    def recover(self, landing: str) -> list[str]:
        """Finish loads that a crash left pending: a committed one is only published, another is appended under its own id."""
        pending = dict(self._state("writer", {"done": [], "pending": {}})["pending"])
        for load, paths in sorted(pending.items()):
            self._load(landing, load, paths)
        return sorted(pending)

    # --- bronze to silver ---------------------------------------------------------------------------------------------
    def outbox(self) -> list[str]:
        return [p for p, _, _ in control.list_files(self.spark, f"{self.root}/outbox") if p.endswith(".json")]

    def project(self) -> list[Cost]:
        """Apply every manifest of the outbox to silver, in order."""
        return [cost for path in self.outbox() if (cost := self._apply(path)) is not None]

    def _apply(self, path: str) -> Cost | None:
        manifest = control.read_json(self.spark, path)
        if manifest.get("version") != 1 or not manifest.get("load_id"):
            raise ValueError(f"{path} is no manifest")
        load = manifest["load_id"]
        progress = self._state("progress", {"next_sequence": 1, "completed": {}})
        ledger = f"{self.root}/ledger/{load}.json"
        if load in progress["completed"] or control.exists(self.spark, ledger):
            self._complete(progress, load, path)
            return None
        made, cost = self.silver.find(silver_work_id=load), Cost()
        changed = -1
        if made is None:
            # the load's own files, also where bronze has been rewritten since; they stay until retention has passed
            rows = self.bronze.open_paths(manifest["bronze_data_files"]) if manifest["bronze_data_files"] else self.bronze.read()
            incoming = rows.select(*versions.STATE)
            current = self.silver.read_keys(incoming.select("order_id")) if self.silver.snapshot() else incoming.limit(0)
            take = versions.resolve(current, incoming).persist()  # raises before anything is written
            try:
                changed = take.count()
                made, cost = self.silver.replace_keys(take, {"silver-work-id": load})
            finally:
                take.unpersist()
        self.seam("projected")
        receipt = {"load_id": load, "sequence": progress["next_sequence"], "source_paths": manifest["source_paths"], "completed_at": self.clock(), "result": "success", "silver_snapshot_id": made.snapshot_id if made else None, "changed_keys": changed}
        control.write_json(self.spark, ledger, receipt)
        self.seam("receipt")
        self._complete(progress, load, path)
        self.record("silver", "success", load, keys_processed=max(changed, 0), files_planned=cost.files_planned, bytes_planned=cost.bytes_planned, files_removed=cost.files_removed, files_added=cost.files_added)
        return cost

    def _complete(self, progress: dict, load: str, path: str) -> None:
        if load not in progress["completed"]:
            progress["completed"][load] = {"sequence": progress["next_sequence"]}
            progress["next_sequence"] += 1
            newest = sorted(progress["completed"].items(), key=lambda kv: -kv[1]["sequence"])[:MAX_COMPLETED]
            progress["completed"] = dict(newest)
            self._keep("progress", progress)
        self.seam("progress")
        control.delete(self.spark, path)

    def receipts(self) -> DataFrame:
        """All receipts as a table; one that did not succeed, or two for one load, are errors."""
        schema = "load_id string, sequence bigint, source_paths array<string>, completed_at double, result string, silver_snapshot_id bigint, changed_keys bigint"
        rows = self.spark.read.schema(schema).json([p for p, _, _ in control.list_files(self.spark, f"{self.root}/ledger") if p.endswith(".json")])
        if rows.filter("result IS NULL OR result <> 'success'").limit(1).count() or rows.groupBy("load_id").count().filter("count > 1").limit(1).count():
            raise ValueError("the receipts are not one success per load")
        return rows

    def rebuild(self, bronze_snapshot: int | None = None) -> DataFrame:
        """Silver anew from all of bronze, as it was at a snapshot."""
        return versions.latest_version(self.bronze.read(bronze_snapshot).select(*versions.STATE))

    # --- silver to gold -----------------------------------------------------------------------------------------------
    def publish_gold(self, strict: bool = False) -> dict[str, int]:
        """Check silver, then replace gold by its metrics; in strict mode violations raise and nothing is published."""
        state = self.silver.read()
        found = quality.publish_gate(state, strict)
        self.gold.overwrite(gold(state))
        self.record("gold", "success", quality_violations=sum(found.values()))
        return found

    def cycle(self, shadow: bool = True, strict: bool = False) -> DataFrame | None:
        """Project, compare the projection with a rebuild of the same bronze snapshot, publish gold only if they agree."""
        pinned = self.bronze.snapshot().snapshot_id
        self.project()
        if shadow:
            mismatches = versions.compare_states(self.rebuild(pinned), self.silver.read())
            if not mismatches.isEmpty():
                self.record("silver", "shadow_failed")
                raise ValueError("the projection differs from a rebuild: " + str([tuple(r) for r in mismatches.limit(5).collect()]))
        self.publish_gold(strict)
        return None

    # --- maintenance --------------------------------------------------------------------------------------------------
    def maintain(self, retention: str, horizon: str = "1h", margin: str = "15m", retain_last: int = 5, file_size_threshold: int = 64 << 20) -> list[dict]:
        """Optimize, expire and clean every table. A failed step is recorded, audited and raised, never tried again within the run."""
        kept, audit, run = check_retention(retention, horizon, margin), [], uuid.uuid4().hex

        def keep(row: dict) -> None:
            control.write_json(self.spark, f"{self.root}/audit/{run}-{row['table']}.json", {"run": run, "run_ts": self.clock(), **row})
            self.record("maintenance", row["status"])

        for name, table in (("bronze", self.bronze), ("silver", self.silver), ("gold", self.gold)):
            if table.snapshot() is None:
                continue
            row = {"table": name, "before": len(table.versions())}
            for step, work in (
                ("optimize", lambda t=table: t.optimize(file_size_threshold)),
                ("expire", lambda t=table: t.expire_snapshots(self.clock() - kept, retain_last)),
                ("orphans", lambda t=table: t.remove_orphans(self.clock() - kept)),
            ):
                try:
                    work()
                except Exception:
                    keep({**row, "status": f"failed:{step}"})
                    raise
            row["after"] = len(table.versions())
            row["status"] = "ok" if row["after"] <= retain_last + 2 or row["after"] < row["before"] else "noop"
            audit.append(row)
            keep(row)
        return audit

    def acknowledge_noop(self, path: str) -> bool:
        """Write the receipt of a manifest in flight whose rows are all in silver already; the manifest stays for ``project`` to find the receipt.

        False if it would change a row: nothing is written then. Conflicting rows raise.
        """
        manifest = control.read_json(self.spark, path)
        load, ledger = manifest["load_id"], f"{self.root}/ledger/{manifest['load_id']}.json"
        if control.exists(self.spark, ledger):
            return True
        incoming = self.bronze.open_paths(manifest["bronze_data_files"]).select(*versions.STATE) if manifest["bronze_data_files"] else self.bronze.read().select(*versions.STATE)
        current = self.silver.read_keys(incoming.select("order_id")) if self.silver.snapshot() else incoming.limit(0)
        if not versions.resolve(current, incoming).isEmpty():
            return False
        progress = self._state("progress", {"next_sequence": 1, "completed": {}})
        control.write_json(self.spark, ledger, {"load_id": load, "sequence": progress["next_sequence"], "source_paths": manifest["source_paths"], "completed_at": self.clock(), "result": "success", "silver_snapshot_id": None, "changed_keys": 0}, exclusive=True)
        return True


#: Why a manifest may not go.
REASONS = "no_physical_file_provenance load_id_not_found_in_bronze_snapshot_history load_id_has_ambiguous_bronze_snapshots manifest_is_post_migration_work active_or_inflight_progress null_order_id rows_not_fully_represented_in_authoritative_bronze order_id_missing_from_authoritative_bronze order_id_missing_from_current_silver silver_not_at_authoritative_b2_version".split()


def classify_manifests(manifests: DataFrame, rows: DataFrame, bronze: DataFrame, silver: DataFrame, snapshots: DataFrame, boundary: float | None, in_flight: DataFrame) -> DataFrame:
    """``(load_id, logical_rows, legacy_null_rows, versioned_rows, reasons, status)`` per manifest of an old outbox: may it go?

    ``manifests`` and ``in_flight``: (load_id, source_paths, bronze_data_files); ``rows``: (load_id, ``versions.STATE`` columns), the manifests' rows;
    ``snapshots``: (load_id, committed_at). ``boundary`` is the moment of the migration. A row without a version counts as version 1. Each row of
    bronze answers for one row of one manifest at most, earlier load ids first: claims are counted per kind of row, not matched one by one.
    """
    payload = ("order_id", "business_version", "customer", "amount", "country", "status", "event_time")
    per_load = rows.groupBy("load_id").agg(F.count(F.lit(1)).alias("logical_rows"), F.count_if(F.col("business_version").isNull()).alias("legacy_null_rows"), F.count_if(F.col("business_version").isNotNull()).alias("versioned_rows"), F.count_if(F.col("order_id").isNull()).alias("null_ids"))

    hashed = lambda frame: frame.withColumn("kind", F.sha2(F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}), 256))
    known = rows.filter("order_id IS NOT NULL")
    claims = hashed(known.withColumn("business_version", F.coalesce("business_version", F.lit(1).cast("bigint")))).groupBy("kind", "load_id").agg(F.count(F.lit(1)).alias("claimed"))
    there = hashed(bronze).groupBy("kind").agg(F.count(F.lit(1)).alias("available"))
    earlier = Window.partitionBy("kind").orderBy("load_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    unmatched = claims.withColumn("upto", F.sum("claimed").over(earlier)).join(there, "kind", "left").filter(F.col("upto") > F.coalesce("available", F.lit(0))).select("load_id").distinct().withColumn("unmatched", F.lit(True))

    newest = bronze.groupBy("order_id").agg(F.max("business_version").alias("authoritative")).withColumn("in_bronze", F.lit(True))
    state = silver.select("order_id", F.col("business_version").alias("current")).withColumn("in_silver", F.lit(True))
    ids = known.select("load_id", "order_id").distinct().join(newest, "order_id", "left").join(state, "order_id", "left")
    lacking, absent = F.col("in_bronze").isNull(), F.col("in_silver").isNull()
    per_ids = ids.groupBy("load_id").agg(F.bool_or(lacking).alias("lacking"), F.bool_or(~lacking & absent).alias("absent"), F.bool_or(~lacking & ~absent & ~F.col("authoritative").eqNullSafe(F.col("current"))).alias("behind"))
    commits = snapshots.groupBy("load_id").agg(F.count(F.lit(1)).alias("commits"), F.min("committed_at").alias("committed_at"))
    active = overlapping(manifests, in_flight).withColumn("active", F.lit(True))

    every = manifests.select("load_id", F.size("bronze_data_files").alias("files"))
    for part in (per_load, unmatched, per_ids, commits, active):
        every = every.join(part, "load_id", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    found = F.coalesce("commits", F.lit(0))
    after = F.lit(True) if boundary is None else F.col("committed_at") > F.lit(boundary)
    holds = [F.col("files") <= 0, found == 0, found > 1, (found == 1) & after, yes("active"), F.coalesce("null_ids", F.lit(0)) > 0, yes("unmatched"), yes("lacking"), yes("absent"), yes("behind")]
    reasons = F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in zip(holds, REASONS, strict=True)])))
    status = F.when(yes("active"), "IN_FLIGHT_BLOCKED").when(F.col("reasons") == F.array(F.lit("manifest_is_post_migration_work")), "LIVE_POST_MIGRATION").when(F.size("reasons") == 0, "SAFE_STALE").otherwise("BLOCKED")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("logical_rows", "legacy_null_rows", "versioned_rows")]
    return every.withColumn("reasons", reasons).select("load_id", *zero, "reasons", status.alias("status"))


def backfill_table(table: SnapshotTable, apply: bool = False) -> dict[str, int | bool]:
    """What giving version 1 to the unversioned rows of a table would change; with ``apply`` it is done, by one overwrite. Rows that are not single raise either way."""
    rows = table.read()
    filled = backfill_versions(rows)
    waiting = rows.filter("business_version IS NULL").count()
    if apply and waiting:
        table.overwrite(filled, {"backfill": "business_version"})
    return {"unversioned": waiting, "would_change": waiting > 0, "changed": bool(apply and waiting)}


def check_audit(audit: DataFrame, run: str, tables: tuple[str, ...] = ("bronze", "silver", "gold")) -> None:
    """A maintenance run must have exactly one row that is ok or noop for each table, and no other."""
    rows = audit.filter(F.col("run") == run).groupBy("table").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status").isin("ok", "noop")).alias("good")).collect()  # one row per table
    wrong = sorted({t for t in tables} ^ {r.table for r in rows if r.n == r.good == 1})
    if wrong:
        raise ValueError(f"run {run}: no single success for {', '.join(wrong)}")


def digest_of_rows(rows: DataFrame) -> str:
    """A digest of a table that depends on no order and gathers nothing: sums of 60-bit hashes, hashed."""
    text = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    part = lambda salt: F.sum(F.conv(F.substring(F.sha2(F.concat(F.lit(salt), text), 256), 1, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").cast("string")
    r = rows.agg(F.count(F.lit(1)).alias("n"), part("a").alias("a"), part("b").alias("b")).first()
    return hashlib.sha256(f"{r['n']}|{r['a']}|{r['b']}".encode()).hexdigest()
