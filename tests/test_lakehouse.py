from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import versions
from tidemark.plans import lakehouse as lh
from tidemark.sources import files as control

EVENTS = "order_id string, customer string, amount double, country string, status string, event_time timestamp, kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint, event_date date, business_version bigint"
T = dt.datetime(2026, 8, 7, 12)


def row(key, version, offset, amount=1.0, customer="c", country="UK", day=7):
    return (key, customer, amount, country, "paid", T, T, 0, offset, dt.date(2026, 8, day) if day else None, version)


class Landing:
    """A streamed parquet sink that is fed batch by batch."""

    def __init__(self, spark, root):
        self.spark, self.source, self.path, self.checkpoint = spark, f"{root}/in", f"{root}/landing", f"{root}/cp"
        self.n = 0

    def add(self, rows):
        self.spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(self.source)
        stream = self.spark.readStream.schema(EVENTS).parquet(self.source)
        stream.writeStream.format("parquet").partitionBy("event_date").option("path", self.path).option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start().awaitTermination()


def state(house):
    return sorted((r.order_id, r.business_version, r.amount) for r in house.silver.read().collect())


def test_cycles(spark, tmp_path):
    landing, house = Landing(spark, str(tmp_path)), lh.Lakehouse(spark, str(tmp_path / "lake"))
    landing.add([row("a", 1, 1), row("a", 3, 2, 3.0), row("b", 2, 3, country=None), row("c", 1, 4, day=None)])
    load = house.ingest(landing.path)
    assert load and house.ingest(landing.path) is None and len(house.outbox()) == 1
    house.cycle()
    assert state(house) == [("a", 3, 3.0), ("b", 2, 1.0), ("c", 1, 1.0)] and house.outbox() == []
    landing.add([row("a", 2, 5, 9.0), row("b", 2, 6, country=None), row("d", 1, 7), row("c", 2, 8, 7.0, day=9)])
    house.ingest(landing.path)
    house.cycle()
    assert state(house) == [("a", 3, 3.0), ("b", 2, 1.0), ("c", 2, 7.0), ("d", 1, 1.0)]
    assert house.silver.read().filter("order_id = 'c'").count() == 1  # a key is current once, even if its day moves
    got = {(str(r.event_date), r.country): r.orders_count for r in house.gold.read().collect()}
    assert got == {("2026-08-07", "UK"): 2, ("2026-08-07", None): 1, ("2026-08-09", "UK"): 1}
    assert house.receipts().count() == 2
    assert lh.digest_of_rows(house.silver.read()) == lh.digest_of_rows(house.rebuild().repartition(3))
    with pytest.raises(ValueError, match="quality"):
        house.publish_gold(strict=True)
    audit = house.maintain("2h")
    assert {a["table"] for a in audit} == {"bronze", "silver", "gold"} and {a["status"] for a in audit} <= {"ok", "noop"}
    assert state(house) == [("a", 3, 3.0), ("b", 2, 1.0), ("c", 2, 7.0), ("d", 1, 1.0)]


def test_conflict_blocks_the_whole_batch(spark, tmp_path):
    landing, house = Landing(spark, str(tmp_path)), lh.Lakehouse(spark, str(tmp_path / "lake"))
    landing.add([row("a", 5, 1, 50.0)])
    house.ingest(landing.path)
    house.project()
    landing.add([row("a", 5, 2, 51.0), row("b", 1, 3)])
    house.ingest(landing.path)
    with pytest.raises(versions.VersionConflict):
        house.project()
    assert state(house) == [("a", 5, 50.0)] and len(house.outbox()) == 1


@pytest.mark.parametrize("step", ["pending", "appended", "published", "projected", "receipt", "progress"])
def test_crash_at_every_seam(spark, tmp_path, step):
    landing, house = Landing(spark, str(tmp_path)), lh.Lakehouse(spark, str(tmp_path / "lake"))
    landing.add([row("a", 1, 1), row("b", 1, 2)])

    def crash(at):
        if at == step:
            raise RuntimeError(step)

    house.seam = crash
    with pytest.raises(RuntimeError):
        house.ingest(landing.path)
        house.project()
    again = lh.Lakehouse(spark, str(tmp_path / "lake"))
    again.recover(landing.path)
    again.ingest(landing.path)
    again.project()
    assert state(again) == [("a", 1, 1.0), ("b", 1, 1.0)]
    assert again.bronze.read().count() == 2 and again.outbox() == []
    assert len(again.silver.versions()) == 1  # replay made no second snapshot


def test_crash_at_every_change_of_a_control_file(spark, tmp_path, monkeypatch):
    """Bronze is never doubled and nothing is lost, whichever control file the crash comes before, within or after."""
    landing = Landing(spark, str(tmp_path))
    landing.add([row("a", 1, 1), row("b", 1, 2)])
    calls, at = 0, 0
    while True:
        root = str(tmp_path / f"lake{at}")
        calls = 0

        def crash(name, path, at=at):
            nonlocal calls
            calls += 1
            if calls == at + 1:
                raise RuntimeError(f"{name} {path}")

        house = lh.Lakehouse(spark, root)
        monkeypatch.setattr(control, "step", crash)
        try:
            house.ingest(landing.path)
            house.project()
        except RuntimeError:  # metrics swallow it
            pass
        monkeypatch.setattr(control, "step", lambda name, path: None)
        if calls <= at:
            break
        again = lh.Lakehouse(spark, root)
        again.recover(landing.path)
        again.ingest(landing.path)
        again.project()
        assert again.bronze.snapshot().summary["total-records"] == 2 and again.silver.snapshot().summary["total-records"] == 2, at
        assert again.outbox() == [] and len(again.silver.versions()) == len(again.bronze.versions()) == 1
        at += 3 if at > 8 else 1  # every change before the first commit, then before or within each
    assert at > 20 and state(again) == [("a", 1, 1.0), ("b", 1, 1.0)]


def test_a_committed_load_is_known_after_its_version_has_expired(spark, tmp_path):
    now = [1000.0]
    landing, house = Landing(spark, str(tmp_path)), lh.Lakehouse(spark, str(tmp_path / "lake"), clock=lambda: now[0])
    landing.add([row("a", 1, 1)])

    def crash(step):
        if step == "appended":
            raise RuntimeError(step)

    house.seam = crash
    with pytest.raises(RuntimeError):
        house.ingest(landing.path)
    house.seam = lh.NOTHING
    for _ in range(3):  # other commits, then a pause longer than any retention
        now[0] += 1e6
        house.bronze.append(house.bronze.read().filter("order_id = 'a'").withColumn("order_id", F.lit("x")))
    assert house.bronze.expire_snapshots(now[0], retain_last=1) == 3
    house.recover(landing.path)
    assert house.bronze.read().filter("order_id = 'a'").count() == 1 and len(house.outbox()) == 1
    house.project()
    assert ("a", 1, 1.0) in state(house)


def test_torn_and_hidden_files_are_passed_over(spark, tmp_path):
    landing, house = Landing(spark, str(tmp_path)), lh.Lakehouse(spark, str(tmp_path / "lake"))
    landing.add([row("a", 1, 1)])
    house.ingest(landing.path)
    for folder in ("bronze/metadata", "control", "outbox"):  # what a crash within a write leaves
        (tmp_path / "lake" / folder / ".v000000009.json.0.tmp").write_text('{"torn')
    house.project()
    assert state(house) == [("a", 1, 1.0)] and house.bronze.versions() == [1]


def test_manifest_classifier(spark):
    """Against a plain loop over manifests in the order of their ids."""
    rng = random.Random(6)
    ids = [f"o{i}" for i in range(12)]
    make = lambda o, v: (o, "c", 1.0, "UK", "paid", T, T, 0, 1, dt.date(2026, 8, 7), v)
    bronze = [make(o, rng.choice([1, 2])) for o in ids[:10] for _ in range(rng.choice([1, 1, 2]))]
    newest = {}
    for r in bronze:
        newest[r[0]] = max(newest.get(r[0], 0), r[10])
    silver = [make(o, newest[o] if rng.random() < 0.8 else 9) for o in ids[:9]]
    manifests, rows, snaps, flying = [], [], [], []
    for n in range(40):
        load = f"l{n:02d}"
        manifests.append((load, [f"s{n}"], [] if rng.random() < 0.1 else [f"f{n}"]))
        rows += [(load, *make(rng.choice([*ids[:8], *ids[:8], rng.choice([*ids, None])]), rng.choice([None, 1, 2]))) for _ in range(rng.randrange(0, 3))]
        snaps += [(load, rng.choice([10.0, 10.0, 30.0]))] * rng.choice([1, 1, 1, 1, 0, 2])
        if rng.random() < 0.1:
            flying.append((f"x{n}", [f"s{n}"], []))
    left, want = Counter(tuple(r[:6]) + (r[10],) for r in bronze), {}
    state = {r[0]: r[10] for r in silver}
    for load, sources, data in sorted(manifests):
        why = set()
        why |= {"no_physical_file_provenance"} if not data else set()
        at = [t for k, t in snaps if k == load]
        why |= {"load_id_not_found_in_bronze_snapshot_history"} if not at else {"load_id_has_ambiguous_bronze_snapshots"} if len(at) > 1 else {"manifest_is_post_migration_work"} if at[0] > 20 else set()
        active = any(set(s) & set(sources) for _, s, _ in flying)
        why |= {"active_or_inflight_progress"} if active else set()
        need = Counter()
        for r in (r for r in rows if r[0] == load):
            if r[1] is None:
                why.add("null_order_id")
                continue
            need[tuple(r[1:7]) + (r[11] or 1,)] += 1
            o = r[1]
            why |= {"order_id_missing_from_authoritative_bronze"} if o not in newest else {"order_id_missing_from_current_silver"} if o not in state else {"silver_not_at_authoritative_b2_version"} if state[o] != newest[o] else set()
        for k, n in need.items():
            if left[k] < n:
                why.add("rows_not_fully_represented_in_authoritative_bronze")
            left[k] -= n
        want[load] = (sorted(why), "IN_FLIGHT_BLOCKED" if active else "LIVE_POST_MIGRATION" if why == {"manifest_is_post_migration_work"} else "SAFE_STALE" if not why else "BLOCKED")
    parts = "load_id string, source_paths array<string>, bronze_data_files array<string>"
    got = lh.classify_manifests(spark.createDataFrame(manifests, parts), spark.createDataFrame(rows, "load_id string, " + EVENTS), spark.createDataFrame(bronze, EVENTS), spark.createDataFrame(silver, EVENTS), spark.createDataFrame(snaps, "load_id string, committed_at double"), 20.0, spark.createDataFrame(flying, parts))
    assert {r.load_id: (r.reasons, r.status) for r in got.collect()} == want
    assert {"SAFE_STALE", "BLOCKED", "LIVE_POST_MIGRATION", "IN_FLIGHT_BLOCKED"} == {s for _, s in want.values()}


def test_noop_acknowledgement_metrics_and_backfill(spark, tmp_path):
    landing, house = Landing(spark, str(tmp_path)), lh.Lakehouse(spark, str(tmp_path / "lake"))
    landing.add([row("a", 1, 1), row("b", 1, 2)])
    house.ingest(landing.path)
    (path,) = house.outbox()
    assert house.acknowledge_noop(path) is False and house.receipts().count() == 0
    house.project()
    landing.add([row("a", 1, 1)])
    house.ingest(landing.path)
    (path,) = house.outbox()
    assert house.acknowledge_noop(path) and house.outbox() == [path]
    assert house.project() == [] and house.outbox() == [] and house.receipts().filter("changed_keys = 0").count() == 1
    house.maintain("2h")
    again = lh.Lakehouse(spark, str(tmp_path / "lake"))  # another process finds what was recorded
    assert {r.source for r in again.metric_rows().collect()} >= {"writer", "silver", "maintenance"} and again.metric_rows().filter("source = 'writer'").agg(F.sum("rows_processed")).first()[0] == 3
    assert len(again.metric_rows().columns) == 29 and {r.table for r in again.audit_rows().collect()} == {"bronze", "silver"}
    run = again.audit_rows().first().run
    lh.check_audit(again.audit_rows(), run, ("bronze", "silver"))
    for tables, rows in ((("bronze", "silver", "gold"), again.audit_rows()), (("bronze", "silver"), again.audit_rows().union(again.audit_rows().limit(1))), (("bronze",), again.audit_rows())):
        with pytest.raises(ValueError, match=run):
            lh.check_audit(rows, run, tables)
    old = lh.SnapshotTable(spark, str(tmp_path / "old"))
    old.append(spark.createDataFrame([row("x", None, 1), row("y", 2, 2)], EVENTS))
    assert lh.backfill_table(old) == {"unversioned": 1, "would_change": True, "changed": False} and len(old.versions()) == 1
    assert lh.backfill_table(old, apply=True)["changed"] and old.read().filter("business_version = 1").count() == 1
    assert lh.backfill_table(old, apply=True) == {"unversioned": 0, "would_change": False, "changed": False}


def test_small_contracts(spark):
    assert lh.plain_uri("s3a://b/k/x") == "b/k/x" and lh.plain_uri("b/k") == "b/k"
    with pytest.raises(ValueError):
        lh.plain_uri("ftp://b/k")
    assert [lh.seconds_of(x) for x in ("90s", "15M", "2h", "1d")] == [90, 900, 7200, 86_400]
    for bad in ("", "5", "h", "-1h", "0s", "1.5h"):
        with pytest.raises(ValueError):
            lh.seconds_of(bad)
    assert lh.check_retention("2h", "1h", "15m") == 7200
    for bad in ("75m", "1h", "soon"):
        with pytest.raises(ValueError):
            lh.check_retention(bad, "1h", "15m")
    rows = spark.createDataFrame([("a", None), ("b", 2)], "order_id string, business_version bigint")
    assert sorted(tuple(r) for r in lh.backfill_versions(rows).collect()) == [("a", 1), ("b", 2)]
    for extra in (("a", None), (None, None), ("a", 3)):
        with pytest.raises(ValueError):
            lh.backfill_versions(rows.union(spark.createDataFrame([extra], rows.schema)))
    assert rows.filter(F.col("order_id") == "a").count() == 1
