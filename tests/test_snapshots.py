from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sources import files as control
from tidemark.sources.snapshots import CommitConflict, SnapshotTable

SCHEMA = "order_id string, event_date date, business_version bigint, amount double"
DAY = dt.date(2020, 1, 1)


class Clock:
    now = 1000.0

    def __call__(self):
        Clock.now += 1
        return Clock.now


def table(spark, path, **options):
    return SnapshotTable(spark, str(path), clock=Clock(), **options)


def rows(spark, data):
    return spark.createDataFrame([(k, DAY + dt.timedelta(days=d) if d is not None else None, v, a) for k, d, v, a in data], SCHEMA)


def state(df):
    return sorted((r.order_id, r.business_version) for r in df.collect())


@pytest.mark.parametrize("layout", ["day", "bucket(4)", None])
def test_append_replace_time_travel(spark, tmp_path, layout):
    t = table(spark, tmp_path / "t", layout=layout)
    first = t.append(rows(spark, [(f"k{i:03d}", i % 3, 1, 1.0) for i in range(60)] + [("none", None, 1, 1.0)]), {"load-id": "l1"})
    second = t.append(rows(spark, [("z1", 1, 1, 2.0)]), {"load-id": "l2"})
    made, cost = t.replace_keys(rows(spark, [("k001", 5, 2, 9.0), ("new", 0, 1, 1.0)]), {"silver-work-id": "w"})
    assert made.parent_id == second.snapshot_id and cost.snapshot_delta == 1
    assert cost.files_removed <= cost.files_planned <= second.summary["total-files"] and cost.files_removed >= 1
    now = t.read()
    assert now.count() == 63 and state(now.filter("order_id = 'k001'")) == [("k001", 2)]
    assert now.filter("event_date IS NULL").count() == 1
    assert t.read(first.snapshot_id).count() == 61
    assert t.read(as_of=second.committed_at).count() == 62 and t.read(as_of=first.committed_at + 0.5).count() == 61
    assert t.find(load_id="l1").snapshot_id == first.snapshot_id and t.find(load_id="x") is None
    assert state(t.read_keys(spark.createDataFrame([("z1",), ("k001",), ("absent",)], "order_id string"))) == [("k001", 2), ("z1", 1)]
    assert t.replace_keys(rows(spark, [])) == (None, type(cost)())
    assert t.snapshots().count() == 3 and t.files().agg(F.sum("rows")).first()[0] == 63
    assert t.entries().filter("status = 'removed'").count() == cost.files_removed


def test_bucket_layout_plans_fewer_files(spark, tmp_path):
    data = rows(spark, [(f"k{i:05d}", i % 10, 1, 1.0) for i in range(1000)])
    keys = spark.createDataFrame([("k00007",)], "order_id string")
    planned = {}
    for layout in ("day", "bucket(16)"):
        t = table(spark, tmp_path / layout, layout=layout)
        for part in (0, 1, 2, 3):
            t.append(data.filter(F.col("order_id").substr(6, 1).cast("int") % 4 == part))
        planned[layout] = t.plan_cost(keys)[0] / t.plan_cost()[0]
        _, cost = t.replace_keys(rows(spark, [("k00007", 7, 2, 5.0)]))
        assert cost.files_removed == 1
    assert planned["bucket(16)"] < planned["day"]


def test_more_keys_than_spans_still_choose(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path / "t")
    for d in range(3):
        t.append(rows(spark, [(f"k{d}{i}", d, 1, 1.0) for i in range(5)]))
    keys = spark.createDataFrame([("k03",), ("k21",), (None,)], "order_id string")
    assert t.plan_cost(keys)[0] == 2 and t.read_keys(keys).count() == 2
    monkeypatch.setattr("tidemark.sources.snapshots.KEY_SPANS", 1)
    assert 2 <= t.plan_cost(keys)[0] <= 3 and t.read_keys(keys).count() == 2
    assert t.read_keys(keys.limit(0)).count() == 0


def test_many_random_keys_are_pruned(spark, tmp_path, monkeypatch):
    """1,001 keys over half of the key space, more than there are spans: files of the other half are not planned."""
    monkeypatch.setattr("tidemark.sources.snapshots.KEY_SPANS", 64)
    t = table(spark, tmp_path / "t", layout=None)
    t._write = lambda rows, max_rows=0, write=t._write: write(rows, 100)  # many files, each a short span
    t.append(rows(spark, [(f"k{i:05d}", 0, 1, 1.0) for i in range(8000)]).coalesce(1))
    keys = spark.createDataFrame([(f"k{(i * 7919) % 4000:05d}",) for i in range(1001)], "order_id string")
    planned, there = t.plan_cost(keys)[0], t.plan_cost()[0]
    assert there == 80 and planned <= 41
    assert t.read_keys(keys).count() == keys.distinct().count()


def test_a_day_with_most_rows_gives_several_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        t = table(spark, tmp_path / "t")
        data = spark.range(200_000).selectExpr("sha2(cast(id AS string), 256) AS order_id", "date_add(date'2020-01-01', IF(id % 10 = 0, cast(id % 70 AS int), 0)) AS event_date", "id AS business_version", "1.0D AS amount").repartition(8)
        t.append(data)
        per_day = {r.part: (r.n, r.rows) for r in t.files().groupBy("part").agg(F.count("path").alias("n"), F.sum("rows").alias("rows")).collect()}
        assert sum(n for _, n in per_day.values()) == 200_000
        hot = per_day["2020-01-01"]
        assert hot[1] > 180_000 and hot[0] >= 4
        assert sum(files for day, (files, _) in per_day.items() if day != "2020-01-01") <= 40
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)


def test_buckets_double_as_the_table_grows(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path / "t", layout="bucket")
    monkeypatch.setattr("tidemark.sources.snapshots.LEAST_BUCKETS", 2)
    t.append(rows(spark, [(f"k{i}", 0, 1, 1.0) for i in range(50)]))
    assert {r.part.split("-of-")[1] for r in t.files().collect()} == {"2"}
    monkeypatch.setattr("tidemark.sources.snapshots.BUCKET_BYTES", t.snapshot().summary["total-bytes"] // 3)
    t.append(rows(spark, [(f"n{i}", 0, 1, 1.0) for i in range(50)]))
    assert {r.part.split("-of-")[1] for r in t.files().collect()} == {"2", "4"}
    keys = spark.createDataFrame([("k7",), ("n7",)], "order_id string")
    assert state(t.read_keys(keys)) == [("k7", 1), ("n7", 1)]
    t.replace_keys(rows(spark, [("k7", 0, 2, 1.0), ("n7", 0, 2, 1.0)]))
    assert state(t.read_keys(keys)) == [("k7", 2), ("n7", 2)] and t.read().count() == 100
    t.optimize(0)
    assert len({r.part.split("-of-")[1] for r in t.files().collect()}) == 1 and t.read().count() == 100


def test_lists_are_rebased_and_evidence_outlives_versions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sources.snapshots.CHANGES_KEPT", 2)
    t = table(spark, tmp_path / "t")
    for i in range(5):
        t.append(rows(spark, [(f"k{i}", i, 1, 1.0)]), {"load-id": f"l{i}"})
    assert t.snapshot().base and len(t.snapshot().changes) <= 2
    assert state(t.read()) == [(f"k{i}", 1) for i in range(5)] and state(t.read(2)) == [("k0", 1), ("k1", 1)]
    assert t.expire_snapshots(older_than=Clock.now + 10, retain_last=1) == 4 and t.versions() == [5]
    assert [t.find(load_id=f"l{i}").snapshot_id for i in range(5)] == [1, 2, 3, 4, 5] and t.find(load_id="l9") is None
    assert t.remove_orphans(older_than=4e9) == 0 and t.read().count() == 5


def test_additive_schema(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.append(rows(spark, [("a", 0, 1, 1.0)]).drop("business_version"))
    t.ensure(rows(spark, []).schema)
    assert t.read().filter("business_version IS NULL").count() == 1
    before = len(t.versions())
    t.ensure(rows(spark, []).schema)
    assert len(t.versions()) == before
    t.append(rows(spark, [("b", 0, 2, 1.0)]).withColumn("note", F.lit("x")).withColumn("amount", F.lit(None)))
    assert state(t.read()) == [("a", None), ("b", 2)] or {tuple(r) for r in t.read().select("order_id", "note").collect()} == {("a", None), ("b", "x")}
    with pytest.raises(TypeError):
        t.append(rows(spark, [("c", 0, 2, 1.0)]).withColumn("amount", F.lit("text")))


def test_losing_writer_tries_again_unless_it_had_read(spark, tmp_path):
    t, other = table(spark, tmp_path / "t"), table(spark, tmp_path / "t")
    t.append(rows(spark, [("a", 0, 1, 1.0)]))
    once = iter([True])

    def race():
        if next(once, False):
            other.append(rows(spark, [("b", 0, 1, 1.0)]))

    t.append(rows(spark, [("c", 0, 1, 1.0)]), before_commit=race)
    assert state(t.read()) == [("a", 1), ("b", 1), ("c", 1)]
    again = iter([True])

    def late():
        if next(again, False):
            other.append(rows(spark, [("d", 0, 1, 1.0)]))

    with pytest.raises(CommitConflict):
        t.replace_keys(rows(spark, [("a", 0, 2, 1.0)]), before_commit=late)
    assert state(t.read()) == [("a", 1), ("b", 1), ("c", 1), ("d", 1)]


def test_services(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    for i in range(4):
        t.append(rows(spark, [(f"k{i}", 0, 1, 1.0)]))
    before = sorted(tuple(r) for r in t.read().collect())
    pinned = t.snapshot().snapshot_id
    assert t.optimize(1 << 20).operation == "optimize"
    assert sorted(tuple(r) for r in t.read().collect()) == before and t.snapshot().summary["total-files"] == t.files().count() == 1
    assert t.optimize(1 << 20) is None
    assert t.read(pinned).count() == 4
    assert t.expire_snapshots(older_than=Clock.now + 10, retain_last=2) == 3
    assert len(t.versions()) == 2
    assert t.remove_orphans(older_than=4e9) == 0  # the retained snapshot still names the old files
    t.expire_snapshots(older_than=Clock.now + 10, retain_last=1)
    assert t.remove_orphans(older_than=0) == 0
    assert t.remove_orphans(older_than=4e9) == 4
    assert sorted(tuple(r) for r in t.read().collect()) == before
    t.overwrite(rows(spark, [("only", 0, 1, 1.0)]))
    assert state(t.read()) == [("only", 1)]
    t.truncate()
    assert t.read().count() == 0


def test_control_files(spark, tmp_path):
    path = str(tmp_path / "x" / "a.json")
    control.write_json(spark, path, {"a": 1}, exclusive=True)
    with pytest.raises(control.FileExists):
        control.write_json(spark, path, {"a": 2}, exclusive=True)
    control.write_json(spark, path, {"a": 3})
    assert control.read_json(spark, path) == {"a": 3} and len(control.list_files(spark, str(tmp_path / "x"))) == 1
    assert control.list_files(spark, str(tmp_path / "none")) == []
