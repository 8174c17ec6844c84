from __future__ import annotations

import datetime as dt
import random

from tidemark.operators import lsm

SCHEMA = "change_op string, order_id string, business_version bigint, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp_ntz, customer string, amount double, country string, status string"
T = dt.datetime(2020, 1, 1)


def change(op, key, version, offset, customer="c", amount=1.0):
    return (op, key, version, 0, offset, T, customer, amount, None, None)


def brute(changes):
    best = {}
    for c in changes:
        if c[1] is None:
            continue
        rank = (c[2] is not None, c[2] or 0, c[4] is not None, c[4] or 0)
        if c[1] not in best or rank > best[c[1]][0]:
            best[c[1]] = (rank, c)
    return {(k, c[2], c[4]) for k, (_, c) in best.items() if (c[0] or "").lower() not in ("d", "delete")}


def feed(seed, n):
    rng = random.Random(seed)
    ops = ["c", "I", "r", "insert", "u", "Update", "d", "DELETE"]
    rows = [change(rng.choice(ops), f"k{rng.randrange(n // 6)}", rng.choice([None, *range(5)]), i) for i in range(n)]
    rows += rng.sample(rows, n // 5)  # repeated
    rng.shuffle(rows)
    return rows


def state(df):
    return {(r.order_id, r.business_version, r.kafka_offset) for r in df.collect()}


def test_runs_in_any_order_and_compaction(spark, tmp_path):
    rows = feed(1, 300)
    for name, parts in (("a", [rows]), ("b", [rows[:100], rows[100:250], rows[250:]]), ("c", [rows[200:], rows[:200]])):
        table = lsm.order_change_table(spark, str(tmp_path / name))
        for i, part in enumerate(parts):
            table.append(spark.createDataFrame(part, SCHEMA), run=f"r{i}")
        assert state(table.read()) == brute(rows)
        table.compact()
        assert len(table.live_runs()) == 1
        assert state(table.read()) == brute(rows)
        table.append(spark.createDataFrame(parts[0], SCHEMA), run="r0")  # a retry after compaction adds nothing
        assert len(table.live_runs()) == 1


def test_tombstone_survives_until_older_changes_cannot_come(spark, tmp_path):
    table = lsm.order_change_table(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([change("delete", "k", 5, 9)], SCHEMA), run="late")
    table.compact()
    table.append(spark.createDataFrame([change("u", "k", 4, 3)], SCHEMA), run="early")
    assert table.read().count() == 0


def test_stream_of_files(spark, tmp_path):
    rows = feed(2, 240)
    source = str(tmp_path / "feed.parquet")
    spark.createDataFrame(rows[:160], SCHEMA).repartition(4).write.parquet(source)
    table = lsm.apply_feed(spark, source, str(tmp_path / "work"), compact_after=3, max_files=1)
    assert state(table.read()) == brute(rows[:160])
    spark.createDataFrame(rows[160:], SCHEMA).write.mode("append").parquet(source)
    table = lsm.apply_feed(spark, source, str(tmp_path / "work"), compact_after=3, max_files=1)
    assert state(table.read()) == brute(rows)


def test_nulls_ties_extra_columns_and_empty(spark, tmp_path):
    schema = SCHEMA + ", key string, __extra int"
    rows = [(*change("u", None, 1, 1), "x", 1), (*change(None, "a", None, None), None, None), (*change("u", "b", 1, 1, "x"), "x", 2), (*change("u", "b", 1, 1, "y"), "x", 1)]
    table = lsm.LsmTable(spark, str(tmp_path / "t"), "order_id", ["business_version", "kafka_offset"], lsm.is_delete(), buckets=2)
    table.append(spark.createDataFrame(rows, schema))
    assert {(r.order_id, r.customer) for r in table.read().collect()} == {("a", "c"), ("b", "y")}
    empty = str(tmp_path / "none.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(empty)
    assert lsm.apply_feed(spark, empty, str(tmp_path / "w")).read().count() == 0


def test_runs_are_merged_bucket_by_bucket(spark, tmp_path):
    rows = feed(4, 400)
    table = lsm.order_change_table(spark, str(tmp_path / "t"))
    for i in range(4):
        table.append(spark.createDataFrame(rows[i * 120 : (i + 1) * 120], SCHEMA), run=f"batch-{i:09d}")
    merged = table.merged()
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.count() == merged.select("order_id").distinct().count() and state(table.read()) == brute(rows)
    table.settle(2)  # levels: 4 runs of level 0, 2 of level 1, 1 of level 2
    assert [r["level"] for r in table._manifest()["runs"]] == [1] or len(table.live_runs()) == 1
    assert state(table.read()) == brute(rows)
    table.append(spark.createDataFrame(rows[:120], SCHEMA), run="batch-000000002")  # a retry after compaction adds nothing
    assert len(table.live_runs()) == 1
