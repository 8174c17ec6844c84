from __future__ import annotations

import datetime as dt
import random

from tidemark.operators import dedup

SCHEMA = "event_id string, canonical_payload_hash string, kafka_timestamp timestamp_ntz, kafka_partition int, kafka_offset bigint, n int, kept string"
T = dt.datetime(2020, 1, 1)


def sample(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = f"e{rng.randrange(n // 3)}"
        rows.append((rng.choice([key, key.upper(), f" {key}\t", None if rng.random() < 0.1 else key]), rng.choice(["h1", "H1 ", "h2", None, ""]), rng.choice([None, *[T + dt.timedelta(hours=rng.randrange(200)) for _ in range(9)]]), i % 3, i, 1, "x"))
    return rows + rng.sample(rows, n // 6)


def brute(rows):
    by = {}
    for r in rows:
        key = (r[0] or "").strip(" \t").lower()
        if key:
            by.setdefault((key, (r[1] or "").strip(" \t").lower()), []).append((r[2] is None, r[2] or T, r[3], r[4]))
    return {k: (len(v), min(v)[2:]) for k, v in by.items()}


def found(messages):
    return {(r.event_id, r.canonical_payload_hash): (r.n, (r.kept.kafka_partition, r.kept.kafka_offset)) for r in messages.collect()}


def test_batches_in_any_order_with_expiry(spark, tmp_path):
    rows = sample(1, 240)
    want = brute(rows)
    for name, cuts in (("one", [240]), ("many", [30, 90, 100, 200])):
        store = dedup.SeenStore(spark, str(tmp_path / name), "1 day")
        bounds = [0, *cuts, len(rows)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            store.apply(spark.createDataFrame(rows[a:b], SCHEMA), i)
        assert found(store.messages()) == want
        last = len(cuts)
        store.apply(spark.createDataFrame(rows[bounds[-2] :], SCHEMA), last)  # a retry replaces its own batch
        assert found(store.messages()) == want
        assert {(r.event_id, r.canonical_payload_hash) for r in dedup.kept_copies(store.messages(), repeated_only=True).collect()} == {k for k, (n, _) in want.items() if n > 1}


def test_state_expires_and_late_copies_are_looked_up(spark, tmp_path):
    at = lambda h: T + dt.timedelta(hours=h)
    store = dedup.SeenStore(spark, str(tmp_path / "s"), "1 day")
    batches = [[("a", "h", at(0), 0, 1, 1, "")], [("b", "h", at(100), 0, 2, 1, "")], [("c", "h", at(101), 0, 3, 1, "")], [("a", "h", at(0), 0, 1, 1, ""), ("b", "h", at(102), 0, 5, 1, "")], [("a", "h", at(103), 0, 9, 1, "")]]
    for i, rows in enumerate(batches):
        store.apply(spark.createDataFrame(rows, SCHEMA), i)
        if i == 2:
            assert {r.event_id for r in store.live().collect()} == {"b", "c"}  # a has left the live state
    assert found(store.messages()) == {("a", "h"): (3, (0, 1)), ("b", "h"): (2, (0, 2)), ("c", "h"): (1, (0, 3))}


def test_stream_and_one_copy(spark, tmp_path):
    rows = sample(3, 90)
    source = str(tmp_path / "in.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(source)
    store = dedup.dedup_stream(spark, source, str(tmp_path / "w"), max_files=1)
    assert found(store.messages()) == brute(rows)
    kept = dedup.one_copy(spark.createDataFrame(rows, SCHEMA), store.messages())
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert kept.count() == len(brute(rows)) + sum(not (r[0] or "").strip(" \t") for r in rows)


def test_empty(spark, tmp_path):
    source = str(tmp_path / "in.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    store = dedup.dedup_stream(spark, source, str(tmp_path / "w"))
    assert dedup.kept_copies(store.messages()).count() == 0


def test_crowded_levels_and_a_batch_that_failed(spark, tmp_path, monkeypatch):
    rows = sample(7, 200)
    store = dedup.SeenStore(spark, str(tmp_path / "s"), "1 day", fanout=2)
    write = dedup.control.write_json
    for i in range(8):
        batch = spark.createDataFrame(rows[i * 25 : (i + 1) * 25] if i < 7 else rows[175:], SCHEMA)
        if i in (2, 5):  # fails after its run is written, before it counts

            def fail(*a, **k):
                raise OSError("lost")

            monkeypatch.setattr(dedup.control, "write_json", fail)
            try:
                store.apply(batch, i)
            except OSError:
                monkeypatch.setattr(dedup.control, "write_json", write)
        store.apply(batch, i)
        assert found(dedup.SeenStore(spark, str(tmp_path / "s")).messages()) == brute(rows[: (i + 1) * 25] if i < 7 else rows)
    assert len(store.state()["live"]) + len(store.state()["ledger"]) < 8


def test_lookups_move_no_run(spark, tmp_path):
    """The plan of a merge of runs has no exchange over them."""
    store = dedup.SeenStore(spark, str(tmp_path / "s"))
    rows = sample(9, 120)
    for i in range(3):
        store.apply(spark.createDataFrame(rows[i * 40 : (i + 1) * 40], SCHEMA), i)
    assert "Exchange" not in store.messages()._jdf.queryExecution().sparkPlan().toString() + store.messages()._jdf.queryExecution().executedPlan().toString()
