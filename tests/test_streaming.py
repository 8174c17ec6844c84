from __future__ import annotations

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import events
from tidemark.sources.snapshots import SnapshotTable
from tidemark.streaming import orders, topiclog


def event(order_id, version=1, customer="c", amount=10.0, country="UK", status="paid", at="2026-08-07T12:00:00+00:00", **more):
    return {"order_id": order_id, "customer": customer, "amount": amount, "country": country, "status": status, "event_time": at, "business_version": version, **more}


def messages(batch):
    return [(e.get("order_id") if isinstance(e, dict) else None, json.dumps(e) if isinstance(e, dict) else e) for e in batch]


def fixture():
    """101 events: clean ones, duplicates at several versions, defects, and two without an id."""
    names, countries, states = ["alice", "bob", "carol"], ["UK", "US", "ES"], ["paid", "created"]
    rows = [event(f"clean-{i:03d}", 1, names[i % 3], float(i % 9 + 1), countries[i % 3], states[i % 2]) for i in range(85)]
    for i in (1, 2, 3):
        rows += [event(f"dup-{i}", 1, "dave", 10.0), event(f"dup-{i}", 5, "erin", 30.0, status="delivered")]
    rows.append(event("dup-1", 3, "frank", 20.0, status="shipped"))
    rows += [event("bad-status-1", 1, amount=40.0, country="US", status="cancelled"), event("bad-status-2", 1, amount=41.0, country="US", status="cancelled"), event("neg-1", 1, amount=-5.0, country="ES"), event("neg-2", 1, amount=-10.0, country="ES")]
    rows += [event("null-amount", 1, amount=None, country="FR"), event("null-country", 1, amount=50.0, country=None), event("null-time", 1, amount=51.0, country="US", at=None)]
    return rows + [event(None), event(None)]


def test_end_to_end_and_restart(spark, tmp_path):
    log = topiclog.TopicWriter(str(tmp_path / "orders"), partitions=2)
    log.append(messages(fixture()))
    paths = orders.Paths(str(tmp_path / "out"))
    progress = orders.ProgressLog()
    spark.streams.addListener(progress)
    orders.run_available(spark, topiclog.messages(spark, str(tmp_path / "orders")), paths)
    landed = spark.read.parquet(paths.landing)
    assert len(fixture()) == 101 and landed.count() == 99
    assert spark.read.parquet(paths.dead_letter).groupBy("dead_letter_reason").count().collect()[0][:] == ("missing_order_id", 2)
    total = orders.receipts(spark, paths).agg(*[F.sum(c) for c in ("observed", "valid", "dead_letter")]).first()
    assert tuple(total) == (101, 99, 2)
    serving = SnapshotTable(spark, paths.serving, layout="bucket(16)")
    assert serving.read().count() == 95
    dup = serving.read().filter("order_id = 'dup-1'").first()
    assert (dup.business_version, float(dup.amount), dup.status) == (5, 30.0, "delivered")
    assert {r.country for r in spark.read.parquet(paths.totals).collect()} == {"UK", "US", "ES", "FR", "UNKNOWN"}
    versions_before = len(serving.versions())
    orders.run_available(spark, topiclog.messages(spark, str(tmp_path / "orders")), paths)  # nothing new
    assert spark.read.parquet(paths.landing).count() == 99 and len(serving.versions()) == versions_before
    log.append(messages([event("dup-1", 4, amount=1.0), event("dup-2", 6, amount=2.0), event("fresh", None), "{not-json"]))
    orders.run_available(spark, topiclog.messages(spark, str(tmp_path / "orders")), paths)
    state = {r.order_id: (r.business_version, float(r.amount)) for r in serving.read().filter("order_id IN ('dup-1', 'dup-2', 'fresh')").collect()}
    assert state == {"dup-1": (5, 30.0), "dup-2": (6, 2.0), "fresh": (None, 10.0)}
    assert spark.read.parquet(paths.dead_letter).count() == 3
    assert orders.receipts(spark, paths).agg(F.sum("observed")).first()[0] == 105
    spark.streams.removeListener(progress)
    assert not progress.failed and progress.frame(spark).filter("query = 'landing'").agg(F.sum("rows")).first()[0] >= 101


def test_batch_retry_changes_nothing(spark, tmp_path):
    paths = orders.Paths(str(tmp_path))
    raw = spark.createDataFrame([(json.dumps(event(f"k{i % 4}", i)), dt.datetime(2026, 1, 1), 0, i) for i in range(9)], "value string, timestamp timestamp, partition int, offset bigint")
    classified = events.classify(events.parse(raw))
    for _ in range(2):
        orders.serve(spark, paths, events.valid(classified), 7)
        orders.write_receipt(paths, classified, 7)
    table = SnapshotTable(spark, paths.serving, layout="bucket(16)")
    assert len(table.versions()) == 1 and table.read().count() == 4
    assert orders.receipts(spark, paths).first().observed == 9


def test_epoch_reasons_and_deduplication(spark, tmp_path):
    payload = '{"order_id":"a"}'
    good = hashlib.sha256(payload.encode()).hexdigest()
    line = {"source_epoch_id": "e1", "event_id": "1", "canonical_payload": payload, "canonical_payload_hash": good.upper()}
    cases = [({}, None), ({"source_epoch_id": None}, "missing_source_epoch_id"), ({"source_epoch_id": "e0"}, "source_epoch_mismatch"), ({"event_id": None}, "missing_event_id"), ({"canonical_payload": None}, "missing_canonical_lineage"), ({"canonical_payload_hash": "0" * 64}, "canonical_payload_hash_mismatch")]
    rows = [(json.dumps(event("a", **{**line, **change})), dt.datetime(2026, 1, 1), 0, i) for i, (change, _) in enumerate(cases)] + [(None, dt.datetime(2026, 1, 1), 0, 90), ("{not-json", dt.datetime(2026, 1, 1), 0, 91)]
    raw = spark.createDataFrame(rows, "value string, timestamp timestamp, partition int, offset bigint")
    got = {r.kafka_offset: r.dead_letter_reason for r in events.classify(events.parse(raw), "e1").collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(cases)} | {90: "invalid_json_or_schema", 91: "missing_order_id"}
    legacy = {r.kafka_offset: r.dead_letter_reason for r in events.classify(events.parse(raw)).collect()}
    assert legacy[5] == "canonical_payload_hash_mismatch" and legacy[1] is None

    log = topiclog.TopicWriter(str(tmp_path / "t"))
    log.append(messages([event("a", **line), event("a", **line), event("b", **{**line, "event_id": "2"})]))
    paths = orders.Paths(str(tmp_path / "out"), epoch="e1")
    orders.run_available(spark, topiclog.messages(spark, str(tmp_path / "t")), paths)
    log.append(messages([event("a", **line)]))
    orders.run_available(spark, topiclog.messages(spark, str(tmp_path / "t")), paths)
    assert spark.read.parquet(paths.landing).count() == 2
    assert paths.checkpoint_of("x").endswith("epoch=e1/x") and orders.Paths("r", checkpoint="c").checkpoint_of("x") == "c/x"


def test_lost_offsets_fail_loudly(spark, tmp_path):
    log = topiclog.TopicWriter(str(tmp_path / "t"))
    for i in range(3):
        log.append([("k", f"m{i}")])
    assert topiclog.messages(spark, str(tmp_path / "t"), streaming=False).count() == 3
    stream = topiclog.TopicStream({"path": str(tmp_path / "t")})
    start = stream.initialOffset()
    log.drop_before(0, 2)
    with pytest.raises(topiclog.DataLoss):
        stream.partitions(start, stream.latestOffset())
    lenient = topiclog.TopicStream({"path": str(tmp_path / "t"), "failOnDataLoss": "false", "maxOffsetsPerTrigger": "1"})
    assert [(s.start, s.end) for s in lenient.partitions(start, lenient.latestOffset())] == [(2, 3)]
    log.append([("k", "m3"), ("k", "m4")])
    assert lenient.latestOffset() == {"0": 4}  # one offset per trigger


def test_throttle_from_the_first_trigger_and_after_a_restart(spark, tmp_path):
    log = topiclog.TopicWriter(str(tmp_path / "t"), partitions=2)
    log.append([(None, f"m{i}") for i in range(40)])
    options = {"path": str(tmp_path / "t"), "maxOffsetsPerTrigger": "10", "progressFile": str(tmp_path / "progress.json")}
    stream = topiclog.TopicStream(options)
    assert stream.latestOffset() == {"0": 5, "1": 5}  # shared out, not the low partition first
    assert topiclog.TopicStream(options).latestOffset() == {"0": 10, "1": 10}  # a restart goes on from there
    assert topiclog._shared_out({"0": 7, "1": 1, "2": 0}, 4) == {"0": 4, "1": 0, "2": 0} and topiclog._shared_out({"0": 2}, 4) == {"0": 2}
