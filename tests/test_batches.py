"""The registered queries of problems 2 and 6 go through several batches."""

from __future__ import annotations

import datetime as dt

from tidemark.operators import dedup, lsm
from tidemark.plans import data_queries


def test_p2_merges_and_compacts_runs(spark, tmp_path, monkeypatch):
    schema = "change_op string, order_id string, business_version bigint, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp_ntz, customer string, amount double, country string, status string"
    rows = [("d" if v == 9 and k % 5 == 0 else "u", f"o{k}", v, 0, v * 100 + k, None, "c", 1.0, "DE", "new") for v in range(10) for k in range(60)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/order_changes.parquet")
    runs, compactions = [], []
    append, compact = lsm.LsmTable.append, lsm.LsmTable.compact
    monkeypatch.setattr(lsm.LsmTable, "append", lambda self, *a, **k: runs.append(1) or append(self, *a, **k))
    monkeypatch.setattr(lsm.LsmTable, "compact", lambda self, *a, **k: compactions.append(1) or compact(self, *a, **k))
    found = {tuple(r) for r in data_queries.p2_found(spark, str(tmp_path)).collect()}
    assert found == {(f"o{k}", 9, 900 + k) for k in range(60) if k % 5}
    assert len(runs) > 8 and compactions


def test_p6_merges_state_over_batches(spark, tmp_path, monkeypatch):
    schema = "event_id string, canonical_payload_hash string, kafka_timestamp timestamp_ntz, kafka_partition int, kafka_offset bigint"
    at = lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(hours=i)
    rows = [(f"e{i % 150}", "h", at(i), 0, i) for i in range(200)] + [(None, "h", at(3), 0, 900)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/bronze_orders.parquet")
    batches, apply = [], dedup.SeenStore.apply
    monkeypatch.setattr(dedup.SeenStore, "apply", lambda self, batch, number: batches.append(number) or apply(self, batch, number))
    found = sorted(tuple(r) for r in data_queries.p6_found(spark, str(tmp_path)).collect())
    assert found == sorted((f"e{i}", "h", 0, i) for i in range(50))
    assert len(batches) > 2
