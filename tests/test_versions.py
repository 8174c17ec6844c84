from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality, versions

SCHEMA = "order_id string, customer string, amount double, country string, status string, event_time timestamp, kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint, event_date date, business_version bigint"
T = dt.datetime(2026, 1, 1)


def row(key, version, amount=1.0, partition=0, offset=0, customer="c", day=1, status="paid"):
    return (key, customer, None if amount is None else float(amount), "UK", status, T, T, partition, offset, dt.date(2026, 1, day), version)


def df(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def state(rows):
    return sorted(((r.order_id, r.business_version, r.amount) for r in rows.collect()), key=repr)


def test_version_decides_not_offset(spark):
    rows = df(spark, row("a", 1, 10, 0, 1), row("a", 5, 20, 1, 1), row("a", 3, 30, 0, 99), row("b", 3, 30, 2, 3), row("n", None, 1, 0, 5), row("n", None, 2, 0, 4), row(None, 1), row(None, 2))
    assert state(versions.latest_version(rows)) == sorted([("a", 5, 20.0), ("b", 3, 30.0), ("n", None, 2.0), (None, 2, 1.0)], key=repr)
    assert versions.latest_version(rows).columns == rows.columns and versions.latest_version(rows).schema == rows.schema
    assert versions.latest_version(df(spark)).count() == 0


def test_blend_mixes_versions(spark):
    rows = df(spark, row("a", 5, None, customer=None), row("a", 1, 1.0, customer="low"))
    r = versions.latest_blended(rows).first()
    assert (r.business_version, r.customer, r.amount) == (5, "low", 1.0)
    found = [tuple(x) for x in versions.compare_states(versions.latest_blended(rows), versions.latest_version(rows)).collect()]
    assert found == [("a", "payload_mismatch", "", "customer,amount")]


@pytest.mark.parametrize(("current", "incoming", "result"), [
    ([("a", 1, 10)], [("a", 2, 20)], [("a", 2, 20.0)]),
    ([("a", 5, 50)], [("a", 3, 30)], []),
    ([("a", 5, 50)], [("a", 5, 50)], []),
    ([("a", 5, 50)], [("a", 5, 51), ("b", 1, 1)], versions.VersionConflict),
    ([], [("a", 3, 3), ("a", 5, 5), ("b", 2, 2)], [("a", 5, 5.0), ("b", 2, 2.0)]),
    ([], [("a", 3, 3), ("a", 3, 4), ("a", 5, 5)], versions.VersionConflict),
    ([], [(None, 1, 1)], ValueError), ([], [("", 1, 1)], ValueError), ([], [("a", None, 1)], ValueError),
])
def test_resolution(spark, current, incoming, result):
    now, new = df(spark, *[row(*r) for r in current]), df(spark, *[row(*r) for r in incoming])
    if isinstance(result, type):
        with pytest.raises(result):
            versions.resolve(now, new)
    else:
        assert state(versions.resolve(now, new)) == result


def test_replay_ignores_transport_and_nulls_compare_equal(spark):
    now = df(spark, row("a", 5, None, 0, 1, customer=None))
    assert versions.resolve(now, df(spark, row("a", 5, None, 3, 77, customer=None))).count() == 0
    assert versions.conflicts(df(spark, row("a", 5, float("nan")), row("a", 5, float("nan"), 1, 2))).count() == 0


def test_merge(spark):
    target, source = df(spark, row("a", 1, 1), row("b", None, 2), row(None, 1, 3)), df(spark, row("a", 1, 9), row("b", 1, 9), row("c", None, 9), row(None, 2, 9))
    assert state(versions.conditional_merge(target, source, versions.newer_version())) == sorted([("a", 1, 1.0), ("b", 1, 9.0), ("c", None, 9.0), (None, 1, 3.0), (None, 2, 9.0)], key=repr)
    with pytest.raises(ValueError):
        versions.conditional_merge(target, df(spark, row("a", 1), row("a", 2)), versions.newer_version())
    batch = versions.newest_in_batch(df(spark, row("a", 2, 1, offset=1), row("a", 2, 2, offset=9), row("a", 2, 3, offset=None), row("a", None, 4, offset=99)))
    assert state(batch) == [("a", 2, 3.0)]  # an unknown offset sorts first in descending order


def test_shadow_kinds(spark):
    left = df(spark, row("same", 1, 1, 0, 1), row("ver", 1), row("pay", 1, 1), row("only-left", 1), row("dup", 1), row("dup", 1, 5))
    right = df(spark, row("same", 1, 1, 7, 70), row("ver", 2), row("pay", 1, 2), row("only-right", 1), row("dup", 1))
    got = sorted((r.order_id, r.mismatch_type, r.side) for r in versions.compare_states(left, right).collect())
    assert got == [("dup", "duplicate_business_key", "left"), ("only-left", "missing_in_right", ""), ("only-right", "missing_in_left", ""), ("pay", "payload_mismatch", ""), ("ver", "business_version_mismatch", "")]


def test_quality(spark):
    bad = df(spark, row(None, 1), row("a", 1, None), row("a", 1, 0.0), row("a", 1, -1.0), row("a", 1, status="teleported"), row("a", 1, status=None), row("ok", 1))
    bad = bad.withColumn("country", F.when(F.col("order_id") == "ok", F.lit(None)).otherwise(F.col("country"))).withColumn("event_time", F.when(F.col("order_id") == "ok", F.lit(None)).otherwise(F.col("event_time")))
    want = {"order_id_null": 1, "amount_null_or_nonpositive": 3, "status_invalid": 2, "country_null": 1, "event_time_null": 1}
    assert {r["rule"]: r["violations"] for r in quality.violations(bad).collect()} == want
    assert "amount_null_or_nonpositive" not in {r["rule"] for r in quality.violations(bad.drop("amount")).collect()}
    assert quality.publish_gate(bad, strict=False) == want
    with pytest.raises(ValueError):
        quality.publish_gate(bad, strict=True)
    assert quality.expect_not_null(bad, "order_id").count() == 1 and quality.expect_unique(bad, "order_id").first().copies == 5
    assert [tuple(r) for r in quality.expect_accepted(bad, "status", ("paid",)).collect()] == [("teleported", 1)]
    assert quality.expect_same_rows(bad, bad).count() == 0 and quality.same_multiset(bad, bad) and not quality.same_multiset(bad, bad.union(bad))
