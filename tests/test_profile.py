from __future__ import annotations

import datetime as dt
import math
import random
import re
from collections import Counter
from decimal import Decimal

import pytest

from tidemark.operators import profile

D = [dt.date(2020, 1, d) for d in (1, 2, 3)]
SCHEMA = "ingest_date date, kind string, amount decimal(12,2), n int, number double, value string"


def sample(seed, n=300):
    rng = random.Random(seed)
    return [(rng.choice(D), rng.choice([None, "", " \t", "card", "card", "card", "Boleto", "x" * 5000]), rng.choice([None, *[Decimal(v) / 100 for v in range(0, 900, 37)]]), rng.choice([None, 1, 2, 3, 50]), 0.5, "clash") for _ in range(n)]


def brute(rows, column, day, pattern=None):
    i = ["ingest_date", "kind", "amount", "n"].index(column)
    values = [r[i] for r in rows if r[0] == day]
    known = [v for v in values if v is not None]
    out = {"null_share": 1 - len(known) / len(values), "top_share": max(Counter(known).values(), default=0) / len(values), "distinct_count": len(set(known))}
    out["blank_share"] = sum(isinstance(v, str) and not v.strip(" \t") for v in known) / len(values)
    if pattern:
        out["pattern_share"] = sum(bool(re.fullmatch(pattern, v)) for v in known) / len(known)
    if column != "kind":
        out |= {"min_value": min(known), "max_value": max(known), "median_value": sorted(known)[(len(known) + 1) // 2 - 1]}
    return out


@pytest.mark.parametrize("splits", [2, 5, 64])
def test_profile_against_brute_force(spark, splits):
    rows = sample(splits)
    freq = profile.frequencies(spark.createDataFrame(rows, SCHEMA), "ingest_date", ["kind", "amount", "n"])
    medians = {(r.load_day, r.column_name): r.median_value for r in profile.lower_median(freq, splits).collect()}
    for r in profile.profile(freq, {"kind": "card|Boleto"}).collect():
        want = brute(rows, r.column_name, dt.date.fromisoformat(r.load_day), "card|Boleto" if r.column_name == "kind" else None)
        for metric, value in want.items():
            got = medians[r.load_day, r.column_name] if metric == "median_value" else r[metric]
            assert got == pytest.approx(float(value)), (r.column_name, metric)


def test_bounds_nulls_and_empty(spark, rows_of):
    rows = [(D[0], None, None, None, None, None), (D[1], "a", Decimal("9.00"), 1, None, None), (None, "a", Decimal("1.00"), 1, None, None)]
    profiled = profile.profile(profile.frequencies(spark.createDataFrame(rows, SCHEMA), "ingest_date"))
    baseline = spark.createDataFrame([("t", "amount", "max_value", None, 0.0, 5.0), ("t", "kind", "null_share", None, 0.0, 0.5), ("u", "kind", "null_share", None, 0.0, 0.1), ("t", "amount", "median_value", None, None, 4.0)], "table_name string, column_name string, metric string, value_pattern string, low_bound double, high_bound double")
    assert rows_of(profile.outside_baseline(profiled, "t", baseline)) == [("t", "amount", "max_value", "2020-01-02"), ("t", "amount", "median_value", "2020-01-02"), ("t", "kind", "null_share", "2020-01-01")]
    empty = profile.frequencies(spark.createDataFrame([], SCHEMA), "ingest_date")
    assert profile.profile(empty).count() == 0 and profile.load_drift(empty).count() == 0


def test_recount_takes_the_latest_run(spark, rows_of):
    items = spark.createDataFrame([("a", 1, "p", "s", D[0]), ("a", 1, "p", "s", D[0]), ("b", 1, None, "s", D[0]), (None, 1, "p", "s", D[0]), (None, 1, "p", "s", D[0]), ("a", 1, "p", "s", D[1])], "order_id string, order_item_id int, product_id string, seller_id string, ingest_date date")
    t = lambda h: dt.datetime(2020, 1, 4, h)
    runs = spark.createDataFrame(
        [("r1", "manual__2020-01-01T00", t(1), 0, 0), ("r2", "x__2020-01-01T00", t(5), 3, 2), ("r3", "s__2020-01-02T00", t(1), 0, 0), ("r4", "s__2020-01-03T00", t(1), None, 0), ("r5", None, t(9), 9, 9)],
        "run_id string, ingestion_run_id string, run_ts timestamp, null_key_rows int, duplicate_grain_rows int",
    )
    assert rows_of(profile.wrong_counts(runs, items)) == [("pipeline_runs", "duplicate_grain_rows", "recount", "2020-01-01"), ("pipeline_runs", "null_key_rows", "recount", "2020-01-03")]


def test_load_drift(spark):
    rows = [(D[0], "a", None, None, None, None)] * 8 + [(D[0], "b", None, None, None, None)] * 2 + [(D[1], "a", None, None, None, None)] * 5 + [(D[1], "b", None, None, None, None)] * 5
    r = profile.load_drift(profile.frequencies(spark.createDataFrame(rows, SCHEMA), "ingest_date", ["kind"])).collect()
    assert len(r) == 1 and r[0].degrees == 1
    assert r[0].psi == pytest.approx((0.5 - 0.8) * math.log(0.5 / 0.8) + (0.5 - 0.2) * math.log(0.5 / 0.2), abs=1e-6)
    assert r[0].chi_square == pytest.approx(2 * (1.5**2 / 6.5 + 1.5**2 / 3.5), abs=1e-6)


@pytest.mark.parametrize("splits", [2, 64])
def test_drift_of_many_values_is_measured_on_bins_of_the_earlier_load(spark, splits):
    rng = random.Random(9)
    cents = [sorted(Decimal(rng.randrange(100, 90000)) / 100 for _ in range(400)) for _ in range(3)]
    cents[2] = [v + 300 for v in cents[2]]  # the third load is shifted
    ids = lambda k, i: f"{k}{i:031x}" if k < 2 else f" ORDER-{i}"
    rows = [(D[k], ids(k, i), v, 1 + i % 3, None, None) for k in range(3) for i, v in enumerate(cents[k])] + [(D[1], None, None, 1, None, None)] * 40
    freq = profile.frequencies(spark.createDataFrame(rows, SCHEMA), "ingest_date", ["kind", "amount", "n"])
    edges = {r.load_day: r.edges for r in profile.rulers(freq, splits=splits).filter("column_name = 'amount'").collect()}
    for k in range(3):
        assert edges[str(D[k])] == [float(cents[k][math.ceil(400 * i / 10) - 1]) for i in range(1, 10)]
    got = {(r.column_name, r.load_day): r for r in profile.load_drift(freq, measures=profile.rulers(freq, splits=splits)).collect()}
    assert len(got) == 6
    for k in (1, 2):
        cell = lambda v: None if v is None else sum(e < float(v) for e in edges[str(D[k - 1])])  # noqa: E731, B023
        now, was = (Counter(cell(r[2]) for r in rows if r[0] == D[j]) for j in (k, k - 1))
        share = lambda c, x: max(c[x] / c.total(), 1e-6)
        r = got["amount", str(D[k])]
        assert r.degrees == len(now | was) - 1
        assert r.psi == pytest.approx(sum((share(now, x) - share(was, x)) * math.log(share(now, x) / share(was, x)) for x in now | was), abs=1e-5)
    assert got["amount", str(D[2])].psi > 1 and got["kind", str(D[2])].psi > 1
    assert got["n", str(D[1])].degrees == 2 and got["n", str(D[1])].psi < 0.02


def test_every_payment_column_is_registered(spark, tmp_path):
    from tidemark.plans.data_queries import QUERIES

    schema = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value decimal(12,2), ingest_date date"
    rows = [(f"o{d}{i}", 1, "card", 1 + i % 2, Decimal(i + 50 * d), D[d]) for d in (0, 1) for i in range(100)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/stg_order_payments.parquet")
    psi = {r.column_name: r.psi for r in QUERIES["p5_drift_all"](spark, str(tmp_path)).collect()}
    assert set(psi) == {"order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"}
    assert psi["payment_value"] > 1 and psi["payment_type"] == 0
