from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import orphans

D = [dt.date(2020, 1, d) for d in range(1, 10)]
ORDERS = "order_id string, customer_id string, ingest_date date, key string, day string"  # with columns whose names clash
ITEMS = "order_id string, order_item_id int, ingest_date date, salt int"
CUSTOMERS = "customer_id string, ingest_date date, n int"
REMOVED = "table_name string, key_value string, removed_on date"


def brute(orders, items, customers, removed):
    plain = lambda x: (x or "").strip(" \t").lower()

    def exists(table, rows, key, day):
        events = [(d, 1) for k, d in rows if plain(k) == key and d <= day] + [(d, 0) for t, k, d in removed if t == table and plain(k) == key and d <= day]
        return bool(events) and max(events)[1] == 1

    out = set()
    for o, i, d, *_ in items:
        if plain(o) and not exists("stg_orders", [(r[0], r[2]) for r in orders], plain(o), d):
            out.add(("stg_order_items", plain(o), i, str(d)))
    for o, c, d, *_ in orders:
        if plain(c) and not exists("stg_customers", [(r[0], r[1]) for r in customers], plain(c), d):
            out.add(("stg_orders", plain(o) if o is not None else None, 0, str(d)))
    return out


def tables(spark, orders, items, customers, removed):
    return [spark.createDataFrame(d, s) for d, s in ((orders, ORDERS), (items, ITEMS), (customers, CUSTOMERS), (removed, REMOVED))]


def test_against_brute_force(spark):
    rng = random.Random(3)
    spell = lambda k: rng.choice([k, k.upper(), f" {k}\t", f"\t{k}"])
    orders = [(spell(f"o{rng.randrange(12)}"), rng.choice([None, "", " \t", *[spell(f"c{i}") for i in range(8)]]), rng.choice(D), "x", "y") for _ in range(60)]
    items = [(rng.choice([None, " ", *[spell(f"o{i}") for i in range(14)]]), rng.choice([None, 1, 2]), rng.choice(D), 0) for _ in range(120)]
    customers = [(spell(f"c{rng.randrange(7)}"), rng.choice(D), 0) for _ in range(12)]
    days = {("stg_orders", o[0].strip().lower(), o[2]) for o in orders} | {("stg_customers", c[0].strip().lower(), c[1]) for c in customers}
    removed = [r for r in ((t, k, d) for t, k in [*[("stg_orders", f"o{i}") for i in range(15)], *[("stg_customers", f"c{i}") for i in range(9)]] for d in rng.sample(D, 2)) if r not in days]
    removed = [(t, spell(k), d) for t, k, d in removed] * 2  # notices repeated
    got = [tuple(r) for r in orphans.find_orphans(*tables(spark, orders, items, customers, removed)).collect()]
    assert set(got) == brute(orders, items, customers, removed)
    assert len(got) == len(set(got))
    counts = orphans.orphan_counts(*tables(spark, orders, items, customers, removed)).collect()
    assert sum(r.orphan_rows for r in counts) >= len(got)


def test_runs_are_contiguous_spans(spark, rows_of):
    rows = spark.createDataFrame([("K ", D[0]), ("k", D[2]), ("k", D[6]), (None, D[0]), ("", D[1]), ("z", None)], "k string, d date")
    gone = spark.createDataFrame([("x", "k", D[4]), ("x", "k", D[5])], REMOVED)
    runs = orphans.existence_runs(rows, "k", "d", gone)
    first = (D[0] - dt.date(1970, 1, 1)).days
    assert rows_of(runs) == sorted([("k", first, first + 3), ("k", first + 6, orphans.OPEN_END)], key=repr)


def test_integer_runs(spark, rows_of):
    keys = spark.createDataFrame([(k,) for k in [5, 6, 7, 7, 9, None, -1, 0, 1, 20]], "k bigint")
    assert rows_of(orphans.compress_integers(keys, "k")) == sorted([(-1, -1), (0, 1), (5, 7), (9, 9), (20, 20)], key=repr)


def test_hot_key_and_empty_tables(spark):
    many = [("hot", i % 3, D[1], i) for i in range(3000)]
    found = orphans.find_orphans(*tables(spark, [], many, [], []))
    assert {tuple(r) for r in found.collect()} == {("stg_order_items", "hot", i, "2020-01-02") for i in range(3)}
    assert orphans.find_orphans(*tables(spark, [], [], [], [])).count() == 0
    groups = orphans.orphan_groups(spark.createDataFrame([("a", 1)] * 5, "key string, day int"), spark.createDataFrame([], "key string, run_start int, run_end int"))
    assert [tuple(r) for r in groups.collect()] == [("a", 1, 5)]
    assert orphans.orphan_rows(spark.createDataFrame([("a", 1, 7)] * 4, "key string, day int, v int"), groups).agg(F.count("v")).first()[0] == 4
