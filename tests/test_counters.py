from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from tidemark.operators import counters

SCHEMA = "order_id string, country string, amount decimal(14,2), event_time timestamp, kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint, part int, late string"
T = dt.datetime(2020, 1, 10)


def sample(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        arrived = T + dt.timedelta(minutes=rng.randrange(0, 20_000), seconds=rng.randrange(2))
        happened = rng.choice([None, arrived, arrived - dt.timedelta(hours=rng.randrange(60)), arrived + dt.timedelta(minutes=rng.choice([59, 60, 61, 5000])), dt.datetime(1970, 1, 1)])
        rows.append((rng.choice([None, f"o{i}"]), rng.choice(["AT", "at ", None, ""]), rng.choice([None, Decimal("2.50")]), happened, rng.choice([arrived, arrived, arrived, None]) if rng.random() < 0.2 else arrived, i % 3, i, 0, "x"))
    return rows


def brute(rows):
    high, late, taken = None, set(), []
    for r in sorted((r for r in rows if r[3] and r[4] and r[3] <= r[4] + dt.timedelta(hours=1)), key=lambda r: r[4:7]):
        if high is not None and r[3] < high - dt.timedelta(hours=36):
            late.add((r[0], str(r[3].date())))
        else:
            taken.append(r)
        high = r[3] if high is None else max(high, r[3])
    return late, taken


def test_cut_off_for_any_partitioning(spark, tmp_path):
    rows = sample(2, 500)
    late, taken = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for parts in (1, 4, 9):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = [tuple(r) for r in counters.late_rows(spark, df, str(tmp_path / f"p{parts}")).collect()]
            assert set(got) == late and len(got) == len(late)
            totals = {(r.event_day, r.country): (r.orders, r.amount) for r in counters.daily_totals(spark, df, str(tmp_path / f"t{parts}")).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
        want = {}
        for r in taken:
            key = (r[3].date(), (r[1] or "").strip().upper() or None)
            n, a = want.get(key, (0, Decimal(0)))
            want[key] = (n + 1, a + (r[2] or 0))
        assert totals == want


def test_equal_places_do_not_precede_each_other(spark, tmp_path):
    later = T + dt.timedelta(days=3)
    rows = [("a", "AT", Decimal(1), T, later, 0, 1, 0, ""), ("b", "AT", Decimal(1), later, later, 0, 1, 0, ""), ("c", "AT", Decimal(1), T, later, 0, 2, 0, "")]
    for order in (rows, rows[::-1]):
        got = counters.late_rows(spark, spark.createDataFrame(order, SCHEMA).coalesce(1), str(tmp_path / f"e{order[0][0]}"))
        assert [r.order_id for r in got.collect()] == ["c"]


def test_states_merge_idempotently(spark):
    rows = [(None, "AT", Decimal(i), T, T, i % 2, i, 0, "") for i in range(10)]
    full = counters.counter_states(spark.createDataFrame(rows, SCHEMA))
    part = counters.counter_states(spark.createDataFrame(rows[:6], SCHEMA))
    twice = counters.counter_states(spark.createDataFrame(rows + rows[:4], SCHEMA))
    value = lambda s: [tuple(r) for r in counters.counter_values(s).collect()]
    want = [(T.date(), "AT", 10, Decimal("45.00"))]
    assert value(full) == value(twice) == value(counters.merge_states(part, full, part)) == value(counters.merge_states(full, full)) == want


def test_shuffled_and_repeated_deltas(spark):
    rows = [(f"o{i}", ["AT", "DE"][i % 2], Decimal(i), T - dt.timedelta(days=i % 5), T, i % 3, i, 0, "") for i in range(120)]
    deltas = [counters.counter_states(spark.createDataFrame(rows[k * 20 : (k + 1) * 20], SCHEMA), k) for k in range(6)]
    value = lambda s: sorted(tuple(r) for r in counters.counter_values(s).collect())
    want = value(counters.counter_states(spark.createDataFrame(rows, SCHEMA)))
    upto = counters.compacted(counters.merge_states(*deltas[:4]), 3)
    rng = random.Random(5)
    for _ in range(3):
        some = [*deltas, *rng.sample(deltas, 3)]
        rng.shuffle(some)
        assert value(counters.merge_states(*some)) == want
        late = [upto, *some, counters.merge_states(upto, some[0])]
        rng.shuffle(late)
        assert value(counters.merge_states(*late)) == want
    assert value(counters.merge_states(upto, *deltas[4:])) == want


def test_batches_advance_the_store(spark, tmp_path):
    """Retries, rows that come again in a later batch, rows without a sequence number, late rows that correct a period."""
    rows = [(f"o{i}", "AT", Decimal(1), T + dt.timedelta(hours=i), T + dt.timedelta(hours=i), i % 2, i, 0, "") for i in range(60)]
    nameless = [("x", "AT", Decimal(1), T, T + dt.timedelta(hours=1), None, None, 0, "")] * 10
    late_but_in_time = ("y", "AT", Decimal(5), T + dt.timedelta(hours=30), T + dt.timedelta(hours=61), 0, 100, 0, "")
    too_late = ("z", "AT", Decimal(7), T + dt.timedelta(hours=1), T + dt.timedelta(hours=62), 0, 101, 0, "")
    frame = lambda rs: spark.createDataFrame(rs, SCHEMA)
    store = counters.CounterStore(spark, str(tmp_path / "s"))
    batches = [rows[:20] + nameless, rows[20:60], [late_but_in_time, too_late, *[(*r[:4], T + dt.timedelta(hours=63), *r[5:]) for r in rows[50:55]]]]
    for n, batch in enumerate(batches):
        store.apply(frame(batch), n)
        store.apply(frame(batch), n)  # a retry
    total = lambda: (lambda r: (r[0], r[1]))(store.totals().selectExpr("sum(orders)", "sum(amount)").first())
    assert total() == (60 + 10 + 1, Decimal(60 + 10 + 5)) and [r.order_id for r in store.late().collect()] == ["z"]
    day = {r.event_day: r.orders for r in store.totals().collect()}
    assert day[(T + dt.timedelta(hours=30)).date()] == 24 + 1
    store.compact()
    store.apply(frame(batches[1]), 1)
    assert total() == (71, Decimal(75))
    try:
        store.apply(frame(rows), 9)
    except ValueError:
        return
    raise AssertionError("a batch without those before it must be refused")


def test_empty(spark, tmp_path):
    assert counters.late_rows(spark, spark.createDataFrame([], SCHEMA), str(tmp_path / "e")).count() == 0
    assert counters.daily_totals(spark, spark.createDataFrame([], SCHEMA), str(tmp_path / "f")).count() == 0
