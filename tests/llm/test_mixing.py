from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tidemark.llm import mixing

SIZES = "doc_id bigint, n_tokens bigint, sources array<string>, pattern int, uses int"
TARGETS = "source string, target_share double, max_repeats int"


def test_flow_meets_quotas_at_least_cost():
    patterns = {("a",): 100, ("a", "b"): 100, ("b",): 50}
    routes = mixing.route(patterns, {"a": 0.6, "b": 0.4}, {"a": 2, "b": 2}, 250)
    assert sum(r["a"] for r in routes.values() if "a" in r) == 150 and sum(r["b"] for r in routes.values() if "b" in r) == 100
    assert all(sum(r.values()) <= patterns[k] for k, r in routes.items())  # once each is enough, so nothing is repeated
    assert mixing.route(patterns, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 1}, 400) is None
    total, _ = mixing.best_route({("a",): 100, ("b",): 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 3}, None)
    assert total == pytest.approx(60, abs=2)


def mixed(spark, docs, targets, **options):
    sizes = spark.createDataFrame([(i, n, s, 7, 7) for i, (n, s) in enumerate(docs)], SIZES)
    return [tuple(r) for r in mixing.mix(sizes, spark.createDataFrame(targets, TARGETS), **options).collect()]


@pytest.mark.parametrize("buckets", [1, 16, 16_384])
def test_shares_and_caps(spark, buckets):
    rng = random.Random(3)
    targets = [("a", 0.5, 2), ("b", 0.3, 3), ("c", 0.2, 5)]
    docs = [(rng.randrange(0, 60), rng.choice([["a"]] * 8 + [["b"], ["b"], ["c"], ["a", "b"], ["x"], [], None, ["b", "c"]])) for _ in range(3000)]
    got = mixed(spark, docs, targets, buckets=buckets)
    tokens, uses = defaultdict(int), defaultdict(int)
    for doc, source, n, u in got:
        if u:
            assert source in docs[doc][1]
            tokens[source] += n * u
            uses[doc] += u
    whole = sum(tokens.values())
    for source, share, _ in targets:
        assert tokens[source] / whole == pytest.approx(share, abs=0.005)
    cap = {s: m for s, _, m in targets}
    assert all(u <= min(cap[s] for s in docs[d][1] if s in cap) for d, u in uses.items())
    assert {d for d, *_ in got} == set(range(len(docs)))
    assert sorted(got, key=repr) == sorted(mixed(spark, docs, targets, buckets=buckets), key=repr)
    if buckets == 16:
        assert sorted(got, key=repr) != sorted(mixed(spark, docs, targets, buckets=buckets, seed=1), key=repr)


def test_repeats_are_even(spark):
    got = mixed(spark, [(10, ["a"])] * 50 + [(10, ["b"])] * 500, [("a", 0.5, 4), ("b", 0.5, 4)], wanted=2000)
    per = defaultdict(set)
    for _, source, _, u in got:
        per[source].add(u)
    assert per == {"a": {2}, "b": {1}, None: {0}}  # 1000 tokens each, of 500 and of 5000
    assert sum(n * u for _, s, n, u in got if s == "b") == 1000


def test_empty_and_no_target(spark):
    assert mixed(spark, [], [("a", 1.0, 1)]) == []
    assert mixed(spark, [(5, ["a"])], [("a", 0.0, 1), (None, 1.0, 1)]) == [(0, None, 5, 0)]


def test_report(spark):
    df = spark.createDataFrame([(1, "a", 10, 2), (2, "b", 20, 1), (3, None, 5, 0)], "doc_id bigint, source string, n_tokens bigint, uses int")
    rows = {r.source: r for r in mixing.shares_reached(df, spark.createDataFrame([("a", 0.5, 2), ("b", 0.4, 1), ("c", 0.1, 1)], TARGETS)).collect()}
    assert rows["a"].share == 0.5 and rows["b"].most_uses == 1 and rows["c"].tokens == 0


def test_a_source_without_documents_comes_out_short(spark):
    targets = [("a", 0.6, 2), ("b", 0.3, 2), ("none", 0.1, 4)]
    docs = [(10, ["a"])] * 500 + [(10, ["b"])] * 500 + [(10, ["x"])] * 100
    sizes, wanted = spark.createDataFrame([(i, n, s, 7, 7) for i, (n, s) in enumerate(docs)], SIZES), spark.createDataFrame(targets, TARGETS)
    rows = {r.source: r for r in mixing.shares_reached(mixing.mix(sizes, wanted), wanted, mixing.wanted_tokens(sizes, wanted)).collect()}
    assert {s: (r.tokens, r.quota_tokens, r.short_tokens) for s, r in rows.items()} == {"a": (6000, 6000, 0), "b": (3000, 3000, 0), "none": (0, 1000, 1000)}


def test_a_source_at_its_cap_leaves_the_others_their_quotas(spark):
    targets = [("a", 0.5, 2), ("b", 0.4, 2), ("few", 0.1, 3)]
    docs = [(10, ["a"])] * 500 + [(10, ["b"])] * 490 + [(10, ["few"])] * 10
    got = mixed(spark, docs, targets)
    tokens = defaultdict(int)
    for _, source, n, u in got:
        tokens[source] += n * u
    assert tokens["a"] == 5000 and tokens["b"] == 4000 and tokens["few"] == 300
    assert {u for _, s, _, u in got if s == "few"} == {3}


def test_sources_that_share_too_few_documents_come_out_short_alike():
    routes = mixing.fullest_route({("a", "b"): 100, ("c",): 900}, {"a": 0.2, "b": 0.2, "c": 0.6}, {"a": 2, "b": 2, "c": 2})
    assert routes["a", "b"] == {"a": pytest.approx(100, abs=2), "b": pytest.approx(100, abs=2)} and routes["c",] == {"c": 600}


def test_held_sources_add_up_to_the_greatest_flow():
    rng = random.Random(8)
    for _ in range(40):
        names = "abcde"[: rng.randrange(2, 6)]
        patterns = {tuple(sorted(rng.sample(names, rng.randrange(1, len(names) + 1)))): rng.randrange(1, 400) for _ in range(5)}
        weights = {s: rng.random() + 0.05 for s in names}
        shares, repeats = {s: w / sum(weights.values()) for s, w in weights.items()}, {s: rng.randrange(1, 4) for s in names}
        quota = {s: int(shares[s] * sum(patterns.values())) for s in names}
        greatest = sum(sum(r.values()) for r in mixing._send(patterns, quota, repeats)[0].values())
        routes = mixing.fullest_route(patterns, shares, repeats)
        assert abs(sum(sum(r.values()) for r in routes.values()) - greatest) <= len(names)
        assert all(sum(r.get(s, 0) for r in routes.values()) <= quota[s] for s in names)
        assert all(sum(r.values()) <= patterns[k] * min(repeats[s] for s in k) for k, r in routes.items())


def test_more_than_ten_thousand_sets_of_sources(spark):
    """Fourteen sources that overlap in 10,001 ways: no cap, every quota filled."""
    names = [f"s{i:02d}" for i in range(14)]
    sets = [[n for j, n in enumerate(names) if (i >> j) & 1] for i in range(1, 10_002)]
    targets = [(n, 1 / 14, 2) for n in names]
    sizes = spark.createDataFrame([(i, 5 + i % 7, s, 7, 7) for i, s in enumerate(sets)], SIZES)
    wanted = sum(5 + i % 7 for i in range(10_001)) // 2
    tokens = {r.source: r.t for r in mixing.mix(sizes, spark.createDataFrame(targets, TARGETS), wanted=wanted).filter("uses > 0").groupBy("source").agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "t").collect()}
    assert set(tokens) == set(names) and all(abs(t - wanted / 14) < 0.05 * wanted for t in tokens.values())


def test_flow_equals_that_of_single_paths():
    """Cost and size against flow sent token by token along cheapest paths."""
    rng = random.Random(4)
    for _ in range(60):
        names = "abcd"[: rng.randrange(1, 5)]
        patterns = {tuple(sorted(rng.sample(names, rng.randrange(1, len(names) + 1)))): rng.randrange(1, 6) for _ in range(4)}
        repeats, quota = {s: rng.randrange(1, 4) for s in names}, {s: rng.randrange(0, 9) for s in names}

        def build():
            net, keys = mixing.FlowNetwork(2 + len(patterns) + len(names)), sorted(patterns)
            for i, key in enumerate(keys):
                for use in range(min(repeats[s] for s in key)):
                    net.connect(0, 2 + i, patterns[key], use)
                for s in key:
                    net.connect(2 + i, 2 + len(keys) + names.index(s), patterns[key] * repeats[s], 0)
            for j, s in enumerate(names):
                net.connect(2 + len(keys) + j, 1, quota[s], 0)
            return net

        def by_paths(net):
            flow = cost = 0
            while True:
                far, came = {0: 0}, {}
                for _ in net.edges:  # cheapest paths, edge by edge
                    for node, edges in enumerate(net.edges):
                        for e in edges:
                            if node in far and e.room > 0 and far[node] + e.cost < far.get(e.to, 99):
                                far[e.to], came[e.to] = far[node] + e.cost, (node, e)
                if 1 not in far:
                    return flow, cost
                flow, cost, node = flow + 1, cost + far[1], 1
                while node:
                    before, e = came[node]
                    e.room -= 1
                    net.edges[node][e.back].room += 1
                    node = before

        assert build().run(0, 1) == by_paths(build())
