from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tidemark.llm import packing

KINDS = "container_kind string, capacity_tokens int, doc_id string"
SIZES = "doc_id bigint, n_tokens bigint, bucket string, closed int"


def run(spark, path, sizes, kinds=(("s", 50, ""), ("l", 400, "")), **options):
    s = spark.createDataFrame([(i, n, "x", 0) for i, n in enumerate(sizes)], SIZES)
    return [tuple(r) for r in packing.pack(spark, s, spark.createDataFrame(list(kinds), KINDS), str(path), **options).collect()]


@pytest.mark.parametrize(("task_tokens", "most"), [(10_000_000, 16), (2_000, 4), (300, 2)])
def test_every_item_once_within_capacity(spark, tmp_path, task_tokens, most):
    rng = random.Random(1)
    sizes = [rng.choice([0, 1, 5, 20, 49, 50, 51, 130, 399, 400, 401, 2000]) for _ in range(300)]
    got = run(spark, tmp_path / "a", sizes, task_tokens=task_tokens, most=most)
    used, pieces = defaultdict(int), defaultdict(list)
    for kind, container, doc, piece, n in got:
        used[kind, container] += n
        pieces[kind, doc].append((piece, n))
    capacity = {"s": 50, "l": 400}
    assert all(n <= capacity[kind] for (kind, _), n in used.items())
    for kind, room in capacity.items():
        for doc, size in enumerate(sizes):
            parts = sorted(pieces.get((kind, doc), []))
            assert sum(n for _, n in parts) == size
            assert [p for p, _ in parts] == list(range(-(-size // room)))  # divided only where larger than the container
            assert all(n == room for _, n in parts[:-1])


def test_fill_and_independence_of_partitioning(spark, tmp_path):
    rng = random.Random(2)
    sizes = [min(390, int(rng.lognormvariate(4, 1)) + 1) for _ in range(3000)]
    got = run(spark, tmp_path / "a", sizes, kinds=(("l", 400, ""),), task_tokens=60_000, most=32)
    containers = len({c for _, c, *_ in got})
    assert sum(sizes) / (containers * 400) > 0.97
    spark.conf.set("spark.sql.shuffle.partitions", 7)
    try:
        assert sorted(run(spark, tmp_path / "b", sizes, kinds=(("l", 400, ""),), task_tokens=60_000, most=32)) == sorted(got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_best_fit_takes_the_tightest_room():
    box = packing.OpenContainers(10, 3, "b")
    for size in (4, 7, 9):
        assert box.place((size,), size) == []
    assert box.place((3,), 3) == [("b-1", [(7,), (3,)])]  # 7 + 3 fills the second
    assert [m for _, m in box.rest()] == [[(9,)], [(4,)]]


def test_empty_and_bad_kinds(spark, tmp_path):
    assert run(spark, tmp_path / "a", []) == []
    assert run(spark, tmp_path / "b", [5, 6], kinds=(("z", 0, ""), ("n", None, ""))) == []
    assert len(run(spark, tmp_path / "c", [5, 5], kinds=(("s", 50, ""), ("s", 50, "")))) == 2  # a kind given twice counts once


def test_leftovers_of_a_single_task_are_packed_again_largest_first(spark, tmp_path):
    sizes = [133, 241] * 30  # 133 three times leaves 1, so in any order but largest first some 241 stay alone
    got = run(spark, tmp_path / "a", sizes, kinds=(("l", 400, ""),), most=128)
    assert sorted((doc, n) for _, _, doc, _, n in got) == list(enumerate(sizes))
    assert len({c for _, c, *_ in got}) == 30


def test_documents_without_tokens_have_a_row(spark, tmp_path):
    sizes = spark.createDataFrame([(1, 5, "x", 0), (2, 0, "x", 0), (3, None, "x", 0)], SIZES)
    kinds = spark.createDataFrame([("s", 50, ""), ("l", 400, ""), ("z", 0, "")], KINDS)
    got = packing.with_empty(packing.pack(spark, sizes, kinds, str(tmp_path / "a")), sizes, kinds)
    assert sorted((r.container_kind, r.doc_id, r.container_id is None, r.n_tokens) for r in got.collect()) == [("l", 1, False, 5), ("l", 2, True, 0), ("l", 3, True, 0), ("s", 1, False, 5), ("s", 2, True, 0), ("s", 3, True, 0)]
    assert {r.container_kind: r.containers for r in packing.fill(got, kinds).collect()} == {"s": 1, "l": 1}
