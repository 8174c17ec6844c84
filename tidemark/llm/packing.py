"""Items of varying size in containers of fixed capacity.

Bounded-space online packing: a task holds a fixed number of open containers, puts each item into the one it fits best, and
when none fits closes the fullest and opens a new one. What is still open at a task's end is dealt anew to fewer tasks, item by
item, largest first, until one task closes the rest; that is so for a single task's leftovers too. A task never holds more than its open containers and one Arrow batch.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import ship_package

#: Open containers of a task, and tokens that a task of the first round packs.
OPEN, TASK_TOKENS = 128, 32_000_000
#: Tasks whose leftovers one task of the next round takes.
MERGED = 64

_PLACED = "container_kind string, capacity_tokens bigint, doc_id bigint, piece int, n_tokens bigint, container_id string, closed boolean, bucket bigint"


class OpenContainers:
    """Open containers of one capacity, by free room."""

    def __init__(self, capacity: int, most: int, prefix: str) -> None:
        self.capacity, self.most, self.prefix = capacity, most, prefix
        self.free: list[tuple[int, int]] = []  # (room, number), sorted
        self.items: dict[int, list[tuple]] = {}
        self.count = 0

    def place(self, item: tuple, size: int) -> list[tuple[str, list[tuple]]]:
        """Put an item in; returns the containers that this closes."""
        at = bisect_left(self.free, (size, -1))
        closed = []
        if at < len(self.free):
            room, number = self.free.pop(at)
        else:
            if len(self.free) >= self.most:
                closed.append(self._close(self.free.pop(0)[1]))
            number, room = self.count, self.capacity
            self.items[number] = []
            self.count += 1
        self.items[number].append(item)
        if room == size:
            closed.append(self._close(number))
        else:
            insort(self.free, (room - size, number))
        return closed

    def _close(self, number: int) -> tuple[str, list[tuple]]:
        return f"{self.prefix}-{number}", self.items.pop(number)

    def rest(self) -> list[tuple[str, list[tuple]]]:
        """All that is open, fullest first."""
        return [self._close(number) for _, number in self.free]


def items_of(sizes: DataFrame, kinds: DataFrame) -> DataFrame:
    """``(container_kind, capacity_tokens, doc_id, piece, n_tokens)``: every document for every kind.

    Only a document larger than the capacity is divided: into full pieces and one for the rest. Documents without tokens
    take no room and are left out, as are kinds without a positive capacity. ``kinds`` is a fixed small table.
    """
    usable = kinds.filter("capacity_tokens > 0").select("container_kind", F.col("capacity_tokens").cast("bigint").alias("capacity_tokens")).distinct()
    listed = [(r.container_kind, r.capacity_tokens) for r in usable.collect()]
    if not listed:
        return sizes.select(F.lit("").alias("container_kind"), F.lit(1).cast("bigint").alias("capacity_tokens"), "doc_id", F.lit(0).alias("piece"), "n_tokens").limit(0)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("bigint").alias("capacity_tokens")) for k, c in listed]))
    every = sizes.filter("n_tokens > 0").select("doc_id", "n_tokens", each.alias("k")).select("k.*", "doc_id", "n_tokens")
    pieces = F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).cast("int")
    cut = every.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return cut.select("container_kind", "capacity_tokens", "doc_id", "piece", F.least("capacity_tokens", F.col("n_tokens") - F.col("piece") * F.col("capacity_tokens")).alias("n_tokens"))


def _pack_round(items: DataFrame, number: int, last: bool, most: int, largest_first: bool) -> DataFrame:
    """One round over ``items`` with a ``bucket``: each (kind, bucket) is packed by itself, in an order that depends on the items alone."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_now, at, out = None, None, []

        def emit(done: list[tuple[str, list[tuple]]], closed: bool) -> None:
            for name, members in done:
                out.extend((*m[:5], name, closed, m[5]) for m in members)

        for batch in batches:
            rows = zip(batch.container_kind, batch.capacity_tokens.tolist(), batch.doc_id.tolist(), batch.piece.tolist(), batch.n_tokens.tolist(), batch.bucket.tolist(), strict=True)
            for row in rows:
                key = (row[0], row[1], row[5])
                if key != at:
                    if open_now is not None:
                        emit(open_now.rest(), last)
                    at, open_now = key, OpenContainers(row[1], most, f"{row[0]}-{number}-{row[5]}")
                emit(open_now.place(row, row[4]), True)
            if out:
                yield pd.DataFrame(out, columns=_COLUMNS)
                out.clear()
        if open_now is not None:
            emit(open_now.rest(), last)
        if out:
            yield pd.DataFrame(out, columns=_COLUMNS)

    ship_package(items.sparkSession)
    order = [F.desc("n_tokens")] if largest_first else []
    grouped = items.repartition("container_kind", "bucket").sortWithinPartitions("container_kind", "capacity_tokens", "bucket", *order, F.xxhash64("doc_id", "piece"), "doc_id", "piece")
    return grouped.mapInPandas(pack, _PLACED)


_COLUMNS = [c.split()[0] for c in _PLACED.split(", ")]


def pack(spark: SparkSession, sizes: DataFrame, kinds: DataFrame, path: str, most: int = OPEN, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """``(container_kind, container_id, doc_id, piece, n_tokens)``; every item of every kind in exactly one container.

    ``sizes`` has ``doc_id`` and ``n_tokens`` and should be stored. Rounds are stored below ``path``. The result does not
    depend on how the input is partitioned. Documents without tokens are left out; see ``with_empty``.
    """
    items = items_of(sizes, kinds)
    total = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // task_tokens))
    current = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", F.lit("first")), F.lit(buckets)))
    done, number = [], 0
    while True:
        last = buckets == 1 and number > 0
        _pack_round(current, number, last, most, largest_first=number > 0).write.mode("overwrite").partitionBy("closed").parquet(f"{path}/round={number}")
        placed = spark.read.schema(_PLACED).parquet(f"{path}/round={number}")
        done.append(placed.filter("closed").select("container_kind", "container_id", "doc_id", "piece", "n_tokens"))
        if last:
            break
        buckets = max(1, buckets // MERGED)
        current = placed.filter("NOT closed").select("container_kind", "capacity_tokens", "doc_id", "piece", "n_tokens").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", F.lit(number)), F.lit(buckets)))
        number += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def with_empty(packed: DataFrame, sizes: DataFrame, kinds: DataFrame) -> DataFrame:
    """``packed`` and a row per kind for each document without tokens, which takes no room: its container is NULL."""
    named = [r.container_kind for r in kinds.filter("capacity_tokens > 0").select("container_kind").distinct().collect()]  # a fixed small table
    each = F.explode(F.array(*[F.lit(k).cast("string") for k in named]) if named else F.array().cast("array<string>"))
    empty = sizes.filter("n_tokens IS NULL OR n_tokens <= 0").select("doc_id", each.alias("container_kind"))
    return packed.unionByName(empty.select("container_kind", F.lit(None).cast("string").alias("container_id"), "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("n_tokens")))


def fill(packed: DataFrame, kinds: DataFrame) -> DataFrame:
    """Containers, tokens and share of room used per kind."""
    each = packed.filter("container_id IS NOT NULL").groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("used"))
    per_kind = each.groupBy("container_kind").agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"))
    return per_kind.join(kinds.select("container_kind", "capacity_tokens").distinct(), "container_kind").withColumn("share_used", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6))
