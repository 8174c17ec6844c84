"""Change feeds applied by a log-structured merge.

``LsmTable`` keeps immutable runs in levels. An append writes a run that holds, per key, its newest change, sorted by key within
hash buckets. A read merges all runs bucket by bucket, without a shuffle (deletes are tombstones until the merge is whole);
compaction merges the runs of a crowded level into one run of the next, so a change is rewritten once a level and not once a
batch. Order is (version, offset) with NULL lowest, so repeated and out-of-order changes cannot matter.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources import files as control
from tidemark.sources.runs import Runs, crowded_level
from tidemark.sources.tables import stream_path

#: Spellings of the kinds of change; compared in lower case.
DELETES = ("d", "delete")


def is_delete(op: str = "change_op") -> Column:
    return F.coalesce(F.lower(F.btrim(F.col(op), F.lit(" \t"))).isin(*DELETES), F.lit(False))


def newest_per_key(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the change that is highest by ``order``, NULL lowest; full ties go to the highest remaining columns.

    The maximum is taken on both sides of the shuffle, so a key with a third of all changes sends one row per task.
    Rows with a NULL key name no record and are passed over.
    """
    rest = [c for c in changes.columns if c not in (key, *order)]
    # a struct is compared field by field with NULL lowest
    packed = changes.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("__newest"))
    return packed.select(key, *[F.col("__newest")[c].alias(c) for c in (*order, *rest)]).select(*changes.columns)


class LsmTable:
    """Runs below ``path``: data in ``runs/<name>``, the list of live runs in ``manifest/<n>.json``, replaced as a whole.

    ``buckets`` counts when the table is made and is kept in its manifest; 0 stands for the session's number of shuffle partitions.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, order: list[str], tombstone: Column, buckets: int = 0) -> None:
        self.spark, self.path, self.key, self.order, self.tombstone = spark, path.rstrip("/"), key, order, tombstone
        made = self._manifest()["buckets"]
        self.runs = Runs(spark, f"{self.path}/runs", [key], made or buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def _versions(self) -> list[int]:
        return sorted(int(p.rsplit("/", 1)[1].split(".")[0]) for p, _, _ in control.list_files(self.spark, f"{self.path}/manifest") if p.endswith(".json"))

    def _manifest(self) -> dict:
        """``runs`` (name, level), ``through``: the last batch of a stream that is held, ``names``: other runs that have been merged."""
        versions = self._versions()
        return control.read_json(self.spark, f"{self.path}/manifest/{versions[-1]}.json") if versions else {"runs": [], "through": -1, "names": [], "buckets": 0}

    def live_runs(self) -> list[str]:
        return [r["name"] for r in self._manifest()["runs"]]

    def _commit(self, manifest: dict) -> None:
        number = (self._versions() or [0])[-1] + 1
        # fails if another writer took the number
        control.write_json(self.spark, f"{self.path}/manifest/{number}.json", {**manifest, "buckets": self.runs.buckets, "at": time.time()}, exclusive=True)

    def append(self, changes: DataFrame, run: str | None = None) -> str:
        """Add a run. A run id given again replaces nothing and adds nothing, so a retried append is harmless; ``batch-<n>`` names the batches of a stream, which come in order."""
        run = run or uuid.uuid4().hex
        known = self._manifest()
        batch = int(run[6:]) if run.startswith("batch-") else None
        if run in known["names"] or run in [r["name"] for r in known["runs"]] or batch is not None and batch <= known["through"]:
            return run
        self.runs.write(self.runs.dealt(newest_per_key(changes, self.key, self.order), grouped=True), run, dealt=True)
        self._commit({**known, "runs": [*known["runs"], {"name": run, "level": 0}], "through": known["through"] if batch is None else batch})
        return run

    def merged(self, runs: list[str] | None = None) -> DataFrame | None:
        """The deciding change of every key, tombstones included; of all runs, or of some."""
        names = self.live_runs() if runs is None else runs
        changes = self.runs.read(names)
        return changes if changes is None or len(names) == 1 else newest_per_key(changes, self.key, self.order)

    def read(self) -> DataFrame:
        """The current state: merge of all runs without deleted keys."""
        merged = self.merged()
        if merged is None:
            raise ValueError("no run has been appended")
        return merged.filter(~self.tombstone)

    def settle(self, fanout: int) -> None:
        """Merge crowded levels until none holds ``fanout`` runs."""
        while (level := crowded_level(self._manifest()["runs"], fanout)) is not None:
            self.compact(level=level)

    def compact(self, drop_tombstones: bool = False, level: int | None = None) -> str:
        """Merge all runs, or those of a level, into one of the next level. Tombstones stay unless the caller knows that no older change can still arrive."""
        known = self._manifest()
        old = [r for r in known["runs"] if level is None or r["level"] == level]
        merged = self.merged([r["name"] for r in old])
        if merged is None:
            raise ValueError("no run has been appended")
        if drop_tombstones and level is None:
            merged = merged.filter(~self.tombstone)
        run = uuid.uuid4().hex
        self.runs.write(merged, run, dealt=True)
        names = sorted({r["name"] for r in old if r["level"] == 0 and not r["name"].startswith("batch-")})
        rest = [r for r in known["runs"] if r not in old]
        self._commit({**known, "runs": [*rest, {"name": run, "level": max(r["level"] for r in old) + 1}], "names": [*known["names"], *names]})
        for r in old:
            self.runs.drop(r["name"])
        return run


def order_change_table(spark: SparkSession, path: str) -> LsmTable:
    return LsmTable(spark, path, "order_id", ["business_version", "kafka_offset"], is_delete())


def apply_feed(spark: SparkSession, source: str, path: str, compact_after: int = 8, max_files: int | None = None, max_bytes: str | None = None) -> LsmTable:
    """Apply everything new of a change feed stored at ``source`` and return the table.

    A checkpointed stream appends each batch as one run under the batch's number; a batch that is run again finds its run
    and adds nothing. Once a level holds ``compact_after`` runs they are merged into one of the next level.
    An empty feed gives an empty state; the order in which batches arrive cannot matter.
    """
    lsm = order_change_table(spark, f"{path}/table")
    schema = spark.read.parquet(source).schema

    def append(batch: DataFrame, number: int) -> None:
        lsm.append(batch, run=f"batch-{number:09d}")
        lsm.settle(compact_after)

    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    query = reader.parquet(stream_path(source)).writeStream.foreachBatch(append).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if not lsm.live_runs():
        lsm.append(spark.createDataFrame([], schema), run="empty")
    return lsm
