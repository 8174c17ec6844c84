"""Snapshotted Parquet tables.

A table is a folder with immutable data files and one small JSON file per version. A commit writes its data under unique names,
lists what it adds and removes in a change file, and then creates the next version, which only one writer can; the loser reads
the table anew and tries again. Readers pin a version, so several reads see one state.

The list of data files is itself a table: a version names a base (Parquet, made anew every ``CHANGES_KEPT`` versions) and the change
files since. It is read, pruned and joined by Spark; to the driver come only the paths that a read opens and one row per file that
a commit writes. Every file's size, rows and least and greatest key are listed, by which keyed reads and writes choose files
before Spark opens any. Properties of a version, such as a load id, are also kept as evidence that outlives the version.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tidemark.sources import files as control

#: Change files that a version may name before its base is made anew.
CHANGES_KEPT = 10
#: Spans by which the keys of a keyed read or write are held against the files' spans: as many keys are held one by one, of more keys neighbours share a span.
KEY_SPANS = 1024
#: Bytes of data for which ``bucket`` makes one bucket, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 1 << 30, 16
ENTRY = "path string, bytes bigint, rows bigint, part string, min_key string, max_key string"


class CommitConflict(RuntimeError):
    """The table changed under a write that depends on what it had read."""


@dataclass
class DataFile:
    path: str
    bytes: int
    rows: int
    part: str
    min_key: str | None
    max_key: str | None


@dataclass
class Snapshot:
    """``base`` and ``changes`` name the folder and files that list the data files."""

    snapshot_id: int
    parent_id: int | None
    committed_at: float
    operation: str
    schema: str
    properties: dict[str, str] = field(default_factory=dict)
    summary: dict[str, int] = field(default_factory=dict)
    base: str | None = None
    changes: list[str] = field(default_factory=list)


@dataclass
class Change:
    """What a commit does to the list of files; with ``anew`` all files before it are gone."""

    added: list[DataFile] = field(default_factory=list)
    removed: list[DataFile] = field(default_factory=list)
    anew: bool = False


@dataclass
class Cost:
    """What a write read and changed."""

    files_planned: int = 0
    bytes_planned: int = 0
    files_removed: int = 0
    files_added: int = 0
    bytes_removed: int = 0
    bytes_added: int = 0
    snapshot_delta: int = 0


def _tail(path: str) -> str:
    """Write, part and name of a data file: the same however its path is spelled. Files of one task share their name across parts."""
    return "/".join(path.rsplit("/", 3)[1:])


class SnapshotTable:
    """``layout``: ``day`` parts files by the day column, ``bucket(n)`` by a hash of the key, ``bucket`` likewise by a number of
    buckets that doubles as the table grows, None not at all. A part of any size is spread over several files."""

    def __init__(self, spark: SparkSession, path: str, key: str = "order_id", day: str | None = "event_date", layout: str | None = "day", attempts: int = 5, clock: Callable[[], float] = time.time) -> None:
        self.spark, self.path, self.key, self.day, self.layout, self.attempts, self.clock = spark, path.rstrip("/"), key, day, layout, attempts, clock

    # --- metadata -----------------------------------------------------------------------------------------------------
    def _version_path(self, number: int) -> str:
        return f"{self.path}/metadata/v{number:09d}.json"

    def versions(self) -> list[int]:
        names = (p.rsplit("/", 1)[1] for p, _, _ in control.list_files(self.spark, f"{self.path}/metadata"))
        return [int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")]

    def snapshot(self, snapshot_id: int | None = None, as_of: float | None = None) -> Snapshot | None:
        """The current snapshot, the one with an id, or the last one committed at or before a moment."""
        numbers = self.versions()
        if snapshot_id is not None:
            if snapshot_id not in numbers:
                raise KeyError(f"no snapshot {snapshot_id}")
            return self._load(snapshot_id)
        for number in reversed(numbers):
            found = self._load(number)
            if as_of is None or found.committed_at <= as_of:
                return found
        return None

    def _load(self, number: int) -> Snapshot:
        return Snapshot(**control.read_json(self.spark, self._version_path(number)))

    def _evidence_path(self, name: str, value: str) -> str:
        return f"{self.path}/metadata/evidence/{hashlib.sha256(f'{name}={value}'.encode()).hexdigest()}.json"

    def find(self, **properties: str) -> Snapshot | None:
        """The newest snapshot that carries these properties, e.g. a load id: evidence that a load is committed, also of one that has expired.

        The newest versions are looked at first: a crash may come between a version and its evidence, which the next commit makes up for.
        """
        wanted = {k.replace("_", "-"): v for k, v in properties.items()}
        holds = lambda s: all(s.properties.get(k) == v for k, v in wanted.items())
        numbers = self.versions()
        if numbers and holds(newest := self._load(numbers[-1])):
            return newest
        found = []
        for name, value in wanted.items():
            path = self._evidence_path(name, value)
            if not control.exists(self.spark, path):
                return None
            found.append(Snapshot(**control.read_json(self.spark, path)))
        one = min(found, key=lambda s: s.snapshot_id)
        if holds(one):
            return one
        return next((s for n in reversed(numbers) if holds(s := self._load(n))), None)

    def _keep_evidence(self, snapshot: Snapshot) -> None:
        for name, value in snapshot.properties.items():
            control.write_json(self.spark, self._evidence_path(name, value), asdict(snapshot))

    @property
    def schema(self) -> StructType | None:
        current = self.snapshot()
        return self._schema_of(current) if current else None

    def snapshots(self) -> DataFrame:
        rows = [(s.snapshot_id, s.parent_id, s.committed_at, s.operation, s.properties, s.summary, s.summary.get("total-files", 0)) for s in map(self._load, self.versions())]
        return self.spark.createDataFrame(rows, "snapshot_id bigint, parent_id bigint, committed_at double, operation string, properties map<string,string>, summary map<string,bigint>, files bigint")

    def _listed(self, snapshot: Snapshot | None) -> DataFrame:
        """The data files of a snapshot: its base and what has been added since, without what has been removed since."""
        if snapshot is None or not (snapshot.base or snapshot.changes):
            return self.spark.createDataFrame([], ENTRY)
        parts = [self.spark.read.schema(ENTRY).parquet(f"{self.path}/metadata/{snapshot.base}")] if snapshot.base else []
        if not snapshot.changes:
            return parts[0]
        changes = self.spark.read.schema(f"{ENTRY}, added boolean").json([f"{self.path}/metadata/changes/{c}" for c in snapshot.changes])
        known = changes.filter("added").drop("added")
        for part in parts:
            known = known.unionByName(part)
        # a path is used once, so what is removed never comes back
        return known.join(changes.filter("NOT added").select("path"), "path", "left_anti").select("path", "bytes", "rows", "part", "min_key", "max_key")

    def files(self, snapshot_id: int | None = None) -> DataFrame:
        return self._listed(self.snapshot(snapshot_id))

    def added_files(self, snapshot: Snapshot) -> list[str]:
        """Paths that a commit added, sorted; also of an expired snapshot while its change file is kept, later none."""
        path = f"{self.path}/metadata/changes/{snapshot.changes[-1]}" if snapshot.changes and snapshot.summary["added-files"] else None
        if path is None or not control.exists(self.spark, path):
            return []
        lines = control.read_text(self.spark, path).splitlines()
        return sorted(e["path"] for e in map(json.loads, lines) if e["added"])

    def entries(self) -> DataFrame:
        """Every file of every snapshot, as added, kept or removed by it."""
        out, before = self.spark.createDataFrame([], "snapshot_id bigint, path string, status string"), self.spark.createDataFrame([], "path string")
        for number in self.versions():
            now = self.files(number).select("path")
            both = now.withColumn("now", F.lit(True)).join(before.withColumn("was", F.lit(True)), "path", "full")
            status = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").otherwise("kept")
            out, before = out.unionByName(both.select(F.lit(number).cast("bigint").alias("snapshot_id"), "path", status.alias("status"))), now
        return out

    def properties(self) -> dict[str, str]:
        current = self.snapshot()
        return {"layout": str(self.layout), "key": self.key, "snapshots": str(len(self.versions())), **(current.properties if current else {})}

    # --- reading ------------------------------------------------------------------------------------------------------
    def _open(self, schema: StructType, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths).select(*schema.names)

    def open_paths(self, paths: list[str]) -> DataFrame:
        """Data files by their paths, with today's columns."""
        return self._open(self.schema, paths)

    def _schema_of(self, snapshot: Snapshot) -> StructType:
        return StructType.fromJson(json.loads(snapshot.schema))

    @staticmethod
    def _collected(listed: DataFrame) -> list[DataFile]:
        return [DataFile(*r) for r in listed.select("path", "bytes", "rows", "part", "min_key", "max_key").collect()]

    def read(self, snapshot_id: int | None = None, as_of: float | None = None, between: tuple[str, str] | None = None) -> DataFrame:
        """The rows of a snapshot; with ``between`` only files whose keys may lie in the span (rows are not filtered)."""
        chosen = self.snapshot(snapshot_id, as_of)
        if chosen is None:
            raise LookupError("the table has no such snapshot")
        listed = self._listed(chosen)
        if between is not None:
            listed = listed.filter(F.col("min_key").isNull() | (F.col("min_key") <= between[1]) & (F.col("max_key") >= between[0]))
        return self._open(self._schema_of(chosen), [r.path for r in listed.select("path").collect()])

    def read_keys(self, keys: DataFrame, snapshot_id: int | None = None) -> DataFrame:
        """Rows whose key is among ``keys``; files are chosen by the keys' spans and the files' buckets first."""
        chosen = self.snapshot(snapshot_id)
        if chosen is None:
            raise LookupError("the table has no such snapshot")
        return self._open(self._schema_of(chosen), [f.path for f in self._candidates(chosen, keys)]).join(keys.select(self.key).distinct(), self.key, "left_semi")

    def _candidates(self, snapshot: Snapshot, keys: DataFrame) -> list[DataFile]:
        """Files that may hold one of the keys.

        The keys, sorted within range parts, are cut into about ``KEY_SPANS`` spans; a file is chosen if a span of its bucket
        overlaps its own. The more keys there are the more neighbours share a span, so the choice is never too small.
        """
        listed = self._listed(snapshot)
        counts = [r.n for r in listed.select(F.element_at(F.split("part", "-of-"), 2).cast("int").alias("n")).distinct().collect()] if self._bucketed else [None]
        part = F.explode(F.array(*[self._bucket(n) for n in counts if n])) if self._bucketed else F.lit("")
        if self._bucketed and not any(counts):
            return []
        text = keys.filter(F.col(self.key).isNotNull()).select(part.alias("p"), F.col(self.key).cast("string").alias("k")).distinct().repartitionByRange("p", "k").withColumn("range", F.spark_partition_id()).persist()
        try:
            each = max(1, -(-text.count() // KEY_SPANS))
            nth = F.row_number().over(Window.partitionBy("range", "p").orderBy("k"))
            spans = text.withColumn("piece", F.floor((nth - 1) / each)).groupBy("range", "p", "piece").agg(F.min("k").alias("low"), F.max("k").alias("high"))
            # at most KEY_SPANS spans and one more per range part and bucket
            per_part = spans.groupBy("p").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
            met = listed.withColumn("p", F.col("part") if self._bucketed else F.lit("")).join(F.broadcast(per_part), "p")
            overlaps = F.col("min_key").isNull() | F.exists("spans", lambda s: (F.col("min_key") <= s["high"]) & (F.col("max_key") >= s["low"]))
            return self._collected(met.filter(overlaps))
        finally:
            text.unpersist()

    # --- writing ------------------------------------------------------------------------------------------------------
    @property
    def _bucketed(self) -> bool:
        return bool(self.layout and self.layout.startswith("bucket"))

    def _bucket(self, count: int):
        return F.concat(F.pmod(F.xxhash64(self.key), F.lit(count)).cast("string"), F.lit(f"-of-{count}"))

    def buckets(self, snapshot: Snapshot | None) -> int:
        """Buckets of what is written next: as declared, or the power of two that fits the table's bytes."""
        if self.layout != "bucket":
            return int(self.layout[7:-1])
        wanted, count = (snapshot.summary.get("total-bytes", 0) if snapshot else 0) / BUCKET_BYTES, LEAST_BUCKETS
        while count < wanted:
            count *= 2
        return count

    def _part_of(self, snapshot: Snapshot | None):
        if self.layout is None:
            return F.lit("all")
        if self.layout == "day":
            return F.coalesce(F.date_format(self.day, "yyyy-MM-dd"), F.lit("none"))
        return self._bucket(self.buckets(snapshot))

    def _write(self, rows: DataFrame, max_rows: int = 0) -> list[DataFile]:
        """Write rows as new files and list them with their statistics: one row per file comes to the driver.

        Parts are rebalanced by the bytes shuffled: AQE joins small ones and splits one that holds much, such as a day with a third
        of all rows, over several tasks and files. Afterwards the key column, and no other, is read for the files' spans.
        """
        write_id = uuid.uuid4().hex
        root = f"{self.path}/data/__write={write_id}"
        out = rows.withColumn("__part", self._part_of(self.snapshot()))
        if self.layout:
            out = out.hint("rebalance", F.col("__part"))
        out.sortWithinPartitions("__part", self.key).write.partitionBy("__part").option("maxRecordsPerFile", max_rows).parquet(root)
        sizes = {p: b for p, b, _ in control.list_files(self.spark, root, recursive=True) if p.endswith(".parquet")}
        if not sizes:
            return []
        stats = self.spark.read.schema(rows.schema).option("basePath", root).parquet(root).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"), F.min(F.col(self.key).cast("string")).alias("low"), F.max(F.col(self.key).cast("string")).alias("high"))
        by_name = {_tail(r.f): r for r in stats.collect()}
        listed = []
        for path, size in sizes.items():
            r = by_name.get(_tail(path))
            part = path.split("__part=", 1)[1].split("/", 1)[0]
            listed.append(DataFile(path, size, r.n if r else 0, part, r.low if r else None, r.high if r else None))
        return listed

    def _commit(self, operation: str, change: Change, schema_of: Callable[[Snapshot | None], StructType], properties: dict[str, str] | None, depends_on: int | None = -1, before_commit: Callable[[], None] | None = None) -> Snapshot:
        """Create the next version from the current one; tried anew while other writers win, unless the change depends on what was read."""
        name = f"{uuid.uuid4().hex}.json"
        if change.added or change.removed:
            lines = [json.dumps({**asdict(f), "added": added}) for added, listed in ((True, change.added), (False, change.removed)) for f in listed]
            control.write_text(self.spark, f"{self.path}/metadata/changes/{name}", "\n".join(lines) + "\n")
        for attempt in range(self.attempts):
            current = self.snapshot()
            if depends_on != -1 and (current.snapshot_id if current else None) != depends_on:
                raise CommitConflict(f"the table is at {current.snapshot_id if current else None}, the change was made for {depends_on}")
            if current:
                self._keep_evidence(current)  # had a crash kept it from being written
            was = current.summary if current else {}
            total = lambda what: was.get(f"total-{what}", 0)
            gone_files, gone_bytes, gone_rows = (total("files"), total("bytes"), total("records")) if change.anew else (len(change.removed), sum(f.bytes for f in change.removed), sum(f.rows for f in change.removed))
            new_bytes, new_rows = sum(f.bytes for f in change.added), sum(f.rows for f in change.added)
            summary = {
                "added-files": len(change.added), "removed-files": gone_files, "total-files": total("files") - gone_files + len(change.added), "total-records": total("records") - gone_rows + new_rows, "total-bytes": total("bytes") - gone_bytes + new_bytes,
                "added-records": new_rows, "added-bytes": new_bytes, "removed-bytes": gone_bytes,
            }
            base, changes = (None, []) if change.anew or current is None else (current.base, list(current.changes))
            if change.added or change.removed:
                if len(changes) >= CHANGES_KEPT:
                    base, changes = self._new_base(current), []
                changes = [*changes, name]
            made = Snapshot((current.snapshot_id if current else 0) + 1, current.snapshot_id if current else None, self.clock(), operation, schema_of(current).json(), dict(properties or {}), summary, base, changes)
            if before_commit is not None:
                before_commit()
            try:
                control.write_json(self.spark, self._version_path(made.snapshot_id), asdict(made), exclusive=True)
            except control.FileExists:
                time.sleep(min(1.0, 0.05 * 2**attempt))
                continue
            self._keep_evidence(made)
            return made
        raise CommitConflict(f"gave up after {self.attempts} attempts")

    def _new_base(self, snapshot: Snapshot) -> str:
        name = f"bases/{uuid.uuid4().hex}"
        self._listed(snapshot).repartitionByRange("part", "min_key").sortWithinPartitions("part", "min_key").write.parquet(f"{self.path}/metadata/{name}")
        return name

    @staticmethod
    def _merged(old: StructType | None, new: StructType) -> StructType:
        """Columns may be added, never dropped; a column that comes with another type is an error."""
        if old is None:
            return StructType([f for f in new])
        known = {f.name: f.dataType for f in old}
        for f in new:
            if f.name in known and f.dataType != known[f.name] and f.dataType.typeName() != "void":
                raise TypeError(f"{f.name} is {known[f.name].simpleString()}, not {f.dataType.simpleString()}")
        return StructType([*old, *[f for f in new if f.name not in known]])

    def _conform(self, rows: DataFrame, schema: StructType) -> DataFrame:
        """Rows with all columns of the schema: absent ones NULL, all-NULL ones given their declared type."""
        return rows.select(*[(F.col(f"`{f.name}`").cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])

    def ensure(self, schema: StructType) -> Snapshot:
        """Create the table or add columns it lacks; existing rows read NULL there. Nothing new gives no snapshot."""
        current = self.snapshot()
        if current is not None and len(self._merged(self._schema_of(current), schema)) == len(self._schema_of(current)):
            return current
        return self._commit("schema", Change(), self._with(schema), None)

    def _with(self, schema: StructType) -> Callable[[Snapshot | None], StructType]:
        return lambda now: self._merged(self._schema_of(now) if now else None, schema)

    def append(self, rows: DataFrame, properties: dict[str, str] | None = None, before_commit: Callable[[], None] | None = None) -> Snapshot:
        schema = self._merged(self.schema, rows.schema)
        added = self._write(self._conform(rows, schema))
        return self._commit("append", Change(added), self._with(schema), properties, before_commit=before_commit)

    def overwrite(self, rows: DataFrame, properties: dict[str, str] | None = None) -> Snapshot:
        schema = self._merged(self.schema, rows.schema)
        added = self._write(self._conform(rows, schema))
        return self._commit("overwrite", Change(added, anew=True), lambda now: schema, properties)

    def truncate(self) -> Snapshot:
        """A snapshot without rows; earlier ones can still be read."""
        return self._commit("truncate", Change(anew=True), self._schema_of, None)

    def replace_keys(self, rows: DataFrame, properties: dict[str, str] | None = None, before_commit: Callable[[], None] | None = None) -> tuple[Snapshot | None, Cost]:
        """Replace the rows of the keys in ``rows``; only files that hold one of them are rewritten. No rows, no snapshot."""
        current = self.snapshot()
        if rows.isEmpty():
            return None, Cost()
        schema = self._merged(self._schema_of(current) if current else None, rows.schema)
        new = self._conform(rows, schema)
        keys = new.select(self.key).distinct()
        planned = self._candidates(current, keys) if current else []
        touched: list[DataFile] = []
        if planned:
            opened = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*[f.path for f in planned])
            hit = {_tail(r.f) for r in opened.select(self.key, F.input_file_name().alias("f")).join(keys, self.key, "left_semi").select("f").distinct().collect()}  # at most the planned files
            touched = [f for f in planned if _tail(f.path) in hit]
        survivors = self._open(schema, [f.path for f in touched]).join(keys, self.key, "left_anti").select(*schema.names)
        added = self._write(survivors.unionByName(new))
        made = self._commit("replace", Change(added, touched), lambda now: schema, properties, depends_on=current.snapshot_id if current else None, before_commit=before_commit)
        return made, Cost(len(planned), sum(f.bytes for f in planned), len(touched), len(added), sum(f.bytes for f in touched), sum(f.bytes for f in added), 1)

    # --- services -----------------------------------------------------------------------------------------------------
    def plan_cost(self, keys: DataFrame | None = None) -> tuple[int, int]:
        """Files and bytes that a read, or a keyed read, would open."""
        current = self.snapshot()
        if current is None:
            return 0, 0
        if keys is None:
            return current.summary["total-files"], current.summary["total-bytes"]
        chosen = self._candidates(current, keys)
        return len(chosen), sum(f.bytes for f in chosen)

    def optimize(self, file_size_threshold: int, properties: dict[str, str] | None = None) -> Snapshot | None:
        """Rewrite files below the threshold into few per part; the rows stay the same. A part with one such file is left alone,
        unless the table has outgrown its number of buckets."""
        current = self.snapshot()
        if current is None:
            return None
        listed = self._listed(current)
        small = F.col("bytes") < file_size_threshold
        outgrown = ~F.col("part").endswith(f"-of-{self.buckets(current)}") if self._bucketed else F.lit(False)
        crowded = listed.filter(small).groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("part", F.lit(True).alias("crowded"))
        chosen = self._collected(listed.join(crowded, "part", "left").filter(outgrown | small & F.col("crowded")))  # the files to be opened
        if not chosen:
            return None
        schema = self._schema_of(current)
        added = self._write(self._open(schema, [f.path for f in chosen]))
        return self._commit("optimize", Change(added, chosen), lambda now: schema, properties, depends_on=current.snapshot_id)

    def expire_snapshots(self, older_than: float, retain_last: int = 5) -> int:
        """Drop versions committed before a moment, except the newest ``retain_last``; the current one always stays, and so does evidence."""
        numbers = self.versions()
        old = [s for n in numbers[: -max(1, retain_last)] if (s := self._load(n)).committed_at < older_than]
        for s in old:
            self._keep_evidence(s)
            control.delete(self.spark, self._version_path(s.snapshot_id))
        return len(old)

    def remove_orphans(self, older_than: float) -> int:
        """Delete data files that no version names and that were written before a moment, then the lists that no version needs; gives the number of data files."""
        kept = [self._load(n) for n in self.versions()]
        there = [(p, _tail(p)) for p, _, t in control.list_files(self.spark, f"{self.path}/data", recursive=True) if t < older_than]
        tail = F.array_join(F.slice(F.split("path", "/"), -3, 3), "/")
        named = self.spark.createDataFrame([], "tail string")
        for base in {(s.base, tuple(s.changes)): s for s in kept}.values():
            named = named.unionByName(self._listed(base).select(tail.alias("tail")))
        orphans = [r.p for r in self.spark.createDataFrame(there, "p string, tail string").join(named.distinct(), "tail", "left_anti").collect()] if there else []
        for p in orphans:
            control.delete(self.spark, p)
        bases, changes = {s.base for s in kept}, {c for s in kept for c in s.changes}
        for folder, needed in (("changes", changes), ("bases", {b.split("/")[1] for b in bases if b})):
            for p in {q for q, _, t in control.list_files(self.spark, f"{self.path}/metadata/{folder}", recursive=True) if t < older_than}:
                if p.rsplit(f"/{folder}/", 1)[1].split("/")[0] not in needed:
                    control.delete(self.spark, p)
        return len(orphans)
