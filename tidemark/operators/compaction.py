"""Consolidation of very many small files by a checkpointed stream.

The stream discovers each stored file once. A batch is written below its batch number in overwrite mode, so a batch that is
run again after a failure replaces its own output and can never add a file twice. Only files that the log holds as live are
taken: of a file's log entries the one with the highest sequence decides. A file that is added to the log only after its batch is
caught up with, one that is removed later is left out on reading, and what small batches have written is merged into well-sized
files by ``merge_batches``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources import files as control
from tidemark.sources.tables import stream_path

#: A live file with fewer bytes than this is consolidated.
SMALL_BYTES = 8192
#: Bytes of bodies that one consolidated file should hold.
TARGET_BYTES = 128 << 20


def live_files(log: DataFrame) -> DataFrame:
    """``file_id`` of the files whose entry with the highest ``log_seq`` is an add. Entries written again change nothing."""
    last = log.filter("file_id IS NOT NULL").groupBy("file_id").agg(F.max(F.struct("log_seq", F.lower("log_action").alias("log_action"))).alias("last"))
    return last.filter("last.log_action = 'add'").select("file_id")


def small_files(files: DataFrame, live: DataFrame, small_bytes: int = SMALL_BYTES) -> DataFrame:
    """Live files below ``small_bytes``; the size is that of the body itself, since recorded sizes may be missing or wrong. A NULL body has no bytes."""
    sized = files.select("file_id", "event_date", "body", F.coalesce(F.octet_length("body"), F.lit(0)).alias("body_bytes"))
    return sized.filter(F.col("body_bytes") < small_bytes).join(live, "file_id", "left_semi")


def consolidate(small: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """One row per record with its ``event_date`` and ``bundle``; a file without records gives one row with a NULL record.

    A day's files are dealt by hash into as many bundles as its bytes fill, so a day that holds a third of all files is
    spread like any other and no task sorts a whole day.
    """
    per_day = small.groupBy("event_date").agg(F.sum("body_bytes").alias("day_bytes"))
    bundles = per_day.select(F.col("event_date").alias("bundle_date"), F.greatest(F.ceil(F.col("day_bytes") / target_bytes), F.lit(1)).alias("bundles"))
    # one row per day
    dealt = small.join(F.broadcast(bundles), F.col("event_date").eqNullSafe(F.col("bundle_date"))).withColumn("bundle", F.pmod(F.xxhash64("file_id"), F.col("bundles")))
    lines = F.filter(F.split(F.coalesce("body", F.lit("")), "\n"), lambda x: F.length(F.btrim(x)) > 0)
    return dealt.select("event_date", "bundle", "file_id", "body_bytes", F.posexplode_outer(lines).alias("line_no", "record"))


def compact_stream(
    spark: SparkSession, source: str, log: DataFrame, out: str, small_bytes: int = SMALL_BYTES, target_bytes: int = TARGET_BYTES, max_files: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """Run the compactor over everything new at ``source`` and return the consolidated records written so far.

    Batches are bounded by ``max_files`` or ``max_bytes`` (for instance ``"1t"``). ``out`` holds data and checkpoint; a later call with
    the same ``out`` takes only files that have come since. An empty source gives an empty table.
    """
    schema = spark.read.parquet(source).schema
    live = live_files(log)

    def write(batch: DataFrame, number: int) -> None:
        _write_bundles(small_files(batch, live, small_bytes), target_bytes, f"{out}/data/batch_id={number}")
        waiting = batch.filter(F.coalesce(F.octet_length("body"), F.lit(0)) < small_bytes).select("file_id").join(live, "file_id", "left_anti")
        waiting.write.mode("overwrite").parquet(f"{out}/waiting/batch_id={number}")

    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    before = control.exists(spark, f"{out}/waiting")
    query = reader.parquet(stream_path(source)).writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if before:
        _catch_up(spark, source, live, out, small_bytes, target_bytes)
    return consolidated(spark, out, live)


def _write_bundles(small: DataFrame, target_bytes: int, path: str) -> None:
    ordered = consolidate(small, target_bytes).repartition(F.col("event_date"), F.col("bundle")).sortWithinPartitions("event_date", "bundle", "file_id", "line_no")
    ordered.write.mode("overwrite").parquet(path)


#: Batch numbers of files that were caught up with, and of merged batches, begin here.
LATE, MERGED = 1_000_000_000, 2_000_000_000
_RECORDS = "event_date date, bundle bigint, file_id bigint, body_bytes int, line_no int, record string, batch_id int"


def _batches(spark: SparkSession, out: str) -> list[int]:
    """Batches that count: those that no merge stands for, late and merged ones once their marker is there."""
    merge = control.read_json(spark, f"{out}/merge.json") if control.exists(spark, f"{out}/merge.json") else {"batch": None, "holds": []}
    late = {int(p.rsplit("/", 1)[1][:-5]) for p, _, _ in control.list_files(spark, f"{out}/late")}
    fs, folder = control.file_system(spark, f"{out}/data")
    there = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(folder) if s.getPath().getName().startswith("batch_id=")] if fs.exists(folder) else []
    return sorted(n for n in there if n not in merge["holds"] and (n < LATE or n in late or n == merge["batch"]))


def _catch_up(spark: SparkSession, source: str, live: DataFrame, out: str, small_bytes: int, target_bytes: int) -> None:
    """Files discovered before they were live, and live now: one batch under the next late number, which counts once its marker is there."""
    taken = _all_records(spark, out).select("file_id").distinct()
    due = spark.read.schema("file_id bigint").parquet(f"{out}/waiting").join(live, "file_id", "left_semi").join(taken, "file_id", "left_anti").distinct()
    if due.isEmpty():
        return
    number = LATE + len(control.list_files(spark, f"{out}/late"))
    _write_bundles(small_files(spark.read.parquet(source), due, small_bytes), target_bytes, f"{out}/data/batch_id={number}")
    control.write_json(spark, f"{out}/late/{number}.json", {"batch": number})


def _all_records(spark: SparkSession, out: str) -> DataFrame:
    paths = [f"{out}/data/batch_id={n}" for n in _batches(spark, out)]
    return spark.read.schema(_RECORDS).option("basePath", f"{out}/data").parquet(*paths) if paths else spark.createDataFrame([], _RECORDS)


def consolidated(spark: SparkSession, out: str, live: DataFrame | None = None) -> DataFrame:
    """Consolidated records; with ``live`` those of files that are still live."""
    rows = _all_records(spark, out)
    return rows if live is None else rows.join(live, "file_id", "left_semi").select(*rows.columns)


def merge_batches(spark: SparkSession, out: str, live: DataFrame | None = None, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Bundle the records of all batches anew, so that what small batches wrote for a day lies in as few files as its bytes fill.

    The merged batch stands for the others once a pointer says so; then these are deleted. A crash before that leaves them in use.
    """
    held = _batches(spark, out)
    rows = consolidated(spark, out, live)
    files = rows.groupBy("event_date", "file_id").agg(F.max("body_bytes").alias("b"))
    bundles = files.groupBy("event_date").agg(F.greatest(F.ceil(F.sum("b") / target_bytes), F.lit(1)).alias("bundles")).withColumnRenamed("event_date", "bundle_date")
    # one row per day
    dealt = rows.drop("bundle", "batch_id").join(F.broadcast(bundles), F.col("event_date").eqNullSafe(F.col("bundle_date"))).withColumn("bundle", F.pmod(F.xxhash64("file_id"), F.col("bundles")).cast("bigint"))
    number = MERGED + 1 + (held[-1] - MERGED if held and held[-1] >= MERGED else 0)
    out_rows = dealt.select("event_date", "bundle", "file_id", "body_bytes", "line_no", "record").repartition(F.col("event_date"), F.col("bundle")).sortWithinPartitions("event_date", "bundle", "file_id", "line_no")
    out_rows.write.mode("overwrite").parquet(f"{out}/data/batch_id={number}")
    if live is not None:  # should they be added again, they are caught up with
        _all_records(spark, out).select("file_id").distinct().join(live, "file_id", "left_anti").write.mode("overwrite").parquet(f"{out}/waiting/batch_id={number}")
    gone = control.read_json(spark, f"{out}/merge.json")["holds"] if control.exists(spark, f"{out}/merge.json") else []
    control.write_json(spark, f"{out}/merge.json", {"batch": number, "holds": sorted({*gone, *held})})
    for n in held:
        control.delete(spark, f"{out}/data/batch_id={n}")
    return consolidated(spark, out, live)


def log_balance(log: DataFrame, metrics: DataFrame) -> DataFrame:
    """Adds and removes per load in the log (each entry once) beside what the metrics say; ``agrees`` is false where they differ.

    An entry is a file's add or remove in a load, under however many ``log_seq`` it was written.
    """
    entries = log.dropDuplicates(["load_id", "log_action", "file_id"]).groupBy("load_id").agg(
        F.count_if(F.col("log_action") == "add").alias("log_added"), F.count_if(F.col("log_action") == "remove").alias("log_removed")
    )
    said = metrics.filter("load_id IS NOT NULL").groupBy("load_id").agg(F.max("files_added").alias("said_added"), F.max("files_removed").alias("said_removed"))
    both = entries.join(said, "load_id", "full")
    return both.withColumn("agrees", F.col("log_added").eqNullSafe(F.col("said_added")) & F.col("log_removed").eqNullSafe(F.col("said_removed")))
