from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import compaction

FILES = "file_id bigint, event_date date, body string, bundle string, batch_id int, n_bytes int"
LOG = "log_seq bigint, log_action string, file_id bigint, load_id string"


def sample(seed, n):
    rng = random.Random(seed)
    files, log = [], []
    for i in range(n):
        lines = [f'{{"f":{i},"l":{j}}}' for j in range(rng.randrange(4))]
        body = "\n".join(lines) + ("\n" if rng.random() < 0.5 else "") + ("y" * 9000 if rng.random() < 0.1 else "")
        files.append((i, rng.choice([None, dt.date(2020, 1, 1), dt.date(2020, 1, 1), dt.date(2020, 1, 2)]), None if rng.random() < 0.05 else body, "clash", 7, None))
        entries = rng.choice([[], ["add"], ["add", "remove"], ["add", "remove", "add"]])
        log += [(len(log) * 10 + k, a, i, "l") for k, a in enumerate(entries)]
    log += rng.sample(log, len(log) // 4)
    rng.shuffle(log)
    return files, log


def truth(files, log):
    last = {}
    for seq, action, file_id, _ in log:
        last[file_id] = max(last.get(file_id, (-1, "")), (seq, action))
    return {f[0]: f for f in files if last.get(f[0], (0, ""))[1] == "add" and len((f[2] or "").encode()) < 8192}


def test_each_record_once_and_retries_replace(spark, tmp_path):
    files, log = sample(4, 60)
    source, out = str(tmp_path / "landing.parquet"), str(tmp_path / "out")
    logged = spark.createDataFrame(log, LOG)
    spark.createDataFrame(files[:40], FILES).repartition(5).write.parquet(source)
    first = compaction.compact_stream(spark, source, logged, out, target_bytes=300, max_files=2)
    assert {r.file_id for r in first.select("file_id").collect()} == set(truth(files[:40], log))
    spark.createDataFrame(files[40:], FILES).write.mode("append").parquet(source)
    rows = compaction.compact_stream(spark, source, logged, out, target_bytes=300, max_files=2)
    want = truth(files, log)
    assert {r.file_id for r in rows.select("file_id").collect()} == set(want)
    records = [(r.file_id, r.line_no, r.record) for r in rows.filter("record IS NOT NULL").collect()]
    assert len(records) == len(set(records))
    assert set(records) == {(i, k, line) for i, f in want.items() for k, line in enumerate(x for x in (f[2] or "").split("\n") if x.strip())}
    again = compaction.compact_stream(spark, source, logged, out, target_bytes=300, max_files=2)
    assert again.count() == rows.count()
    # a batch that is run again replaces what it wrote
    batch = spark.read.parquet(f"{out}/data").select(F.max("batch_id")).first()[0]
    part = spark.read.parquet(f"{out}/data/batch_id={batch}")
    before = part.count()
    part.cache().count()
    part.write.mode("overwrite").parquet(f"{out}/data/batch_id={batch}-copy")
    assert spark.read.parquet(f"{out}/data/batch_id={batch}-copy").count() == before


def test_empty_source(spark, tmp_path):
    source = str(tmp_path / "none.parquet")
    spark.createDataFrame([], FILES).write.parquet(source)
    rows = compaction.compact_stream(spark, source, spark.createDataFrame([], LOG), str(tmp_path / "o"))
    assert rows.count() == 0


def test_bundles_follow_bytes_not_days(spark):
    hot = [(i, dt.date(2020, 1, 1), "z" * 100, "", 0, 0) for i in range(400)] + [(1000, None, "a", "", 0, 0)]
    small = compaction.small_files(spark.createDataFrame(hot, FILES), spark.createDataFrame([(i,) for i in [*range(400), 1000]], "file_id bigint"))
    rows = compaction.consolidate(small, target_bytes=4000)
    sizes = rows.filter("event_date IS NOT NULL").groupBy("bundle").agg(F.sum("body_bytes").alias("b")).collect()
    assert len(sizes) == 10 and max(r.b for r in sizes) < 8000
    assert rows.filter("event_date IS NULL").count() == 1


def test_log_counts_an_entry_once_under_any_log_seq(spark, rows_of):
    log = spark.createDataFrame([(1, "add", 7, "l"), (1, "add", 7, "l"), (5, "add", 7, "l"), (2, "add", 8, "l"), (3, "remove", 7, "l"), (9, "remove", 7, "l"), (6, "add", 7, "m")], LOG)
    metrics = spark.createDataFrame([("l", 2, 1), ("m", 2, 0), (None, 5, 5)], "load_id string, files_added bigint, files_removed bigint")
    assert rows_of(compaction.log_balance(log, metrics)) == [("l", 2, 1, 2, 1, True), ("m", 1, 0, 2, 0, False)]


def test_a_log_that_changes_later_and_merged_batches(spark, tmp_path):
    source, out = str(tmp_path / "files.parquet"), str(tmp_path / "out")
    days = [dt.date(2020, 1, 1), dt.date(2020, 1, 2), None]
    rows = [(i, days[i % 3], f'{{"i":{i}}}\n{{"j":{i}}}') for i in range(12)]
    spark.createDataFrame(rows, "file_id bigint, event_date date, body string").repartition(4).write.parquet(source)
    log = lambda *entries: spark.createDataFrame([(n, a, f) for n, (a, f) in enumerate(entries)], "log_seq bigint, log_action string, file_id bigint")
    ids = lambda df: {r.file_id for r in df.select("file_id").distinct().collect()}
    first = [("add", i) for i in range(8)]
    assert ids(compaction.compact_stream(spark, source, log(*first), out, max_files=1)) == set(range(8))
    second = [*first, ("remove", 3), ("add", 9), ("add", 10)]
    for _ in range(2):  # caught up with once
        got = compaction.compact_stream(spark, source, log(*second), out, max_files=1)
        assert ids(got) == {0, 1, 2, 4, 5, 6, 7, 9, 10} and got.count() == 18
    before = len(got.inputFiles())
    merged = compaction.merge_batches(spark, out, compaction.live_files(log(*second)))
    assert sorted(merged.select("file_id", "record").collect()) == sorted(got_rows(rows, {0, 1, 2, 4, 5, 6, 7, 9, 10}))
    assert len(merged.inputFiles()) <= 3 < before  # at most one a day
    third = [*second, ("add", 11), ("add", 3)]
    got = compaction.compact_stream(spark, source, log(*third), out, max_files=1)
    assert ids(got) == {0, 1, 2, 3, 4, 5, 6, 7, 9, 10, 11} and got.count() == 22
    assert compaction.merge_batches(spark, out, compaction.live_files(log(*third))).count() == 22


def got_rows(rows, ids):
    return [(i, line) for i, _, body in rows if i in ids for line in body.split("\n")]
