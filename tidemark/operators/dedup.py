"""Exactly one copy of messages that were delivered more than once.

A stream keeps the seen identifiers as keyed state in sorted runs. Every batch reduces its rows to one record per identifier, looks
these identifiers up in the state and writes the records brought up to date as a run of its own; the batch counts once its state
file exists, which names all runs and the watermark, so state and output appear together and a batch that is run again replaces
what it had written. Runs whose newest message lies before the watermark leave the live state for a ledger, which is looked up as well, so a copy that
comes after its message has expired is never taken for new. All runs have the same hash buckets: a look-up moves the batch's
records to them and nothing else, and no batch writes more than its own identifiers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.text import plain_key
from tidemark.sources import files as control
from tidemark.sources.runs import Runs, crowded_level
from tidemark.sources.tables import stream_path

MESSAGES = "event_id string, canonical_payload_hash string, kept struct<no_time: boolean, kafka_timestamp: timestamp_ntz, kafka_partition: int, kafka_offset: bigint>, n bigint, last_seen timestamp_ntz"
KEY = ["event_id", "canonical_payload_hash"]


def copies_by_message(rows: DataFrame, event_id: str = "event_id", digest: str = "canonical_payload_hash") -> DataFrame:
    """``(event_id, canonical_payload_hash, kept, n, last_seen)`` per message; ``kept`` is the earliest copy.

    Reduced on both sides of the shuffle, so a message repeated very often sends one row per task. Rows without identifier
    are never copies and are left out; a NULL or blank hash is a hash like any other.
    """
    keyed = rows.select(
        plain_key(event_id).alias("event_id"), F.coalesce(plain_key(digest), F.lit("")).alias("canonical_payload_hash"), F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"), F.col("kafka_partition").cast("int").alias("kafka_partition"), F.col("kafka_offset").cast("bigint").alias("kafka_offset")
    ).filter("event_id IS NOT NULL")
    # an absent time sorts after all others
    place = F.struct(F.col("kafka_timestamp").isNull().alias("no_time"), "kafka_timestamp", "kafka_partition", "kafka_offset")
    return keyed.groupBy("event_id", "canonical_payload_hash").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("n"), F.max("kafka_timestamp").alias("last_seen"))


def _newest(records: DataFrame) -> DataFrame:
    """Of a message's records in several runs the one with the highest count: each later one holds the earlier ones."""
    return records.groupBy(*KEY).agg(F.max_by(F.struct("kept", "n", "last_seen"), "n").alias("r")).select(*KEY, "r.kept", "r.n", "r.last_seen")


class SeenStore:
    """State of seen messages below ``path``: records in ``runs/<name>``, the state after each batch in ``state/<n>.json``.

    ``fanout``: runs of one level, live or in the ledger, that are merged into one. ``buckets`` counts when the store is made; 0 stands
    for the session's number of shuffle partitions.
    """

    def __init__(self, spark: SparkSession, path: str, horizon: str = "1 day", buckets: int = 0, fanout: int = 8) -> None:
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        self.horizon = spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {horizon}"))).first()[0]
        made = self.state()["buckets"]
        self.runs = Runs(spark, f"{self.path}/runs", KEY, made or buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def state(self) -> dict:
        """The state after the last batch that counts: its number, the watermark (microseconds), live runs and ledger runs (name, level, newest)."""
        files = [p for p, _, _ in control.list_files(self.spark, f"{self.path}/state") if p.endswith(".json")]
        return control.read_json(self.spark, max(files)) if files else {"batch": -1, "watermark": None, "live": [], "ledger": [], "buckets": 0}

    def _records(self, runs: list[dict]) -> DataFrame | None:
        found = self.runs.read([r["name"] for r in runs])
        return found if found is None or len(runs) == 1 else _newest(found)

    def live(self) -> DataFrame:
        """Records of the live state."""
        found = self._records(self.state()["live"])
        return self.spark.createDataFrame([], MESSAGES) if found is None else found

    def apply(self, batch: DataFrame, number: int) -> None:
        """Bring the state up to date with one batch; batches come in order, one that counts already is passed over."""
        now = self.state()
        if number <= now["batch"]:
            return
        updated = self.runs.dealt(copies_by_message(batch), grouped=True)
        for place in ("live", "ledger"):  # the same partitioning on both sides, so only the batch's records are moved
            if (known := self._records(now[place])) is not None:
                known = known.select(*[F.col(k).alias(f"k_{k}") for k in KEY], F.col("kept").alias("k_kept"), F.col("n").alias(f"{place}_n"), F.col("last_seen").alias("k_seen"))
                met = updated.join(known, [F.col(k) == F.col(f"k_{k}") for k in KEY], "left")
                before = F.greatest(F.coalesce("before", F.lit(0)), F.coalesce(f"{place}_n", F.lit(0))) if "before" in updated.columns else F.coalesce(f"{place}_n", F.lit(0))
                updated = met.select(*KEY, F.least("kept", "k_kept").alias("kept"), "n", F.greatest("last_seen", "k_seen").alias("last_seen"), before.alias("before"))
        if "before" in updated.columns:
            updated = updated.select(*KEY, "kept", (F.col("n") + F.col("before")).alias("n"), "last_seen")
        name = f"batch-{number:09d}"
        self.runs.write(updated, name, dealt=True)
        newest = self._newest_in(name)
        reach = None if newest is None else newest - self.horizon
        mark = max([x for x in (now["watermark"], reach) if x is not None], default=None)
        runs = [*now["live"], {"name": name, "level": 0, "newest": newest}]
        past = lambda r: r["newest"] is not None and mark is not None and r["newest"] < mark
        after = {"batch": number, "watermark": mark, "live": [r for r in runs if not past(r)], "ledger": [*now["ledger"], *[r for r in runs if past(r)]], "buckets": self.runs.buckets}
        gone = self._settle(after)
        control.write_json(self.spark, f"{self.path}/state/{number:09d}.json", after)
        for r in gone:
            self.runs.drop(r["name"])

    def _newest_in(self, name: str) -> int | None:
        return self.runs.read([name]).agg(F.max(F.unix_micros(F.col("last_seen").cast("timestamp")))).first()[0]

    def _settle(self, state: dict) -> list[dict]:
        """Merge crowded levels of live state and ledger; returns the runs that the new state needs no more."""
        gone = []
        for place in ("live", "ledger"):
            while (level := crowded_level(state[place], self.fanout)) is not None:
                old = [r for r in state[place] if r["level"] == level]
                name = f"merged-{state['batch']:09d}-{place}-{level + 1}"
                self.runs.write(self._records(old), name, dealt=True)
                made = {"name": name, "level": level + 1, "newest": max((r["newest"] for r in old if r["newest"] is not None), default=None)}
                state[place] = [*[r for r in state[place] if r not in old], made]
                gone += old
        return gone

    def messages(self) -> DataFrame:
        """Every message seen so far with its kept copy and number of copies: live state and ledger together."""
        now = self.state()
        found = self._records([*now["live"], *now["ledger"]])
        return self.spark.createDataFrame([], MESSAGES) if found is None else found


def dedup_stream(spark: SparkSession, source: str, path: str, horizon: str = "1 day", max_files: int | None = None, max_bytes: str | None = None) -> SeenStore:
    """Run the store over everything new at ``source``; a later call with the same ``path`` takes only what has come since."""
    store = SeenStore(spark, f"{path}/seen", horizon)
    reader = spark.readStream.schema(spark.read.parquet(source).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    query = reader.parquet(stream_path(source)).writeStream.foreachBatch(store.apply).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return store


def kept_copies(messages: DataFrame, repeated_only: bool = False) -> DataFrame:
    """The copy to keep of each message; with ``repeated_only`` of those with more than one row."""
    chosen = messages.filter("n > 1") if repeated_only else messages
    return chosen.select("event_id", "canonical_payload_hash", F.col("kept.kafka_partition").alias("kafka_partition"), F.col("kept.kafka_offset").alias("kafka_offset"))


def one_copy(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """``rows`` with exactly one row of each message: its kept copy. Rows without identifier all stay.

    Only messages with several rows are looked up; all other rows pass. Where several rows share the kept place (a row written
    twice, perhaps spelled otherwise) the least by its columns stays.
    """
    keyed = rows.withColumn("__e", plain_key("event_id")).withColumn("__h", F.coalesce(plain_key("canonical_payload_hash"), F.lit("")))
    repeated = messages.filter("n > 1").select(F.col("event_id").alias("__e"), F.col("canonical_payload_hash").alias("__h"), F.col("kept").alias("__kept"))
    met = keyed.join(repeated, ["__e", "__h"], "left")
    same = F.lit(True)
    for c in ("kafka_timestamp", "kafka_partition", "kafka_offset"):
        same = same & F.col(c).eqNullSafe(F.col(f"__kept.{c}"))
    # both branches read one exchange
    single = met.filter(F.col("__kept").isNotNull() & same).groupBy("__e", "__h").agg(F.min(F.struct(*rows.columns)).alias("__row")).select("__row.*")
    return met.filter("__kept IS NULL").select(*rows.columns).unionByName(single)
