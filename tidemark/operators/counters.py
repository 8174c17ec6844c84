"""Per-period counts and amounts by event time, corrected by late rows until a cut-off.

Counters are conflict-free: a state holds entries per period, country and source, where a source is a topic partition's part of one
batch of arrivals, or of all batches up to one, and its version is the highest sequence number counted. Merging takes per source
the entry with the highest version, the value is the sum over sources; both are idempotent and independent of order, so
retries, repeated states and reordering cannot change a result. Each batch adds entries, also to periods long past: that
is how a late row corrects them. A row delivered again in a later batch is found in bitmaps of the sequence numbers counted.

The cut-off is a max-register of event times: a batch starts with the register of the batches before it, and within the batch
it runs along range parts in the order of arrival.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampNTZType, TimestampType

from tidemark.session import ship_package
from tidemark.sources import files as control

#: A row is too late if its event time lies further than this before the highest event time that arrived before it.
CUT_OFF = "36 hours"
#: A row whose event time lies further than this after its arrival has a wrong clock and is left aside.
AHEAD = "1 hour"
ARRIVAL = ("kafka_timestamp", "kafka_partition", "kafka_offset")
STATES = "event_day date, country string, source int, since int, batch int, seq bigint, orders bigint, amount decimal(38,2)"
COUNTER = ("event_day", "country", "source")
#: Sequence numbers of one bitmap.
BITS = 32_768


def usable(rows: DataFrame, ahead: str = AHEAD) -> DataFrame:
    """Rows with an event time that is not too far after their arrival. A NULL arrival time leaves a row aside as well."""
    return rows.filter(F.col("event_time").isNotNull() & (F.col("event_time") <= F.col("kafka_timestamp") + F.expr(f"INTERVAL {ahead}")))


# --- the cut-off -----------------------------------------------------------------------------------------------------------
def _whole_numbers(column: pa.Array) -> np.ndarray:
    lowest = np.iinfo(np.int64).min  # NULL comes first
    whole = column.cast(pa.timestamp("us", tz=column.type.tz)).cast(pa.int64()) if pa.types.is_timestamp(column.type) else column.cast(pa.int64())
    return whole.fill_null(lowest).to_numpy(zero_copy_only=False)


def _run_register(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``__part`` and ``__own_high``, the highest event time of the part's rows that arrived before; rows of one place in the order don't precede each other."""
    lowest = np.iinfo(np.int64).min
    part, high, before, last = TaskContext.get().partitionId(), lowest, lowest, None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        times = _whole_numbers(batch.column(names.index("event_time")))
        places = np.stack([_whole_numbers(batch.column(names.index(c))) for c in ARRIVAL])
        first = np.ones(len(times), dtype=bool)  # the first row of its place
        first[1:] = (places[:, 1:] != places[:, :-1]).any(axis=0)
        first[0] = last is None or bool((places[:, 0] != last).any())
        reached = np.maximum.accumulate(np.maximum(times, high))
        exclusive = np.concatenate([[high], reached[:-1]])
        start = np.maximum.accumulate(np.where(first, np.arange(len(times)), -1))
        own = np.where(start >= 0, exclusive[np.maximum(start, 0)], before)
        high, before, last = reached[-1], own[-1], places[:, -1]
        kind = batch.column(names.index("event_time")).type
        column = pa.array(own, mask=own == lowest, type=pa.int64()).cast(pa.timestamp("us", tz=kind.tz))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(times), part, dtype=np.int32)), column], names=[*names, "__part", "__own_high"])


def in_order(rows: DataFrame) -> DataFrame:
    """Usable rows in range parts by arrival, sorted, with the register run along each part: one shuffle. To be stored before it is used.

    The parts follow the data's own quantiles, so a time span that holds a third of all rows is cut into many parts.
    """
    ship_package(rows.sparkSession)
    place = [F.col(c) for c in ARRIVAL]
    sorted_parts = rows.repartitionByRange(*place).sortWithinPartitions(*place)
    kind = TimestampNTZType() if dict(rows.dtypes)["event_time"] == "timestamp_ntz" else TimestampType()
    schema = StructType([*rows.schema.fields, StructField("__part", IntegerType()), StructField("__own_high", kind)])
    return sorted_parts.mapInArrow(_run_register, schema)


def mark_late(stored: DataFrame, register: Column | None = None, cut_off: str = CUT_OFF) -> DataFrame:
    """``late`` for stored rows of ``in_order``: the registers of the parts before are merged by maximum, one row per part, with ``register``, that of all earlier batches."""
    highs = stored.groupBy("__part").agg(F.max("event_time").alias("high"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = highs.select("__part", F.max("high").over(before).alias("__carried"))
    # one row per part: at most the number of shuffle partitions
    joined = stored.join(F.broadcast(carried), "__part")
    high = F.greatest("__own_high", "__carried") if register is None else F.greatest("__own_high", "__carried", register)
    return joined.withColumn("late", F.coalesce(F.col("event_time") < high - F.expr(f"INTERVAL {cut_off}"), F.lit(False))).drop("__part", "__own_high", "__carried")


# --- the counters ----------------------------------------------------------------------------------------------------------
def counter_states(rows: DataFrame, batch: int = 0) -> DataFrame:
    """Entries of one batch of accepted rows; the source is the topic's partition (-1 where it is NULL) within the batch.

    A row delivered twice within the batch (same source and sequence) counts once, a row without sequence for itself. NULL amounts
    add nothing, a NULL or blank country is its own group, countries are compared in upper case.
    """
    country = F.nullif(F.upper(F.btrim("country", F.lit(" \t"))), F.lit(""))
    placed = rows.select(F.to_date("event_time").alias("event_day"), country.alias("country"), _source().alias("source"), F.col("kafka_offset").alias("seq"), F.col("amount").cast("decimal(18,2)").alias("amount"))
    numbered = placed.filter("seq IS NOT NULL").dropDuplicates(["source", "seq", "event_day", "country"])
    counted = numbered.unionByName(placed.filter("seq IS NULL")).groupBy(*COUNTER).agg(
        F.max("seq").alias("seq"), F.count(F.lit(1)).alias("orders"), F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(38,2)").alias("amount")
    )
    return counted.select(*COUNTER, F.lit(batch).alias("since"), F.lit(batch).alias("batch"), "seq", "orders", "amount")


def _source() -> Column:
    return F.coalesce(F.col("kafka_partition").cast("int"), F.lit(-1))


def merge_states(*states: DataFrame) -> DataFrame:
    """Per source the entry with the highest version. An entry that covers all batches up to one takes the place of those it covers."""
    every = reduce(DataFrame.unionByName, states)
    best = every.groupBy(*COUNTER, "since", "batch").agg(F.max(F.struct("seq", "orders", "amount")).alias("s"))
    # entries per counter: at most one a batch since the last compaction
    covered = F.max(F.when(F.col("since") == 0, F.col("batch"))).over(Window.partitionBy(*COUNTER))
    kept = best.withColumn("covered", covered).filter("covered IS NULL OR batch > covered OR (since = 0 AND batch = covered)")
    return kept.select(*COUNTER, "since", "batch", "s.seq", "s.orders", "s.amount")


def compacted(states: DataFrame, upto: int) -> DataFrame:
    """Merged states of all batches up to one as a single entry per counter and partition."""
    return states.groupBy(*COUNTER).agg(F.max("seq").alias("seq"), F.sum("orders").alias("orders"), F.sum("amount").cast("decimal(38,2)").alias("amount")).select(*COUNTER, F.lit(0).alias("since"), F.lit(upto).alias("batch"), "seq", "orders", "amount")


def counter_values(states: DataFrame) -> DataFrame:
    """``(event_day, country, orders, amount)``: the sum over sources."""
    return states.groupBy("event_day", "country").agg(F.sum("orders").alias("orders"), F.sum("amount").cast("decimal(38,2)").alias("amount"))


def _bit(bitmap: Column, place: Column) -> Column:
    """Whether a bit of a bitmap (as built by ``bitmap_construct_agg``, least significant bit of each byte first) is set."""
    byte = F.conv(F.hex(bitmap.substr((F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def _bitmaps(rows: DataFrame) -> DataFrame:
    """The sequence numbers of rows as bitmaps per source and block."""
    numbered = rows.filter("kafka_offset IS NOT NULL").select(_source().alias("source"), F.col("kafka_offset").alias("seq"))
    return numbered.groupBy("source", F.floor(F.col("seq") / BITS).alias("block")).agg(F.bitmap_construct_agg(F.pmod("seq", F.lit(BITS))).alias("bits"))


class CounterStore:
    """State below ``path``: ``batch=<n>/rows|counters|late|seen`` and ``commits/<n>.json`` with the register and each source's highest sequence.

    A batch counts once its commit file is there; a batch applied again replaces its own output. Batches are numbered in the order of
    arrival and each needs the register of those before it.
    """

    def __init__(self, spark: SparkSession, path: str, cut_off: str = CUT_OFF, ahead: str = AHEAD) -> None:
        self.spark, self.path, self.cut_off, self.ahead = spark, path.rstrip("/"), cut_off, ahead

    def commits(self) -> dict[int, dict]:
        """One small record per batch."""
        found = [control.read_json(self.spark, p) for p, _, _ in control.list_files(self.spark, f"{self.path}/commits")]
        return {c["batch"]: c for c in sorted(found, key=lambda c: c["batch"])}

    def _read(self, what: str, batches: list[int]) -> DataFrame | None:
        paths = [p for n in batches if control.exists(self.spark, p := f"{self.path}/batch={n}/{what}")]
        return self.spark.read.parquet(*paths) if paths else None

    def apply(self, rows: DataFrame, number: int) -> None:
        """Take one batch of arrivals: rows beyond the cut-off are kept as late, all others are added to the counters."""
        earlier = {n: c for n, c in self.commits().items() if n < number}
        if len(earlier) < number:
            raise ValueError(f"batch {number} comes before {sorted(set(range(number)) - set(earlier))}")
        here = f"{self.path}/batch={number}"
        in_order(usable(rows, self.ahead)).write.mode("overwrite").parquet(f"{here}/rows")
        stored = self.spark.read.parquet(f"{here}/rows")
        high = max((c["high"] for c in earlier.values() if c["high"] is not None), default=None)
        register = None if high is None else F.timestamp_micros(F.lit(high)).cast(dict(stored.dtypes)["event_time"])
        marked = mark_late(stored, register, self.cut_off)
        accepted = marked.filter("NOT late").drop("late")
        outputs = {"late": lambda: marked.filter("late").drop("late")}
        if "amount" in rows.columns:
            outputs["counters"] = lambda: counter_states(self._unseen(accepted, earlier), number)
            outputs["seen"] = lambda: _bitmaps(accepted)
        ends = stored.groupBy(_source().alias("source")).agg(F.max("kafka_offset").alias("seq"), F.max(F.unix_micros(F.col("event_time").cast("timestamp"))).alias("high"))
        with ThreadPoolExecutor() as pool:  # the outputs don't wait for each other
            writes = [pool.submit(lambda w=what, f=frame: f().write.mode("overwrite").parquet(f"{here}/{w}")) for what, frame in outputs.items()]
            ends = ends.collect()  # one row per topic partition
            for w in writes:
                w.result()
        commit = {"batch": number, "high": max((r.high for r in ends), default=None), "seqs": {str(r.source): r.seq for r in ends if r.seq is not None}}
        control.write_json(self.spark, f"{self.path}/commits/{number}.json", commit)
        control.delete(self.spark, f"{here}/rows")

    def _unseen(self, rows: DataFrame, earlier: dict[int, dict]) -> DataFrame:
        """Rows whose sequence number no earlier batch has counted. Only those not beyond a source's highest number are looked up."""
        reached: dict[str, int] = {}
        for c in earlier.values():
            reached |= {s: max(n, reached.get(s, n)) for s, n in c["seqs"].items()}
        seen = self._read("seen", list(earlier))
        if not reached or seen is None:
            return rows
        highest = F.element_at(F.create_map(*[F.lit(x) for s, n in reached.items() for x in (int(s), n)]), _source())  # one per topic partition
        again = F.coalesce(F.col("kafka_offset") <= highest, F.lit(False))
        keyed = rows.filter(again).withColumn("__source", _source()).withColumn("__block", F.floor(F.col("kafka_offset") / BITS))
        bitmaps = seen.groupBy("source", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        joined = keyed.join(bitmaps, (F.col("__source") == F.col("source")) & (F.col("__block") == F.col("block")), "left")
        fresh = joined.filter(F.col("bits").isNull() | ~_bit(F.col("bits"), F.pmod("kafka_offset", F.lit(BITS)))).select(*rows.columns)
        return rows.filter(~again).unionByName(fresh)

    def states(self) -> DataFrame:
        """The merged counters of all batches; compacted ones stand for the batches they cover."""
        found = [s for s in (self._read("counters", list(self.commits())), self._base()) if s is not None]
        return merge_states(*found) if found else self.spark.createDataFrame([], STATES)

    def _base(self) -> DataFrame | None:
        path = f"{self.path}/base.json"
        return self.spark.read.schema(STATES).parquet(f"{self.path}/{control.read_json(self.spark, path)['base']}") if control.exists(self.spark, path) else None

    def compact(self) -> None:
        """Sum the entries of all batches into one per counter and partition; a batch applied again afterwards adds nothing."""
        upto = max(self.commits(), default=None)
        if upto is None:
            return
        compacted(self.states(), upto).write.mode("overwrite").parquet(f"{self.path}/base-{upto}")
        control.write_json(self.spark, f"{self.path}/base.json", {"base": f"base-{upto}"})

    def totals(self) -> DataFrame:
        return counter_values(self.states())

    def late(self) -> DataFrame:
        """Rows that came after the cut-off, of all batches."""
        found = self._read("late", list(self.commits()))
        if found is None:
            raise LookupError("no batch has been applied")
        return found


def arrival_slices(rows: DataFrame, batches: int) -> list[DataFrame]:
    """Rows cut by arrival time into about equal batches, in order; each is a filter that reaches the scan. Rows without arrival time are in none."""
    micros = F.unix_micros(F.col("kafka_timestamp").cast("timestamp"))
    cuts = sorted(set(rows.agg(F.percentile_approx(micros, [i / batches for i in range(1, batches)], F.lit(1000))).first()[0] or []))
    kind = dict(rows.dtypes)["kafka_timestamp"]
    at = [F.timestamp_micros(F.lit(c)).cast(kind) for c in cuts]
    time = F.col("kafka_timestamp")
    if not at:
        return [rows.filter(time.isNotNull())]
    return [rows.filter(time < at[0]), *[rows.filter((time >= a) & (time < b)) for a, b in zip(at, at[1:], strict=False)], rows.filter(time >= at[-1])]


def run_batches(spark: SparkSession, rows: DataFrame, path: str, batches: int, cut_off: str = CUT_OFF, ahead: str = AHEAD) -> CounterStore:
    """A store fed with the rows in batches by arrival. Columns beyond those needed travel along."""
    store = CounterStore(spark, path, cut_off, ahead)
    for number, part in enumerate(arrival_slices(rows, batches)):
        store.apply(part, number)
    return store


def daily_totals(spark: SparkSession, rows: DataFrame, path: str, cut_off: str = CUT_OFF, ahead: str = AHEAD, batches: int = 2) -> DataFrame:
    """Corrected totals per event day and country from the rows in time."""
    return run_batches(spark, rows.select("country", "amount", "event_time", *ARRIVAL), path, batches, cut_off, ahead).totals()


def late_rows(spark: SparkSession, rows: DataFrame, path: str, cut_off: str = CUT_OFF, ahead: str = AHEAD, batches: int = 2) -> DataFrame:
    """Distinct ``(order_id, event_day)`` of rows that came after the cut-off, by the store that also counts the others."""
    late = run_batches(spark, rows.select("order_id", "country", "amount", "event_time", *ARRIVAL), path, batches, cut_off, ahead).late()
    return late.select("order_id", F.date_format("event_time", "yyyy-MM-dd").alias("event_day")).distinct()
