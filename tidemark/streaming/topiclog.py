"""A message log on plain files with the columns of a Kafka source, for places without a broker.

``<path>/partition=<n>/<first offset>.jsonl`` holds one message per line: offset, timestamp (milliseconds), key, value. Offsets
below the first kept one are gone; a query that still needs them fails loudly unless ``failOnDataLoss`` is false.

``maxOffsetsPerTrigger`` bounds a batch, shared out by each partition's backlog. Spark does not tell a Python source where its checkpoint
stands, so the source keeps where it got to in ``progressFile`` (one per query, beside its checkpoint); without that file the first
batch after a start is the whole backlog.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidemark.session import ship_package

SCHEMA = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


class DataLoss(RuntimeError):
    """Offsets that a query still needs are no longer kept."""


class TopicWriter:
    """Appends messages; each call adds one segment per partition."""

    def __init__(self, path: str, partitions: int = 1) -> None:
        self.path, self.partitions = Path(path), partitions
        for n in range(partitions):
            (self.path / f"partition={n}").mkdir(parents=True, exist_ok=True)

    def append(self, messages: list[tuple[str | None, str | None]], at: dt.datetime | None = None) -> None:
        stamp = int((at or dt.datetime.now(dt.UTC)).timestamp() * 1000)
        by_partition: dict[int, list[tuple[str | None, str | None]]] = {}
        for i, (key, value) in enumerate(messages):
            by_partition.setdefault((sum(key.encode()) if key else i) % self.partitions, []).append((key, value))
        for n, part in by_partition.items():
            first = _ends(self.path)[n][1]
            lines = [json.dumps({"offset": first + k, "timestamp": stamp, "key": key, "value": value}) for k, (key, value) in enumerate(part)]
            target = self.path / f"partition={n}" / f"{first:020d}.jsonl"
            temporary = target.with_suffix(".tmp")
            temporary.write_text("\n".join(lines) + "\n")
            os.replace(temporary, target)

    def drop_before(self, partition: int, offset: int) -> None:
        """Retention: remove whole segments below an offset."""
        segments = _segments(self.path / f"partition={partition}")
        for (first, file), following in zip(segments, segments[1:], strict=False):
            if following[0] <= offset:
                file.unlink()


def _segments(folder: Path) -> list[tuple[int, Path]]:
    return sorted((int(f.stem), f) for f in folder.glob("*.jsonl"))


def _lines(file: Path) -> int:
    with file.open("rb") as f:
        return sum(1 for _ in f)


def _ends(path: Path) -> dict[int, tuple[int, int]]:
    """First kept and next offset of each partition."""
    ends = {}
    for folder in sorted(Path(path).glob("partition=*")):
        segments = _segments(folder)
        ends[int(folder.name.split("=")[1])] = (segments[0][0], segments[-1][0] + _lines(segments[-1][1])) if segments else (0, 0)
    return ends


class Span(InputPartition):
    def __init__(self, partition: int, start: int, end: int) -> None:
        self.partition, self.start, self.end = partition, start, end


class _Reading:
    def __init__(self, options: dict[str, str]) -> None:
        self.path = Path(options["path"])
        self.topic = options.get("topic", self.path.name)
        self.strict = options.get("failOnDataLoss", "true").lower() == "true"
        self.limit = int(options.get("maxOffsetsPerTrigger", 0))
        self.progress = Path(options["progressFile"]) if "progressFile" in options else None

    def _read(self, span: Span) -> Iterator[tuple]:
        for first, file in _segments(self.path / f"partition={span.partition}"):
            if first >= span.end or first + _lines(file) <= span.start:
                continue
            with file.open() as lines:
                for line in lines:
                    m = json.loads(line)
                    if span.start <= m["offset"] < span.end:
                        yield (m["key"], m["value"], self.topic, span.partition, m["offset"], dt.datetime.fromtimestamp(m["timestamp"] / 1000, dt.UTC))


class TopicReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Span]:
        return [Span(n, a, b) for n, (a, b) in _ends(self.path).items()]

    def read(self, partition: Span) -> Iterator[tuple]:
        return self._read(partition)


def _shared_out(backlog: dict[str, int], limit: int) -> dict[str, int]:
    """At most ``limit`` in all, in proportion to the backlogs; what rounding leaves goes to the largest."""
    whole = sum(backlog.values())
    if whole <= limit:
        return backlog
    parts = {n: limit * b // whole for n, b in backlog.items()}
    for n in sorted(backlog, key=lambda n: -backlog[n]):
        parts[n] += min(limit - sum(parts.values()), backlog[n] - parts[n])
    return parts


class TopicStream(_Reading, DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        super().__init__(options)
        self.reached: dict[str, int] | None = None

    def initialOffset(self) -> dict[str, int]:
        return {str(n): a for n, (a, _) in _ends(self.path).items()}

    def latestOffset(self) -> dict[str, int]:
        latest = {str(n): b for n, (_, b) in _ends(self.path).items()}
        if not self.limit:
            return latest
        if self.reached is None and self.progress is None:
            self.reached = latest
            return latest
        if self.reached is None:  # what is written is never behind the checkpoint, as an offset is logged after it was given
            self.reached = json.loads(self.progress.read_text()) if self.progress.exists() else self.initialOffset()
        backlog = {n: max(0, b - self.reached.get(n, 0)) for n, b in latest.items()}
        self.reached = {n: self.reached.get(n, 0) + take for n, take in _shared_out(backlog, self.limit).items()}
        if self.progress is None:
            return self.reached
        self.progress.parent.mkdir(parents=True, exist_ok=True)
        temporary = self.progress.with_suffix(".tmp")
        temporary.write_text(json.dumps(self.reached))
        os.replace(temporary, self.progress)
        return self.reached

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Span]:
        ends, spans = _ends(self.path), []
        for n, upto in end.items():
            first, begin = ends.get(int(n), (0, 0))[0], start.get(n, 0)
            if begin < first:
                if self.strict:
                    raise DataLoss(f"partition {n}: offsets {begin} to {first - 1} are no longer kept")
                begin = first
            if begin < upto:
                spans.append(Span(int(n), begin, upto))
        return spans

    def read(self, partition: Span) -> Iterator[tuple]:
        return self._read(partition)


class TopicLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topiclog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TopicReader:
        return TopicReader(self.options)

    def streamReader(self, schema: StructType) -> TopicStream:
        return TopicStream(self.options)


def messages(spark: SparkSession, path: str, streaming: bool = True, **options: str) -> DataFrame:
    ship_package(spark)
    spark.dataSource.register(TopicLogSource)
    reader = spark.readStream if streaming else spark.read
    return reader.format("topiclog").options(path=path, **options).load()


def kafka_messages(spark: SparkSession, servers: str, topic: str, fail_on_data_loss: bool = True, max_offsets: int | None = None) -> DataFrame:
    """The same columns from a broker; needs Spark's Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return spark.readStream.format("kafka").options(**options).load()
