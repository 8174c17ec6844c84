"""Sorted runs of keyed records, in hash buckets.

A run is an immutable folder whose rows lie in a fixed number of hash buckets by key, one file each, sorted by key. All runs of a
store have the same buckets and are opened as one relation, so that a task reads one bucket of all of them: grouping by key, or a
join with rows dealt to the same buckets, moves no run through a shuffle. (A union of runs won't do: over columnar scans Spark
4.1 lets it claim the partitioning of its parts without keeping it.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import files as control


class Runs:
    """Runs below ``path``, by the names of their folders."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets

    def dealt(self, rows: DataFrame, grouped: bool = False) -> DataFrame:
        """Rows in the partitioning of the runs. Rows just ``grouped`` by the keys are in it already where the session shuffles into as many parts."""
        if grouped and int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) == self.buckets:
            return rows
        return rows.repartition(self.buckets, *self.keys)

    def write(self, rows: DataFrame, name: str, dealt: bool = False) -> None:
        """Write a run; one that is there under this name, left by a batch that failed, is replaced."""
        if not control.exists(self.spark, f"{self.path}/schema.json"):
            control.write_text(self.spark, f"{self.path}/schema.json", rows.schema.json())
        table = f"tidemark_run_{uuid.uuid4().hex}"  # only tables can be written in buckets; the folder stays when the table is dropped
        writer = (rows if dealt else self.dealt(rows)).write.mode("overwrite").option("path", f"{self.path}/{name}")
        writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(table)
        rows.sparkSession.sql(f"DROP TABLE {table}")

    def read(self, names: list[str]) -> DataFrame | None:
        """All rows of some runs, bucket by bucket."""
        if not names:
            return None
        paths, jvm, session = [f"{self.path}/{n}" for n in names], self.spark.sparkContext._jvm, self.spark._jsparkSession
        to = jvm.org.apache.spark.api.python.PythonUtils
        some, keys = jvm.scala.Option.apply, to.toSeq(self.keys)
        schema = jvm.org.apache.spark.sql.types.DataType.fromJson(control.read_text(self.spark, f"{self.path}/schema.json"))  # a run without rows has no file
        buckets = jvm.org.apache.spark.sql.catalyst.catalog.BucketSpec(self.buckets, keys, keys)
        source = jvm.org.apache.spark.sql.execution.datasources.DataSource(session, "parquet", to.toSeq(paths), some(schema), to.toSeq([]), some(buckets), to.toScalaMap({}), some(None))
        return DataFrame(session.baseRelationToDataFrame(source.resolveRelation(True, True)), self.spark)

    def drop(self, name: str) -> None:
        if control.exists(self.spark, f"{self.path}/{name}"):
            control.delete(self.spark, f"{self.path}/{name}")


def crowded_level(runs: list[dict], fanout: int) -> int | None:
    """The lowest level that holds ``fanout`` runs and is to be merged into one run of the next: each row is rewritten once a level."""
    counts: dict[int, int] = {}
    for run in runs:
        counts[run["level"]] = counts.get(run["level"], 0) + 1
    return min((level for level, n in counts.items() if n >= fanout), default=None)
