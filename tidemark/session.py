"""Session factory and the shared working folder of a job."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import file_system


def build_session(app: str = "tidemark", cores: int | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE with skew splitting, and local cores when no master is given by spark-submit."""
    builder = SparkSession.builder.appName(app)
    if cores is not None:
        builder = builder.master(f"local[{cores}]")
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions is not None:
        base["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**base, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables that a job writes and reads again; it is deleted when the application ends.

    It lies below the folder named by ``spark.checkpoint.dir``, else the one given to ``setCheckpointDir``, which all executors
    share, so that a lost executor loses no data. Only a local session without either (tests) gets a temporary folder; on a
    cluster that would be a different disk for every executor, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
    fs, folder = file_system(spark, path)
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return path


def spread(rows: DataFrame) -> DataFrame:
    """Rows over at least as many tasks as there are cores: a small table in one file would else keep one core busy.

    A table of more files than cores is left as it is, so nothing is moved at scale.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: on a cluster they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tidemark-package-")) / "tidemark_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(Path(root.name) / file.relative_to(root)))
    context.addPyFile(str(target))
    context._tidemark_shipped = True
