"""Small control files on any Hadoop file system: manifests, states, markers. Data never goes this way.

A control file is whole or absent: its content is written under a hidden name first and then given its own by one atomic step, a
rename that replaces the old file or, for names that must be free, one that fails if the name is taken. A crash at any moment
leaves the old file, the new one, or none, and at most a hidden file that no reader looks at.
"""

from __future__ import annotations

import json
import os
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


class FileExists(Exception):
    """Another writer has taken the name."""


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def step(name: str, path: str) -> None:
    """Called before and after each change of a control file; tests raise in it."""


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    step("delete", path)
    done = fs.delete(p, True)
    step("deleted", path)
    return done


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_json(spark: SparkSession, path: str):
    return json.loads(read_text(spark, path))


def _write_local(target: Path, text: str, exclusive: bool) -> None:
    """Rename and link are atomic within a folder; the folder is synced, so that the name too survives a loss of power."""
    target.parent.mkdir(parents=True, exist_ok=True)
    hidden = target.with_name(f".{target.name}.{uuid.uuid4().hex}.tmp")
    try:
        with hidden.open("w", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        step("written", str(target))
        if exclusive:
            os.link(hidden, target)
        else:
            os.replace(hidden, target)
        folder = os.open(target.parent, os.O_RDONLY)
        try:
            os.fsync(folder)
        finally:
            os.close(folder)
    except FileExistsError as error:
        raise FileExists(str(target)) from error
    finally:
        hidden.unlink(missing_ok=True)


def _write_hadoop(spark: SparkSession, fs, p, text: str, exclusive: bool) -> None:
    """``FileContext`` renames in one step on the name node, with or without taking the place of an old file."""
    jvm = spark.sparkContext._jvm
    hidden = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
        stream.hsync()
    finally:
        stream.close()
    step("written", p.toString())
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE if exclusive else jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(hidden, p, how)
    except Exception as error:
        fs.delete(hidden, False)
        if exclusive and fs.exists(p):
            raise FileExists(p.toString()) from error
        raise


def write_text(spark: SparkSession, path: str, text: str, exclusive: bool = False) -> None:
    """Write a whole file. With ``exclusive`` the name must be free, else the new content takes the old one's place."""
    fs, p = file_system(spark, path)
    step("write", path)
    if exclusive and fs.exists(p):
        raise FileExists(path)
    if fs.getUri().getScheme() == "file":
        _write_local(Path(p.toUri().getPath()), text, exclusive)
    else:
        _write_hadoop(spark, fs, p, text, exclusive)
    step("shown", path)


def write_json(spark: SparkSession, path: str, value: object, exclusive: bool = False) -> None:
    write_text(spark, path, json.dumps(value, sort_keys=True), exclusive)


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> list[tuple[str, int, float]]:
    """``(path, bytes, modified)`` of the files below a folder, sorted; an absent folder is empty. Hidden names are passed over."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    found = []
    iterator = fs.listFiles(p, recursive)
    while iterator.hasNext():
        status = iterator.next()
        if not status.getPath().getName().startswith((".", "_")):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime() / 1000))
    return sorted(found)
