"""Small files in the shared folder: names, pointers, atomic publication (Hadoop's file system API)."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


@contextlib.contextmanager
def unsorted_writes(spark: SparkSession, writers: int):
    """Writes inside keep up to ``writers`` partition folders of a task open at once and do not sort their rows by folder
    (a task with more folders sorts the rest)."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, writers)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds; a folder that is not there holds nothing."""
    fs = _fs(spark, folder)
    if not fs.exists(_path(spark, folder)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, folder)))


def total_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder."""
    return _fs(spark, folder).getContentSummary(_path(spark, folder)).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all; one that is there already is a conflict, not replaced."""
    fs, draft = _fs(spark, path), f"{path}.{uuid.uuid4().hex}.draft"
    stream = fs.create(_path(spark, draft), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(_path(spark, path)) or not fs.rename(_path(spark, draft), _path(spark, path)):
        fs.delete(_path(spark, draft), False)
        raise FileExistsError(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs = _fs(spark, source)
    fs.mkdirs(_path(spark, target).getParent())
    if not fs.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"{source} could not become {target}")


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)
