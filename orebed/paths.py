"""Folder helpers that work on any file system Spark can reach."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _resolve(spark, path)
    return files.exists(target)


def make_dirs(spark: SparkSession, path: str) -> None:
    files, target = _resolve(spark, path)
    files.mkdirs(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    files, target = _resolve(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def remove(spark: SparkSession, path: str) -> None:
    files, target = _resolve(spark, path)
    files.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or None if there is none."""
    files, target = _resolve(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, text: str, over: bool) -> None:
    """Write a small file aside and rename it, over an old one or only if there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    files, target = _resolve(spark, path)
    aside = hadoop.Path(f"{path}.{uuid.uuid4().hex}.part")
    stream = files.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE if over else kind.NONE
    try:
        hadoop.FileContext.getFileContext(files.getUri(), conf).rename(files.makeQualified(aside), files.makeQualified(target), options)
    except Py4JJavaError:
        files.delete(aside, False)
        raise


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place whole. A reader sees the old text or the new one, never none."""
    _put(spark, path, text, over=True)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place whole unless there is one already. False if there is."""
    try:
        _put(spark, path, text, over=False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True
