"""Small file operations on whichever file system a path names."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(target), system


def names_in(spark: SparkSession, path: str, folders: bool = True) -> list[str]:
    """Sorted names of the folders (or of the files) in a folder; none if it is not there."""
    target, system = _at(spark, path)
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory() == folders)


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was last changed."""
    target, system = _at(spark, path)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    return (now - system.getFileStatus(target).getModificationTime()) / 1000


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds; nothing if it is not there."""
    target, system = _at(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it is not there."""
    target, system = _at(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place whole, unless there is one already; whether it was put.

    It is written beside its place and renamed, which the file system must do
    at once and without replacing, as HDFS does.
    """
    target, system = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.draft")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files = spark._jvm.org.apache.hadoop.fs
    no_options = spark.sparkContext._gateway.new_array(getattr(files, "Options$Rename"), 0)
    try:
        files.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        system.delete(draft, False)
    return True
