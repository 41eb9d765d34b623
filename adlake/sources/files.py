"""Small files beside the tables: lists, commits and manifests, on any file system that Spark reads."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


#: Folders that a session's queries have made, until clean_up().
_MADE: dict[str, set[str]] = {}


def made(spark: SparkSession, path: str) -> str:
    """Remember a folder as one that clean_up() deletes."""
    _MADE.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a folder now."""
    _MADE.get(spark.sparkContext.applicationId, set()).discard(path)
    delete(spark, path)


def clean_up(spark: SparkSession) -> int:
    """Delete all folders that queries of this session have left in the shared folder; frames that read them can't be used any more."""
    paths = _MADE.pop(spark.sparkContext.applicationId, set())
    for path in paths:
        delete(spark, path)
    return len(paths)


def _at(spark: SparkSession, path: str):
    """Path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder and when each was changed (milliseconds); none if the folder is missing."""
    path, fs = _at(spark, folder)
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(path)} if fs.exists(path) else {}


def read_small(spark: SparkSession, file: str) -> str:
    path, fs = _at(spark, file)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, file: str, text: str) -> bool:
    """Write a file whole or not at all; False if there is one of the name already, which stays."""
    path, fs = _at(spark, file)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}-{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(path), options)
        return True
    except Py4JJavaError as e:
        fs.delete(temporary, False)
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)
