"""Folders and small files in any store that Spark can reach."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def found(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, which may hold wildcards, matches anything."""
    store, place = _store(spark, pattern)
    return bool(store.globStatus(place))


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern."""
    store, place = _store(spark, pattern)
    return sorted(str(x.getPath().toString()) for x in store.globStatus(place) or [] if x.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    store, place = _store(spark, path)
    store.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target's parent is made, the target itself must not exist."""
    store, place = _store(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    store.mkdirs(goal.getParent())
    if not store.rename(place, goal):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old or the new text."""
    store, place = _store(spark, f"{path}.new")
    out = store.create(place, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    jvm = spark._jvm
    goal = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(place, goal, options)


def read_text(spark: SparkSession, path: str) -> str:
    return "".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place unless one is there; tells whether it was this one."""
    store, place = _store(spark, f"{path}.{uuid.uuid4().hex}.new")
    jvm = spark._jvm
    goal = jvm.org.apache.hadoop.fs.Path(path)
    out = store.create(place, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(place, goal, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        store.delete(place, False)
        return False


def load(spark: SparkSession, path: str) -> str:
    """The text of a small file, read on the driver."""
    store, place = _store(spark, path)
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files of a folder; none where there is no folder."""
    store, place = _store(spark, folder)
    if not store.exists(place):
        return []
    return sorted(str(x.getPath().getName()) for x in store.listStatus(place) if x.isFile())


def modified(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in seconds since 1970."""
    store, place = _store(spark, path)
    return store.getFileStatus(place).getModificationTime() / 1000
