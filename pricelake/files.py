"""Folders of the shared store, through the file system that Spark itself uses."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """(name, time of the last change in ms) of what a folder holds, read bit by bit.

    Nothing where there is no such folder.
    """
    system, where = _at(spark, path)
    if not system.exists(where):
        return
    found = system.listStatusIterator(where)
    while found.hasNext():
        status = found.next()
        yield status.getPath().getName(), status.getModificationTime()


def delete(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def delete_if_empty(spark: SparkSession, path: str) -> None:
    if next(children(spark, path), None) is None:
        delete(spark, path)
