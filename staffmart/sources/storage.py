"""Folders of written tables, through Hadoop's file systems (any store that Spark can read)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without Spark's own marks; none if there is no such folder."""
    place, fs = _place(spark, path)
    if not fs.exists(place):
        return []
    found = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(n for n in found if not n.startswith(("_", ".")))


def partitions(spark: SparkSession, path: str, columns: list[str]) -> list[tuple[str, ...]]:
    """Values of the partition folders (``column=value`` at each level), as written."""
    if not columns:
        return [()]
    head = f"{columns[0]}="
    return [(n[len(head):], *rest) for n in names(spark, path) if n.startswith(head) for rest in partitions(spark, f"{path}/{n}", columns[1:])]


def delete(spark: SparkSession, path: str) -> None:
    place, fs = _place(spark, path)
    fs.delete(place, True)
