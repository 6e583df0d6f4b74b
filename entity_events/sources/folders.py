"""Folders of partitioned tables by name: list them and drop them, without reading what they hold."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def values(spark: SparkSession, path: str, name: str) -> list[str]:
    """Values of the folders ``name=value`` right below a path; none where there is no such path."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    names = (status.getPath().getName() for status in system.listStatus(place) if status.isDirectory())
    return sorted(each.split("=", 1)[1] for each in names if each.startswith(f"{name}="))


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; nothing happens where it is gone already."""
    place, system = _place(spark, path)
    system.delete(place, True)
