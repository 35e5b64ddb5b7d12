"""Existence and removal of paths in whatever file system Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """A path and the file system it lies in, as Hadoop's own objects."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = located(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with all it holds; nothing happens if it is not there."""
    place, system = located(spark, path)
    system.delete(place, True)
