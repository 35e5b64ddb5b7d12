"""A log of numbered entries that several writers may append to at once.

Each entry is a small file named by its number. It is written beside its place and then put
there only if nothing is there yet, in one step of the file system; a writer that comes second
takes the next number. So no number is given twice, and a reader sees whole entries only.

The step is a link on local file systems and a rename that never replaces elsewhere. Both are
atomic where the file system's own are, as on HDFS; a store without atomic renames needs a
committer of its own.
"""

from __future__ import annotations

import os
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tillwise.sources.files import exists, located

DIGITS = 19


def append(spark: SparkSession, log: str, text: str) -> int:
    """Enter a text under the next free number and return it."""
    while True:
        number = max(numbers(spark, log), default=0) + 1
        if create(spark, entry(log, number), text):
            return number


def entry(log: str, number: int) -> str:
    return f"{log}/{number:0{DIGITS}d}"


def numbers(spark: SparkSession, log: str) -> list[int]:
    """The numbers in use, ascending; none if there is no log."""
    if not exists(spark, log):
        return []
    place, system = located(spark, log)
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return sorted(int(name) for name in names if len(name) == DIGITS and name.isdecimal())


def read(spark: SparkSession, log: str, number: int) -> str:
    return read_text(spark, entry(log, number))


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    place, system = located(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file as a whole if none is there; False if one is."""
    place, system = located(spark, path)
    system.mkdirs(place.getParent())
    beside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid4().hex}")
    stream = system.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        local = system.getUri().getScheme() == "file"
        return (_linked if local else _renamed)(spark, system.makeQualified(beside), system.makeQualified(place))
    finally:
        system.delete(beside, False)


def _linked(spark: SparkSession, beside, place) -> bool:
    try:
        os.link(beside.toUri().getPath(), place.toUri().getPath())
    except FileExistsError:
        return False
    return True


def _renamed(spark: SparkSession, beside, place) -> bool:
    """Rename without replacing."""
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    never_replace = spark.sparkContext._gateway.new_array(rename, 1)
    never_replace[0] = rename.NONE
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf).rename(beside, place, never_replace)
    except Py4JJavaError as failed:
        if "FileAlreadyExistsException" not in failed.java_exception.getClass().getName():
            raise
        return False
    return True
