"""Intermediate tables for results that a plan reads more than once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tillwise.sources.files import delete

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Only for local sessions that name no folder.
LOCAL_FOLDER = "/tmp/checkpoints"

_staged: list[str] = []

#: What was staged inside the innermost ``released_after`` of this thread.
_inside: ContextVar[list[str] | None] = ContextVar("inside", default=None)


def staging_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one for local sessions only."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master == "local" or master.startswith("local["):
        return LOCAL_FOLDER
    raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")


def new_folder(spark: SparkSession, label: str, folder: str | None = None) -> str:
    """A fresh path that ``release`` will remove."""
    path = f"{(folder or staging_folder(spark)).rstrip('/')}/{label}-{uuid4().hex}"
    _staged.append(path)
    if (inside := _inside.get()) is not None:
        inside.append(path)
    return path


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The upstream work is not repeated by later readers, columns stay prunable, and the
    rows survive the loss of any executor. Call ``release`` once the results are consumed.
    """
    path = new_folder(df.sparkSession, label, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove what this process has staged; plans that read the removed tables are used up."""
    while _staged:
        delete(spark, _staged.pop())


@contextmanager
def released_after(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, what was staged inside; other threads keep what is theirs."""
    inside: list[str] = []
    outer = _inside.set(inside)
    try:
        yield
    finally:
        _inside.reset(outer)
        for path in inside:
            if path in _staged:
                _staged.remove(path)
                delete(spark, path)
