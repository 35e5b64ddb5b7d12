"""Table access, stored steps and bounded sums over many tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.sources.staging import new_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder in the cluster's shared one; ``release`` of the staging module removes it."""
    return new_folder(spark, "llm")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage, outlives an executor."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_column: str = "doc_id"):
    """The rows that no label may be learned from: crc32 of the id as text divides by 5."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(payload: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), dtype)


SUM_SCHEMA = "part long, block int, payload binary"


def block_rows(part: int, values: np.ndarray, blocks: int):
    """A task's partial sums as rows of SUM_SCHEMA, one for each block with a value."""
    for block, cells in enumerate(np.split(values.reshape(-1), blocks)):
        if cells.any():
            yield part, block, pack(cells)


def tree_sum(partials: DataFrame, tasks: int, cells: int, blocks: int, dtype) -> np.ndarray:
    """Sum of the tasks' partial arrays of ``cells`` values (a fixed size, whatever the input).

    Rows of one block are added in two steps of about sqrt(tasks) rows each, so no group grows
    with the input as fast as the number of tasks does. The driver gets one row per block.
    """
    fan_in = max(2, int(np.ceil(np.sqrt(tasks))))

    def add(keys: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(cells // blocks, dtype)
        for payload in frame["payload"]:
            total += unpack(payload, dtype)
        return pd.DataFrame({"part": [0 if len(keys) == 1 else keys[1]], "block": [keys[0]], "payload": [pack(total)]})

    once = partials.withColumn("part", F.col("part") % fan_in).groupBy("block", "part").applyInPandas(add, SUM_SCHEMA)
    out = np.zeros(cells, dtype)
    size = cells // blocks
    for row in once.groupBy("block").applyInPandas(add, SUM_SCHEMA).collect():
        out[row["block"] * size : (row["block"] + 1) * size] = unpack(bytes(row["payload"]), dtype)
    return out
