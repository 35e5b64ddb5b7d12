"""Tables stored in buckets of a key: what is grouped or joined on it needs no shuffle.

Spark takes the bucket layout from its catalog, not from the files. So a folder is entered there
as an external table under a name made from its path, by the writer and again by any later
session that reads it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillwise.sources.files import located


def _name(spark: SparkSession, path: str) -> str:
    place, system = located(spark, path)
    whole = system.makeQualified(place).toString()
    return f"tillwise_{hashlib.md5(whole.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, sort: Sequence[str]) -> None:
    """Replace a folder with the rows in buckets, one file each.

    The rows are dealt out as the buckets are, so every task writes one bucket.
    """
    spark = df.sparkSession
    forget(spark, path)
    writer = df.repartition(buckets, key).write.format("parquet").mode("overwrite")
    writer.option("path", path).bucketBy(buckets, key).sortBy(*sort).saveAsTable(_name(spark, path))


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int
) -> DataFrame:
    name = _name(spark, path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name).select(*schema.names)


def forget(spark: SparkSession, path: str) -> None:
    """Take a folder out of the catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(spark, path)}")
