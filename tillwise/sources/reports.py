"""Report results as CSV folders with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.functions.numbers import plain_text


def write_report(report: DataFrame, folder: str, name: str) -> None:
    """Replace one report. Reports are bounded by calendar and label counts, so one file.

    The rows are brought together first and sorted then, so the file has them in order.
    """
    columns = [
        plain_text(F.col(c)).alias(c) if data_type == "double" else F.col(c)
        for c, data_type in report.dtypes
    ]
    order = [
        F.col(c).desc() if descending else F.col(c).asc()
        for c, descending in schemas.REPORT_ORDER.get(name, [])
    ]
    single = report.repartition(1)
    single = single.sortWithinPartitions(*order) if order else single
    (
        single.select(*columns)
        .write.mode("overwrite")
        .option("header", True)
        .csv(f"{folder}/{name}")
    )


def read_report(spark: SparkSession, folder: str, name: str, cached: bool = True) -> DataFrame:
    """One stored report; ``cached`` keeps it in memory (unpersist when done)."""
    report = (
        spark.read.schema(schemas.REPORTS[name]).option("header", True).csv(f"{folder}/{name}")
    )
    return report.cache() if cached else report
