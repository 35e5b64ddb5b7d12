"""From raw documents to token ids, in five stages.

Each stage is (spark, docs, sf_dir) -> DataFrame. Its result is written as Parquet to the shared
folder and read again as the next stage's ``docs``. All but the last return the columns of
``documents``. Every stage works on all that the one before kept, and fits what it fits on that.

1. quality: rows that the classifier scores below its threshold go.
2. near_duplicates: of documents linked by five-word shingles at 0.8 or more, one stays.
3. decontamination: documents that hold a benchmark item go.
4. secrets: secrets are replaced in ``text``; ``n_chars`` follows.
5. tokens: SentencePiece ids with seeded merge-dropout.

Stage 2 keeps one row of each group by what the rows hold, so that repeated and null ids are treated
like any other: of a document and its copies the one with the least id stays (null last), of equal
rows one. Rows without words pass it. Other stages do not look at ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import decontamination, merge_dropout, quality_classifier, secret_scan, superminhash
from tillwise.llm.tables import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pooled = quality_classifier.pool_documents(docs)
    return quality_classifier.keep_quality(docs, pooled, quality_classifier.fit_quality(pooled, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return superminhash.one_of_each(docs, size=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return merge_dropout.encode(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: A trained network, signatures and merges are not for SQL; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
