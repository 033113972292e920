"""Intermediate tables in the shared folder, and small table helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logloom.shared import shared_folder


#: Shuffle files go when the job that made them has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``stored`` and its folder, for ``delete_folder`` when all its readers have ended."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    before = spark.conf.get(TIDY)
    spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once and read back, so that what follows doesn't repeat
    its work and a lost executor costs only a file read."""
    return kept(df, purpose)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Key and text alone: other columns can't clash with an operator's own."""
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text")
