"""What a Parquet table tells without its data pages: rows per partition, from directory names and file footers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

V1_SOURCES = "spark.sql.sources.useV1SourceList"


def read_pushed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table read through the source that answers counts from footers (`spark.sql.parquet.aggregatePushdown`).

    Which source reads a path is settled when the frame is made, so the setting holds for this one read only. Counts are
    answered from footers if they are grouped by all partition columns, and filtered by none but these.
    """
    usual = spark.conf.get(V1_SOURCES)
    spark.conf.set(V1_SOURCES, ",".join(s for s in usual.split(",") if s != "parquet"))
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    finally:
        spark.conf.set(V1_SOURCES, usual)


def partition_rows(spark: SparkSession, path: str, partition_by: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """The partitions that hold rows, and how many (column `rows`). A filter on partition columns prunes the listing."""
    counted = read_pushed(spark, path, schema).groupBy(*partition_by).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where("rows > 0")
