"""Raw table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast import spec
from gridcast.operators.ingest import wider
from gridcast.operators.writers import stored_schema


def read_raw(
    spark: SparkSession, path: str, shape: str, since: str | None = None
) -> DataFrame:
    """Scan a raw table partitioned by (forecast_date, forecast_cycle).

    The schema is declared, so nothing is inferred and the date stays text. ``since`` is an
    ISO date compared with the partition column: it prunes partitions, which a filter on
    the derived cycle_date could not. Columns that loads added to the table come after the
    declared ones, and those that loads widened have the wider type (see ``writers.keep_schema``).
    """
    stored = stored_schema(spark, path) or T.StructType()
    noted = {f.name: f.dataType for f in stored}
    declared = T.StructType(
        [T.StructField(f.name, wider(f.dataType, noted.get(f.name, f.dataType), f.name)) for f in spec.raw_schema(shape)]
    )
    added = [f for f in stored if f.name not in declared.names]
    df = spark.read.schema(T.StructType([*declared, *added])).parquet(path)
    df = df.select(*declared.names, *[f.name for f in added])
    return df.where(F.col("forecast_date") >= since) if since else df


def read_external(spark: SparkSession, paths: str | list[str], shape: str) -> DataFrame:
    """Scan Parquet files below path globs whose partition columns are not in the files.

    The cycle comes from the reference time. Narrow the globs (``.../forecast_date=2026-03-2*``)
    to list fewer directories; the files themselves are pruned by row-group statistics.
    """
    df = (
        spark.read.schema(spec.raw_schema(shape, partitions=False))
        .option("recursiveFileLookup", "true")
        .parquet(*([paths] if isinstance(paths, str) else paths))
    )
    return df.withColumns(
        {
            "forecast_date": F.col("forecast_reference_time").cast("date").cast("string"),
            "forecast_cycle": F.hour("forecast_reference_time"),
        }
    )
