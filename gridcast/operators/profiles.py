"""Profiles kept per partition and merged, so that checking a growing table reads only the partitions that changed.

A profile is a table of one row per partition. Its columns say by their names how they merge: ``rows``, ``*__nulls`` and
``*__nans`` add up, of ``*__min`` the least and of ``*__max`` the greatest counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.operators import quality, writers

Measure = Callable[[DataFrame, Sequence[str]], DataFrame]


def refresh(
    table: DataFrame,
    path: str,
    partition_by: Sequence[str] = spec.RAW_PARTITIONS,
    stale: Column | None = None,
    measure: Measure = quality.measured_load,
) -> DataFrame:
    """Brings the profile of a table up to date and returns it.

    ``stale`` is a condition on partition columns: partitions that meet it, or for which it is NULL, are measured again,
    and their old rows go even if the table lost them. What is noted of the others stays as it is. Without a condition,
    or without a profile, the whole table is measured. Columns that only later loads have are NULL in older rows.
    """
    spark = table.sparkSession
    if stale is None or not writers.table_exists(spark, path):
        rows = measure(table, partition_by)
    else:
        again = F.coalesce(stale, F.lit(True))
        rows = spark.read.parquet(path).where(~again).unionByName(measure(table.where(again), partition_by), allowMissingColumns=True)
    writers.overwrite_table(rows.coalesce(1), path)
    return spark.read.parquet(path)


def _merged_column(c: str) -> Column:
    if c.endswith("__min"):
        return F.min(c)
    if c.endswith("__max"):
        return F.max(c)
    # Where a partition has no such column, all its rows lack a value.
    absent = F.col("rows") if c.endswith("__nulls") else F.lit(0)
    return F.coalesce(F.sum(F.coalesce(F.col(c), absent)), F.lit(0))


def merged(profile: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row for all partitions, or one per value of some partition columns."""
    measures = [c for c in profile.columns if c == "rows" or c.endswith(("__nulls", "__nans", "__min", "__max"))]
    return profile.groupBy(*by).agg(*[_merged_column(c).alias(c) for c in measures])


def rollup(profile: DataFrame) -> DataFrame:
    """What ``quality.profile_rollup`` says of the whole table, from its profile."""
    measured = [c.removesuffix("__nans") for c in profile.columns if c.endswith("__nans")]
    return merged(profile).select(*quality.rollup_columns([c for c in measured if c not in quality.COORDINATES]))
