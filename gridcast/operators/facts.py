"""Fact rows and the rules that choose which of them a load takes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.functions import cycle_number, millimetre


def stamp_column(stamp: datetime | str) -> Column:
    """One load stamp for a whole run, passed in so that re-running gives the same rows."""
    return F.lit(str(stamp)).cast("timestamp")


def to_fact(staged: DataFrame, model: str, shape: str, stamp: datetime | str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Label, unit projection and load stamp on top of a staging view."""
    df = staged.withColumns({"weather_model": F.lit(model), "dbt_updated_at": stamp_column(stamp)})
    if shape == spec.SURFACE:
        df = df.withColumn("total_precipitation_mm", millimetre("total_precipitation_m"))
    return df.select(*spec.fact_columns(shape), *keep)


def since_days(as_of: str, days: int) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), days)


def window_rows(source: DataFrame, as_of: str, days: int) -> DataFrame:
    """Rows of cycles dated ``as_of`` minus ``days`` or later."""
    return source.where(F.col("cycle_date") >= since_days(as_of, days))


def rows_above_mark(
    source: DataFrame, target: DataFrame, as_of: str, days: int = 7, null_mark: str = "epoch"
) -> DataFrame:
    """Rows of cycles newer than the newest cycle the target holds within the window.

    The mark is a scalar subquery over the window's partitions of the target. With an
    empty window ``null_mark="epoch"`` takes every row, ``"block"`` takes none (the
    table then waits for a full refresh).
    """
    number = cycle_number("cycle_date", "cycle_hour")
    newest = F.max(number)
    if null_mark == "epoch":
        newest = F.coalesce(newest, F.lit(0))
    elif null_mark != "block":
        raise ValueError(f"null_mark is 'epoch' or 'block', not {null_mark!r}")
    mark = window_rows(target, as_of, days).agg(newest.alias("mark")).scalar()
    return window_rows(source, as_of, days).where(number > mark)


def latest_window(source: DataFrame, as_of: str, days: int = 1, span_days: int = 1) -> DataFrame:
    """Rows within ``span_days`` of the newest cycle of the source's own window."""
    number = cycle_number("cycle_date", "cycle_hour")
    recent = window_rows(source, as_of, days)
    newest = recent.agg(F.max(number).alias("newest")).scalar()
    return recent.where(number >= newest - 24 * span_days)
