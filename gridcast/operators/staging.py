"""Staging views: guard the coordinates, then name and type the columns.

One function per shape serves every model; warehouse variants are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.functions import as_float, celsius, grid_index, hectopascal


def geo_guard(df: DataFrame) -> DataFrame:
    """Keep rows whose coordinates can be cast safely; NULL and NaN do not pass."""
    return df.where(F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 360))


def region_box(df: DataFrame) -> DataFrame:
    """The development region, in either longitude convention."""
    west, positive = F.col("longitude").between(-125, -70), F.col("longitude").between(235, 290)
    return df.where(F.col("latitude").between(30, 50) & (west | positive))


def recent_window(df: DataFrame, as_of: str, days: int = 1) -> DataFrame:
    """Cycles that started on or after ``as_of`` minus ``days``.

    The reference time and the partition date say the same; filtering the latter as well
    lets the scan skip partitions.
    """
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    recent = df.where(F.col("forecast_reference_time") >= since.cast("timestamp"))
    if "forecast_date" in df.columns:
        recent = recent.where(F.col("forecast_date") >= F.date_format(since, "yyyy-MM-dd"))
    return recent


def _keys(cycle_from_time: bool, wide_coordinates: bool) -> list[Column]:
    frt, valid = F.col("forecast_reference_time"), F.col("valid_time")
    cycle = F.hour(frt) if cycle_from_time else F.col("forecast_cycle").cast("int")
    degrees = "double" if wide_coordinates else "float"
    return [
        frt.cast("date").alias("cycle_date"),
        cycle.alias("cycle_hour"),
        F.col("step_hours").cast("int").alias("forecast_step_hours"),
        valid.cast("date").alias("valid_date"),
        F.hour(valid).alias("valid_hour"),
        F.col("latitude").cast(degrees).alias("lat"),
        F.col("longitude").cast(degrees).alias("lon"),
        grid_index("latitude", 90).alias("lat_i"),
        grid_index("longitude", 180).alias("lon_i"),
    ]


_METRICS = {
    spec.UPPER: lambda: [
        F.col("isobaricInhPa").cast("int").alias("pressure_level_hpa"),
        as_float("gh").alias("geopotential_height_m"),
        as_float("t").alias("temp_kelvin"),
        celsius("t").alias("temp_celsius"),
        as_float("u").alias("u_wind_m_s"),
        as_float("v").alias("v_wind_m_s"),
    ],
    spec.SURFACE: lambda: [
        as_float("t2m").alias("temp_2m_kelvin"),
        celsius("t2m").alias("temp_2m_celsius"),
        as_float("d2m").alias("dewpoint_2m_kelvin"),
        celsius("d2m").alias("dewpoint_2m_celsius"),
        hectopascal("msl").alias("msl_pressure_hpa"),
        as_float("tp").alias("total_precipitation_m"),
        F.col("heightAboveGround").alias("height_above_ground_metadata"),
        F.col("surface").alias("surface_type_metadata"),
    ],
    # The Celsius column is the Kelvin spread less 273.15, as users of the tables expect it.
    spec.SPREAD: lambda: [
        F.col("isobaricInhPa").cast("int").alias("pressure_level_hpa"),
        as_float("t").alias("temp_spread_kelvin"),
        celsius("t").alias("temp_spread_celsius"),
        as_float("gh").alias("geopotential_height_spread_m"),
    ],
}


def stage(
    raw: DataFrame,
    shape: str,
    *,
    region: bool = False,
    since: tuple[str, int] | None = None,
    cycle_from_time: bool = False,
    wide_coordinates: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Staging view of a raw table.

    region: only the development region. since: (as_of, days) early window on the
    reference time. cycle_from_time: cycle hour from the reference time, for tables without
    the partition column. wide_coordinates: lat / lon stay DOUBLE. keep: raw columns to
    carry along, such as an input ordinal.
    """
    guarded = geo_guard(raw)
    if since:
        guarded = recent_window(guarded, *since)
    if region:
        guarded = region_box(guarded)
    return guarded.select(*_keys(cycle_from_time, wide_coordinates), *_METRICS[shape](), *keep)
