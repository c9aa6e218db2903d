"""Grid, location and time dimensions, and the stations of the demand cities."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.functions import expand, hours
from gridcast.operators.facts import window_rows
from gridcast.operators.ingest import station_grid
from gridcast.session import literal_table

GRID_COLUMNS = ("lat_i", "lon_i", "lat", "lon")
STATION_COLUMNS = ("city_name", "state", "region", "market_weight", "associated_hub")


def cities(spark: SparkSession) -> DataFrame:
    """The demand cities with their coast limits, as literals Spark can see the size of."""
    columns = (*STATION_COLUMNS, "latitude", "longitude", "east_limit", "west_limit")
    rows = [(*city, spec.EAST_LIMITS.get(city[0]), spec.WEST_LIMITS.get(city[0])) for city in spec.CITIES]
    return literal_table(spark, columns, rows)


def stations(spark: SparkSession) -> DataFrame:
    """Grid points that stand for the demand cities; at most nine per city."""
    return station_grid(cities(spark))


def grid_points(staged: DataFrame) -> DataFrame:
    """Distinct grid points of a staging view."""
    return staged.select(*GRID_COLUMNS).distinct()


def grid_dimension(staged: DataFrame, stations: DataFrame) -> DataFrame:
    """Grid points with the station they serve, if any.

    A point that serves two cities has two rows. The points are made distinct before the
    join; Spark broadcasts the stations by their size.
    """
    about = stations.select(*spec.GRID_KEY, *STATION_COLUMNS)
    return (
        grid_points(staged)
        .join(about, list(spec.GRID_KEY), "left")
        .select(*GRID_COLUMNS, *STATION_COLUMNS, F.col("city_name").isNotNull().alias("is_city"))
    )


def city_points(staged: DataFrame, stations: DataFrame) -> DataFrame:
    """The rows of the grid dimension with is_city, without building the rest of it.

    Points without a station are dropped by a semi join ahead of the distinct, so only
    station points are shuffled however large the staging view is.
    """
    at_station = staged.select(*GRID_COLUMNS).join(
        stations.select(*spec.GRID_KEY), list(spec.GRID_KEY), "left_semi"
    )
    about = stations.select(*spec.GRID_KEY, *STATION_COLUMNS)
    return (
        at_station.distinct()
        .join(about, list(spec.GRID_KEY))
        .select(*GRID_COLUMNS, *STATION_COLUMNS, F.lit(True).alias("is_city"))
    )


def location_dimension(
    staged: Sequence[DataFrame], as_of: str, existing: DataFrame | None = None, days: int = 1
) -> DataFrame:
    """Distinct locations of the 240-hour step of recent midnight cycles, over all models.

    Locations do not change: with an ``existing`` dimension there is nothing to add, and
    the typed empty result reads no forecast at all.
    """
    if existing is not None:
        return existing.select(*GRID_COLUMNS).where(F.lit(False))
    slices = [
        window_rows(s, as_of, days)
        .where((F.col("forecast_step_hours") == 240) & (F.col("cycle_hour") == 0))
        .select(*GRID_COLUMNS)
        for s in staged
    ]
    return reduce(DataFrame.unionAll, slices).distinct()


def time_dimension(anchor: DataFrame, days: int) -> DataFrame:
    """Valid times of every cycle and step of the last ``days`` days up to ``as_of``.

    ``anchor`` has one row: as_of DATE and dbt_updated_at. 4 days build the table, 2
    refresh it.
    """
    return (
        anchor.select(
            "dbt_updated_at",
            F.explode(F.sequence(F.date_sub("as_of", days - 1), F.col("as_of"))).alias("cycle_date"),
        )
        .withColumn("cycle_hour", expand(spec.SIX_HOURLY))
        .withColumn("step", expand(spec.STEPS))
        .withColumn(
            "valid",
            F.col("cycle_date").cast("timestamp") + hours(F.col("cycle_hour") + F.col("step")),
        )
        .select(
            "cycle_date",
            "cycle_hour",
            F.col("valid").cast("date").alias("valid_date"),
            F.hour("valid").alias("valid_hour"),
            "dbt_updated_at",
        )
        .distinct()
    )
