"""One forecast over all models, and its city extracts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.functions import hash_key
from gridcast.operators.dims import STATION_COLUMNS


def unify(facts: Mapping[str, DataFrame], shape: str) -> DataFrame:
    """All models' facts of one shape; the label is the key under which a fact comes."""
    parts = [
        df.withColumn("weather_model", F.lit(model)).select(*spec.fact_columns(shape)) for model, df in facts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def with_hash_key(df: DataFrame, shape: str, city: bool = False) -> DataFrame:
    """``unique_key`` in front. With ``city`` the city is part of the hash, which makes the
    key unique where a grid point serves two cities."""
    key = hash_key([*spec.hash_key_columns(shape), *(["city_name"] if city else [])])
    return df.select(key.alias("unique_key"), *df.columns)


def near(forecast: DataFrame, stations: DataFrame) -> DataFrame:
    """Forecast rows in the latitude band of the stations.

    The band's ends are scalar subqueries, known before the scan starts: on tables laid
    down by place the scan skips every row group outside. For a forecast that computes its
    index on the fly the test only costs time.
    """
    low, high = (stations.agg(f("lat_i").alias("lat_i")).scalar() for f in (F.min, F.max))
    return forecast.where((F.col("lat_i") >= low) & (F.col("lat_i") <= high))


def city_forecast(
    forecast: DataFrame,
    points: DataFrame,
    shape: str,
    city_in_key: bool = False,
    stations: DataFrame | None = None,
) -> DataFrame:
    """Forecast rows at the demand cities.

    ``points`` is a grid dimension or its city rows; ``stations``, if given, narrows the
    scan of stored facts to their latitudes first. The hash is computed after the join, on the few rows
    that remain.
    """
    if stations is not None:
        forecast = near(forecast, stations)
    about = points.where("is_city").select(*spec.GRID_KEY, *STATION_COLUMNS)
    joined = forecast.join(about, list(spec.GRID_KEY)).select(*spec.fact_columns(shape), *STATION_COLUMNS)
    return with_hash_key(joined, shape, city=city_in_key)


def changed_since(forecast: DataFrame, target: DataFrame, null_mark: str = "block") -> DataFrame:
    """Forecast rows stamped no earlier than the newest stamp in the target.

    An empty target has no stamp: ``"block"`` takes nothing then, ``"epoch"`` everything.
    """
    newest = F.max("dbt_updated_at")
    if null_mark == "epoch":
        newest = F.coalesce(newest, F.lit("1970-01-01 00:00:00").cast("timestamp"))
    mark = target.agg(newest.alias("mark")).scalar()
    return forecast.where(F.col("dbt_updated_at") >= mark)
