"""The warehouse as temporary views, for queries written in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.operators import dims
from gridcast.operators.facts import stamp_column
from gridcast.operators.staging import stage
from gridcast.operators.unified import city_forecast, unify
from gridcast.operators.writers import table_exists
from gridcast.sources.tables import read_raw


def staging_name(p: spec.Product) -> str:
    return f"stg_{p.model}_{p.shape}" if p.source == "gfs_raw" else f"stg_ecmwf_{p.model}_{p.shape}"


def register_views(spark: SparkSession, root: str, as_of: str, stamp: str, since: str | None = None) -> list[str]:
    """Create a view per table that exists below ``root`` and per view over them.

    ``root`` holds raw/<table> and gold/<fact>. Views are lazy: each query reads only the
    partitions and columns it needs. ``since`` limits the staging views to forecast dates
    from then on. Returns the names.
    """
    made: dict[str, object] = {}
    staged, facts = {}, {}
    for p in spec.PRODUCTS:
        raw_path, fact_path = f"{root}/raw/{p.table}", f"{root}/gold/{p.fact}"
        if table_exists(spark, raw_path):
            raw = read_raw(spark, raw_path, p.shape, since)
            made[p.table] = raw
            staged[p.model, p.shape] = made[staging_name(p)] = stage(raw, p.shape)
        if table_exists(spark, fact_path):
            facts.setdefault(p.shape, {})[p.model] = made[p.fact] = spark.read.parquet(fact_path)

    stations = made["ref_weather_station"] = dims.stations(spark)
    anchor = spark.range(1).select(F.lit(as_of).cast("date").alias("as_of"), stamp_column(stamp).alias("dbt_updated_at"))
    made["dim_times"] = dims.time_dimension(anchor, days=4)
    grid = staged.get(("gfs", spec.UPPER))
    if grid is not None:
        made["dim_grid_points"] = dims.grid_dimension(grid, stations)
    surfaces = [df for (_, shape), df in staged.items() if shape == spec.SURFACE]
    if surfaces:
        made["dim_locations"] = dims.location_dimension(surfaces, as_of)
    for shape, by_model in facts.items():
        forecast = made[f"fct_{shape}_forecast"] = unify(by_model, shape)
        if grid is not None:
            made[f"fct_{shape}_forecast_cities"] = city_forecast(
                forecast, dims.city_points(grid, stations), shape, stations=stations
            )
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    return list(made)
