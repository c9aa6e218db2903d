"""Reference data kept as CSV files with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the seed files.
SEED_SCHEMAS = {
    "weather_station": (
        "city_name string, state string, region string, market_weight double, associated_hub string, "
        "lat_i int, lon_i int, lat double, lon double"
    ),
    "meteorological_anchors": (
        "anchor_id string, latitude double, longitude double, teleconnection string, description string"
    ),
    "physical_thresholds": (
        "threshold_id string, variable_id string, level_mb string, threshold_value double, unit string, "
        "logic_type string, description string"
    ),
    "weather_model_variables": (
        "variable_id string, level_mb string, grib_params string, pack_type string, physical_significance string"
    ),
}


def load_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a seed with its declared schema; a malformed line fails the load."""
    return (
        spark.read.schema(SEED_SCHEMAS[name])
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .csv(path)
    )
