"""Forecast inputs derived from the given tables.

The given tables hold no forecasts, so raw tables, events and listings are projections of
them: every row of ``lineitem`` becomes a raw row (some twice, to have repeated keys), and
dirty rows are built in: an absurd latitude, NULL longitudes, NULL heights. All are
map-only and grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.functions import grid_index_f32

AS_OF = "2026-03-26"
STAMP = "2026-03-26 12:00:00"
EARLIER_STAMP = "2026-03-25 12:00:00"

# Input order of a raw row. Rows that tie on all of these are equal in every column.
ORDINAL = ("src_ord", "src_id", "src_seq", "src_part", "src_supp", "src_qty", "src_tax")
MODEL_NO = {"gfs": 0, "aifs": 1, "ifs": 2}


# Schemas of the given tables, declared so that no job is needed to infer them.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "explode(if(l_orderkey % 50 = 0, array(0, 1), array(0))) AS src_ord",
        "l_orderkey AS src_id",
        "l_linenumber AS src_seq",
        "l_partkey AS src_part",
        "l_suppkey AS src_supp",
        "l_quantity AS src_qty",
        "l_tax AS src_tax",
        "l_discount AS src_disc",
        "CAST(l_suppkey % 3 AS INT) AS model_no",
        "if(l_quantity = 50, -538099D, 25D + (l_partkey % 96) * 0.25D) AS latitude",
        "if(l_discount = 0D, NULL, 235D + (l_orderkey % 224) * 0.25D) AS longitude_360",
        "date_add(DATE'2026-03-20', CAST(l_linenumber % 7 AS INT)) AS frt_date",
        "CAST(l_quantity AS INT) % 4 AS cycle_no",
        "CAST(l_suppkey % 4 AS INT) AS step_no",
        "CAST(l_orderkey % 3 AS INT) AS level_no",
    )


_USUAL = ("if(model_no = 2, 12 * (cycle_no % 2), 6 * cycle_no)", "get(array(192, 240, 288, 360), step_no)")
_HALF_DAY = ("12 * (cycle_no % 2)", "if(step_no < 2, 240, 360)")


def _placed(df: DataFrame, cycle: str, step: str, metrics: dict[str, str]) -> DataFrame:
    """Add coordinates, times, partition columns and metrics of a raw row."""
    return df.select(
        "*",
        F.expr(f"{cycle} AS forecast_cycle"),
        F.expr(f"{step} AS step_hours"),
        F.expr("if(longitude_360 >= 180, longitude_360 - 360, longitude_360) AS longitude"),
        F.expr("CAST(frt_date AS STRING) AS forecast_date"),
        *[F.expr(f"{e} AS {m}") for m, e in metrics.items()],
    ).select(
        "*",
        F.expr("CAST(frt_date AS TIMESTAMP) + INTERVAL '1' HOUR * forecast_cycle AS forecast_reference_time"),
        F.expr("CAST(frt_date AS TIMESTAMP) + INTERVAL '1' HOUR * (forecast_cycle + step_hours) AS valid_time"),
        grid_index_f32("latitude", 90).alias("lat_i"),
        grid_index_f32("longitude", 180).alias("lon_i"),
    )


def all_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = {
        "isobaricInhPa": "get(array(250, 500, 850), level_no)",
        "gh": "if(src_tax = 0D, NULL, CAST(4800 + src_part % 1200 + src_ord AS FLOAT))",
        "t": "CAST(230 + src_qty AS FLOAT)",
        "u": "CAST(src_supp % 120 - 60 AS FLOAT)",
        "v": "CAST(src_part % 90 - 45 AS FLOAT)",
    }
    return _placed(base(spark, sf_dir), *_USUAL, metrics)


def all_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = {
        "t2m": "CAST(250 + src_qty AS FLOAT)",
        "d2m": "CAST(240 + src_qty AS FLOAT)",
        "msl": "if(src_tax = 0D, NULL, CAST(98000 + src_part % 6000 + src_ord AS FLOAT))",
        "tp": "CAST(src_disc AS FLOAT)",
        "heightAboveGround": "2D",
        "surface": "0D",
    }
    return _placed(base(spark, sf_dir), *_USUAL, metrics)


def all_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = {
        "isobaricInhPa": "if(level_no = 0, 500, 850)",
        "gh": "CAST(src_qty AS FLOAT)",
        "t": "CAST(src_seq AS FLOAT)",
    }
    return _placed(base(spark, sf_dir).where("model_no IN (1, 2)"), *_HALF_DAY, metrics)


_ALL = {spec.UPPER: all_upper, spec.SURFACE: all_surface, spec.SPREAD: all_spread}


def raw(spark: SparkSession, sf_dir: str, shape: str, model: str | None = None, ordinal: bool = False) -> DataFrame:
    """A raw table; with ``ordinal`` also its input order, without ``model`` all models'
    rows with a ``model`` column."""
    df = _ALL[shape](spark, sf_dir)
    columns = [f.name for f in spec.raw_schema(shape)] + (list(ORDINAL) if ordinal else [])
    if model:
        return df.where(F.col("model_no") == MODEL_NO[model]).select(*columns)
    return df.select(F.expr("get(array('gfs', 'aifs', 'ifs'), model_no) AS model"), *columns)


def asset_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = "s3://bucket/weather_data/delta_lake/"
    by_type = {
        "view": "gfs_raw/gfs_upper/",
        "click": "gfs_raw/gfs_surface/",
        "signup": "ecmwf_raw/at_aifs_upper/",
        "purchase": "ecmwf_raw/ifs_spread/",
    }
    uri = F.lit(root + "other/")
    for kind, path in by_type.items():
        uri = F.when(F.col("event_type") == kind, root + path).otherwise(uri)
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), uri.alias("uri"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run history: error events, half a month earlier, that succeeded or failed."""
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'error'")
        .select(
            (F.col("ts").cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(15))).alias("start_date"),
            F.when(F.col("value") >= 20, "success").otherwise("failed").alias("state"),
        )
    )


def index_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index files: each document is one, each of its words a line."""
    variable = F.array(*[F.lit(v) for v in ("HGT:500 mb", "TMP:850 mb", "UGRD:250 mb", "APCP:surface", "VGRD:250 mb", "HGT:250 mb")])

    def line(word: Column, i: Column) -> Column:
        n = F.length(word)
        forecast = (
            F.when(n % 4 == 0, "240 hour fcst").when(n % 4 == 1, "192-240 hour acc fcst").when(n % 4 == 2, "360 hour fcst").otherwise("anl")
        )
        return F.concat_ws(
            ":",
            (i + 1).cast("string"),
            (i * 1000 + n).cast("string"),
            F.lit("d=2026032600"),
            F.get(variable, n % 6),
            forecast,
            F.lit(""),
        )

    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("file"),
        F.when(F.col("n_chars") % 3 == 0, 240).when(F.col("n_chars") % 3 == 1, 360).otherwise(0).alias("step"),
        F.array_join(F.transform(F.split("text", " "), line), "\n").alias("text"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as directory listings: link texts become names of forecast files."""
    step = F.when(F.length("url") % 3 == 0, "360").when(F.length("url") % 3 == 1, "240").otherwise("192")
    return table(spark, sf_dir, "pages").select(
        "url",
        F.replace("html", F.lit("</a>"), F.concat(F.lit("-"), step, F.lit("h-oper-fc.grib2</a>"))).alias("html"),
    )


def customer_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as places: coordinates from key and balance, a coast for some nations."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("city_name"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("state"),
        F.col("c_mktsegment").alias("region"),
        (F.col("c_custkey") % 20 / 16).cast("double").alias("market_weight"),
        F.concat(F.lit("Hub "), F.col("c_nationkey").cast("string")).alias("associated_hub"),
        (F.lit(26.0) + F.col("c_custkey") % 711 / 32).alias("latitude"),
        (F.lit(-124.0) + F.col("c_custkey") % 1637 / 32).alias("longitude"),
        F.when(F.col("c_nationkey") == 3, F.lit(-100.0)).alias("east_limit"),
        F.when(F.col("c_nationkey") == 7, F.lit(-90.0)).alias("west_limit"),
    )
