"""Which partitions should exist, which do, and which are past their time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.session import literal_table

LISTING_PATH = r"/([^/]+)/forecast_date=(\d{4}-\d{2}-\d{2})/forecast_cycle=(\d+)(?:/|$)"
PARTITION_SUFFIX = r"_p(\d{4})_(\d{2})_(\d{2})$"


def local_day(instant: Column, zone: str = "America/New_York") -> Column:
    """Calendar day of an instant in the operators' home zone."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def product_table(spark: SparkSession) -> DataFrame:
    """The eight products as rows; literals, so Spark knows how small they are."""
    columns = ("table_name", "fact_name", "published", "cycles", "fact_cycles")
    return literal_table(
        spark, columns, [(p.table, p.fact, p.published, p.cycles, p.fact_cycles) for p in spec.PRODUCTS]
    )


def parse_listing(listing: DataFrame, path: str = "path") -> DataFrame:
    """Distinct (table_name, forecast_date, forecast_cycle) of partition paths."""
    part = [F.regexp_extract(path, LISTING_PATH, i) for i in (1, 2, 3)]
    return (
        listing.where(F.rlike(F.col(path), F.lit(LISTING_PATH)))
        .select(
            part[0].alias("table_name"),
            part[1].alias("forecast_date"),
            part[2].cast("int").alias("forecast_cycle"),
        )
        .distinct()
    )


def missing_partitions(found: DataFrame, instant: Column, products: DataFrame) -> DataFrame:
    """Partitions of the previous day that should be there and are not; none means ready.

    The day is the day before ``instant`` in New York. Unpublished products are not expected.
    """
    expected = products.where("published").select(
        "table_name",
        F.date_format(F.date_sub(local_day(instant), 1), "yyyy-MM-dd").alias("forecast_date"),
        F.explode("cycles").alias("forecast_cycle"),
    )
    return expected.join(found, ["table_name", "forecast_date", "forecast_cycle"], "left_anti")


def partition_name(table: Column | str, cycle: Column | str, day: Column | str) -> Column:
    """``{table}_cHH_pYYYY_MM_DD``."""
    c = (lambda x: F.col(x) if isinstance(x, str) else x)
    return F.concat(
        c(table), F.lit("_c"), F.lpad(c(cycle).cast("string"), 2, "0"), F.lit("_p"), F.date_format(c(day), "yyyy_MM_dd")
    )


def partition_calendar(products: DataFrame, as_of: Column, first: int = -5, last: int = 10) -> DataFrame:
    """Partitions every fact should have from ``first`` to ``last`` days around ``as_of``."""
    return products.select(
        "fact_name",
        F.explode("fact_cycles").alias("cycle_hour"),
        as_of.alias("_as_of"),
    ).select(
        "fact_name",
        "cycle_hour",
        F.explode(F.sequence(F.date_add("_as_of", first), F.date_add("_as_of", last))).alias("cycle_date"),
    ).withColumn("partition_name", partition_name("fact_name", "cycle_hour", "cycle_date"))


def partitions_to_create(calendar: DataFrame, existing: DataFrame) -> DataFrame:
    """Calendar entries whose partition is not there yet."""
    return calendar.join(existing.select("partition_name"), "partition_name", "left_anti")


def expired_partitions(names: DataFrame, as_of: str, keep_days: int = 45, column: str = "partition_name") -> DataFrame:
    """Names that carry a date older than ``as_of`` minus ``keep_days``."""
    year, month, day = (F.regexp_extract(column, PARTITION_SUFFIX, i) for i in (1, 2, 3))
    # An impossible date such as 2026_02_30 is no date, hence never expired.
    dated = names.where(F.rlike(F.col(column), F.lit(PARTITION_SUFFIX))).withColumn(
        "partition_date", F.concat_ws("-", year, month, day).try_cast("date")
    )
    return dated.where(F.col("partition_date") < F.date_sub(F.lit(as_of).cast("date"), keep_days))


def recent_snapshot(raw: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Raw rows of the last days; compares the text partition column, so it prunes."""
    since = F.date_format(F.date_sub(F.lit(as_of).cast("date"), days), "yyyy-MM-dd")
    return raw.where(F.col("forecast_date") >= since)
