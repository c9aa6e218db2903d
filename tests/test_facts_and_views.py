from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.operators import dims, facts, unified
from gridcast.operators.staging import geo_guard, recent_window, stage
from gridcast.plans import inputs

AS_OF = "2026-03-26"


@pytest.fixture
def cycles(spark):
    return spark.createDataFrame(
        [(date(2026, 3, d), h, d * 100 + h) for d in (15, 24, 25, 26) for h in (0, 12)], "cycle_date date, cycle_hour int, v int"
    )


def values(df):
    return sorted(r.v for r in df.collect())


def test_mark_takes_newer_cycles_only(cycles):
    target = cycles.where("v <= 2500")
    assert values(facts.rows_above_mark(cycles, target, AS_OF)) == [2512, 2600, 2612]


def test_mark_ignores_the_target_outside_the_window(cycles):
    old = cycles.where("v < 1600")
    assert values(facts.rows_above_mark(cycles, old, AS_OF)) == [2400, 2412, 2500, 2512, 2600, 2612]
    assert values(facts.rows_above_mark(cycles, old, AS_OF, null_mark="block")) == []
    with pytest.raises(ValueError):
        facts.rows_above_mark(cycles, old, AS_OF, null_mark="zero")


def test_mark_and_rows_see_one_snapshot_after_append(cycles):
    target = cycles.where("v <= 2500")
    new = facts.rows_above_mark(cycles, target, AS_OF)
    assert values(facts.rows_above_mark(cycles, target.union(new), AS_OF)) == []


def test_latest_window(cycles):
    assert values(facts.latest_window(cycles, AS_OF)) == [2512, 2600, 2612]


def test_window_rows(cycles):
    assert values(facts.window_rows(cycles, AS_OF, 1)) == [2500, 2512, 2600, 2612]


def test_guard_drops_what_cannot_be_placed(spark):
    bad = [(-538099.0, 0.0), (91.0, 0.0), (0.0, None), (None, 0.0), (float("nan"), 0.0), (0.0, 361.0)]
    good = [(-90.0, -180.0), (90.0, 360.0)]
    df = spark.createDataFrame(bad + good, "latitude double, longitude double")
    assert [tuple(r) for r in geo_guard(df).collect()] == good


def test_staging_reads_only_the_columns_it_needs(spark, sf_dir):
    df = stage(inputs.raw(spark, sf_dir, spec.UPPER, "gfs"), spec.UPPER).select("lat_i")
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "l_tax" not in schema and "l_extendedprice" not in schema


def test_recent_window_prunes_partitions(spark, fresh):
    path = fresh()
    rows = spark.createDataFrame(
        [(datetime(2026, 3, d), f"2026-03-{d}") for d in (20, 25, 26)], "forecast_reference_time timestamp, forecast_date string"
    )
    rows.write.partitionBy("forecast_date").parquet(path)
    df = recent_window(spark.read.schema(rows.schema).parquet(path), AS_OF)
    assert "forecast_date" in df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("]")[0]
    assert df.count() == 2


def test_stations_are_broadcast_and_facts_not_shuffled(spark, sf_dir):
    points = dims.city_points(stage(inputs.raw(spark, sf_dir, spec.UPPER, "gfs"), spec.UPPER), dims.stations(spark))
    fact = facts.to_fact(stage(inputs.raw(spark, sf_dir, spec.UPPER, "ifs"), spec.UPPER), "ifs", spec.UPPER, inputs.STAMP)
    city = unified.city_forecast(fact, points, spec.UPPER)
    plan = city._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1  # the points' distinct


def test_city_points_are_the_city_rows_of_the_grid(spark, sf_dir):
    staged, stations = stage(inputs.raw(spark, "/root/testdata/sf0.01", spec.UPPER, "gfs"), spec.UPPER), dims.stations(spark)
    a = dims.grid_dimension(staged, stations).where("is_city")
    b = dims.city_points(staged, stations)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 and b.count() > 0


def test_shared_point_has_two_keys_only_with_the_city(spark):
    point = spark.createDataFrame(
        [(129000, 103250, c, "X", "East", 0.1, "Hub", True) for c in ("Washington", "Baltimore")],
        "lat_i int, lon_i int, city_name string, state string, region string, market_weight double, associated_hub string, is_city boolean",
    )
    types = {"weather_model": "string", "cycle_date": "date", "valid_date": "date", "dbt_updated_at": "timestamp"}
    fixed = {"weather_model": "gfs", "cycle_date": "2026-03-25", "lat_i": 129000, "lon_i": 103250}
    fact = spark.range(1).select(
        *[
            F.lit(fixed.get(c)).cast(types.get(c, "float" if c in spec.FACT_METRICS[spec.UPPER] else "int")).alias(c)
            for c in spec.fact_columns(spec.UPPER)
        ]
    )
    plain = unified.city_forecast(fact, point, spec.UPPER)
    assert (plain.count(), plain.select("unique_key").distinct().count()) == (2, 1)
    assert unified.city_forecast(fact, point, spec.UPPER, city_in_key=True).select("unique_key").distinct().count() == 2


def test_station_band_reaches_the_scan(spark, fresh):
    path = fresh()
    spark.range(0, 180_001, 250).select(F.col("id").cast("int").alias("lat_i")).write.parquet(path)
    df = unified.near(spark.read.parquet(path), dims.stations(spark))
    assert df.count() == (137_750 - 115_500) // 250 + 1
    scan = df._jdf.queryExecution().executedPlan().toString().split("DataFilters: ")[1]
    assert "Subquery" in scan


def test_changed_since(spark):
    df = spark.createDataFrame([(datetime(2026, 3, d), d) for d in (1, 2, 3)], "dbt_updated_at timestamp, v int")
    assert values(unified.changed_since(df, df.where("v <= 2"))) == [2, 3]
    assert values(unified.changed_since(df, df.where("v > 9"))) == []
    assert values(unified.changed_since(df, df.where("v > 9"), null_mark="epoch")) == [1, 2, 3]


def test_known_locations_are_not_scanned_again(spark, sf_dir):
    existing = spark.createDataFrame([(1, 2, 3.0, 4.0)], "lat_i int, lon_i int, lat float, lon float")
    staged = stage(inputs.raw(spark, sf_dir, spec.SURFACE, "gfs"), spec.SURFACE)
    df = dims.location_dimension([staged], AS_OF, existing)
    assert df.count() == 0 and "parquet" not in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("days,dates", [(4, 4), (2, 2), (1, 1)])
def test_time_dimension(spark, days, dates):
    anchor = spark.range(1).select(F.lit(AS_OF).cast("date").alias("as_of"), facts.stamp_column(inputs.STAMP).alias("dbt_updated_at"))
    df = dims.time_dimension(anchor, days)
    assert df.count() == dates * 16
    row = df.where("cycle_date = date'2026-03-26' and cycle_hour = 18 and valid_date = date'2026-04-10'").first()
    assert row.valid_hour == 18
