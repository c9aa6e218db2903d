import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.functions import grid_index, grid_index_f32, quarter_degree, wrap_longitude
from gridcast.operators import dims, ingest

TS = datetime(2026, 3, 25, 6)


def test_flatten_equals_numpy(spark):
    rng = np.random.default_rng(1)
    lat, lon = [-20.0, -10.0, 0.0, 90.0], [0.0, 90.0, 180.0]
    messages = [(m, lat, lon, rng.random(12).astype("float32").tolist()) for m in range(3)]
    df = spark.createDataFrame(messages, "m int, lat array<double>, lon array<double>, t array<float>")
    got = {(r.m, r.latitude, r.longitude): r.t for r in ingest.flatten_grid(df, ["t"]).collect()}
    assert got == {
        (m, la, lo): v[i * 3 + j] for m, _, _, v in messages for i, la in enumerate(lat) for j, lo in enumerate(lon)
    }
    cropped = ingest.flatten_grid(df, ["t"], -10.0, 90.0)
    assert {r.latitude for r in cropped.collect()} == {-10.0, 0.0, 90.0}


def test_flatten_shorter_variable_is_null(spark):
    df = spark.createDataFrame([([0.0], [1.0, 2.0], [5.0])], "lat array<double>, lon array<double>, t array<float>")
    assert [r.t for r in ingest.flatten_grid(df, ["t"]).orderBy("longitude").collect()] == [5.0, None]


@pytest.mark.parametrize("lon,expected", [(180.0, -180.0), (-180.0, -180.0), (359.75, -0.25), (0.0, 0.0), (-190.0, 170.0)])
def test_wrap_longitude(spark, lon, expected):
    assert spark.range(1).select(wrap_longitude(F.lit(lon)).alias("x")).first().x == expected


def test_index_rounding(spark):
    df = spark.createDataFrame([(0.0005,), (-538099.0,), (None,), (float("nan"),), (1e300,)], "d double")
    got = [r.i for r in df.select(grid_index("d", 90).alias("i")).collect()]
    assert got[:3] == [90001, -538009000, -1] and got[4] == -1
    f32 = [r.i for r in df.select(grid_index_f32("d", 90).alias("i")).collect()]
    assert f32[1] == int(np.round((np.float32(-538099.0) + np.float32(90)) * np.float32(1000)))
    assert f32[2] is None


def test_index_of_the_quarter_grid_agrees_in_both_widths(spark):
    df = spark.range(721).select((F.lit(-90.0) + F.col("id") * 0.25).alias("lat"))
    both = df.select(grid_index("lat", 90).alias("a"), grid_index_f32("lat", 90).alias("b"))
    assert both.where("a <> b").count() == 0


def test_quarter_degree_is_half_even(spark):
    values = [0.125, 0.375, -0.125, 40.71, -74.01]
    got = [spark.range(1).select(quarter_degree(F.lit(v)).alias("x")).first().x for v in values]
    assert got == [round(v * 4) / 4 for v in values]


def test_times_with_and_without_step(spark):
    df = spark.createDataFrame([(TS, timedelta(hours=360, minutes=59))], "forecast_reference_time timestamp, step interval day to second")
    row = ingest.derive_times(df).first()
    assert (row.step_hours, row.forecast_date, row.forecast_cycle) == (360, "2026-03-25", 6)
    assert row.valid_time == TS + timedelta(hours=360, minutes=59)
    assert ingest.derive_times(df.drop("step")).first().valid_time == TS


def test_dedup_keeps_the_first_whatever_the_input_order(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("k"), F.col("id").alias("n"), (F.col("id") * 3).alias("v"))
    for df in (rows, rows.orderBy(F.rand(7)), rows.repartition(5)):
        got = {(r.k, r.n, r.v) for r in ingest.dedup_first(df, ["k"], ["n"]).collect()}
        assert got == {(k, k, 3 * k) for k in range(7)}


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = ingest.dedup_first(spark.range(10).withColumn("k", F.col("id") % 3), ["k"], ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_union_keeps_first_seen_order(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "z int, x int")
    df = ingest.union_by_name([a, b])
    assert df.columns == ["x", "y", "z"]
    assert {tuple(r) for r in df.collect()} == {(1, 2, None), (4, None, 3)}


def test_names_and_mandatory_variables(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "prmsl float, `2t` float, t2m float")
    # A unified name that is already there is not made a second time.
    assert ingest.canonical_names(df).columns == ["msl", "2t", "t2m"]
    with pytest.raises(ingest.MissingVariables, match="d2m"):
        ingest.require_variables(df, spec.SURFACE)
    ingest.require_variables(df, spec.SPREAD)


def test_missing_target_is_the_first_present(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, None), (float("nan"), 3.0)], "msl float, t2m float")
    assert [r.msl for r in ingest.drop_missing_target(df).collect()] == [2.0]
    other = df.select(F.col("t2m").alias("wind"))
    assert ingest.drop_missing_target(other).count() == 3


def test_geopotential(spark):
    both = spark.createDataFrame([(98066.5, None), (98066.5, 1.0)], "z float, gh float")
    assert [round(r.gh, 3) for r in ingest.geopotential_to_height(both).collect()] == [10000.0, 1.0]
    assert ingest.geopotential_to_height(both.drop("gh")).first().gh == pytest.approx(10000.0)
    assert ingest.geopotential_to_height(both.drop("z")).columns == ["gh"]


def test_evolve_and_strict(spark):
    table = spark.createDataFrame([], "a int, b string")
    df = spark.createDataFrame([(1.0, 5)], "c double, a long")
    assert ingest.evolve_to(df, table.schema).columns == ["a", "b", "c"]
    with pytest.raises(ingest.SchemaMismatch, match="missing"):
        ingest.align_strict(df, table.schema)
    aligned = ingest.align_strict(df.select(F.lit("x").alias("b"), "a"), table.schema)
    assert aligned.dtypes == [("a", "int"), ("b", "string")]


def test_unpublished_products_are_dropped(spark):
    df = spark.createDataFrame(
        [("ifs", 0, 240), ("ifs", 6, 240), ("ifs", 0, 192), ("aifs", 0, 240)], "model string, forecast_cycle int, step_hours int"
    )
    assert [tuple(r) for r in ingest.filter_published(df, spec.SPREAD).collect()] == [("ifs", 0, 240)]
    assert ingest.filter_published(df, spec.UPPER).count() == 3


@pytest.mark.parametrize(
    "task,trigger,date,hour,own",
    [
        ("gfs-upper", "2026-03-25 04:41:00", "2026-03-25", 0, 0),
        ("gfs-upper", "2026-03-25 13:40:00", "2026-03-25", 12, 6),  # nominal 09:00: 1.5 rounds to 2
        ("gfs-upper", "2026-03-26 01:41:00", "2026-03-26", 0, 18),  # nominal 21:01: 3.5 rounds to 4, next day
        ("ifs-upper", "2026-03-25 14:40:00", "2026-03-25", 6, 0),  # rounding ignores the model's own cycles
        ("unknown", "2026-03-25 04:40:00", "2026-03-25", 0, 0),
    ],
)
def test_cycle_resolution(spark, task, trigger, date, hour, own):
    df = spark.createDataFrame([(task, trigger)], "task string, t string").select(
        "task", F.col("t").cast("timestamp").alias("trigger_time")
    )
    row = ingest.resolve_cycle(df).first()
    assert (str(row.cycle_date), row.cycle_hour) == (date, hour)
    assert ingest.resolve_cycle(df, own_cycles=True).first().cycle_hour == own


def test_z500_units_and_empty_fields(spark):
    rows = [("a", 500, 50000.0), ("b", 500, 5000.0), ("c", 500, 500.0), ("d", 500, None), ("a", 850, 1.0), ("b", 500, float("nan"))]
    df = spark.createDataFrame(rows, "f string, isobaricInhPa int, gh float")
    got = {(r.f, None if math.isnan(r.z500_dam) else round(r.z500_dam, 2)) for r in ingest.scale_z500(df, ["f"]).collect()}
    assert got == {("a", 509.86), ("b", 500.0), ("b", None), ("c", 500.0)}


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    lats, lons = sorted(rng.choice(18000, 23, replace=False) * 10), sorted(rng.choice(36000, 31, replace=False) * 10)
    cells = {(int(a), int(o)): float(rng.random()) for a in lats for o in lons if rng.random() < 0.8}
    lats, lons = sorted({a for a, _ in cells}), sorted({o for _, o in cells})
    points = [(i, float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180))) for i in range(300)]
    points += [(1000, (lats[3] + lats[4]) / 2000 - 90, 0.0), (1001, 89.9, 359.0), (1002, -90.0, -180.0)]
    grid = spark.createDataFrame([(a, o, v) for (a, o), v in cells.items()], "lat_i int, lon_i int, v double")
    df = spark.createDataFrame(points, "id int, latitude double, longitude double")
    got = {r.id: r.sampled for r in ingest.sample_nearest(df, grid, "v").collect()}

    def nearest(axis, at):
        return min(axis, key=lambda x: (abs(x - at), -x))

    for i, la, lo in points:
        wrapped = (lo + 180) % 360 - 180
        assert got[i] == cells.get((nearest(lats, (la + 90) * 1000), nearest(lons, (wrapped + 180) * 1000)), 0.0)


def test_last_slice_is_the_end_of_each_axis(spark):
    rows = [("a", 240, 500, 1), ("a", 360, 250, 2), ("a", 360, 500, 3), ("b", 192, 250, 4), ("b", 192, 850, 5)]
    df = spark.createDataFrame(rows, "m string, step int, level int, v int")
    assert {r.v for r in ingest.last_slice(df, ["m"], ["step", "level"]).collect()} == {3, 5}


def test_city_stations(spark):
    got = dims.stations(spark)
    assert got.count() == 216
    assert got.select("lat_i", "lon_i").distinct().count() == 214
    assert got.select("city_name").distinct().count() == 25
    shared = {r.city_name for r in got.where("lat_i = 129000 and lon_i = 103250").collect()}
    assert shared == {"Washington", "Baltimore"}
    chicago = got.where("city_name = 'Chicago'").agg(F.max("lon")).first()[0]
    assert chicago == -87.5


def test_nearest_ignores_rows_off_the_globe_and_repeated_cells(spark):
    cells = [(90_000, 180_000, 5.0), (90_000, 180_000, 3.0), (90_000, 181_000, 7.0), (2**29, 180_000, 9.0), (-(2**29), 10, 9.0), (None, 5, 1.0)]
    grid = spark.createDataFrame(cells, "lat_i int, lon_i int, t double")
    points = spark.createDataFrame([("p", 0.0, 0.0), ("q", 0.1, 0.9)], "name string, latitude double, longitude double")
    found = ingest.sample_nearest(points, grid, "t")
    assert {r.name: r.sampled for r in found.collect()} == {"p": 3.0, "q": 7.0} and found.count() == 2
