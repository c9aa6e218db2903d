import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.operators import dims, ingest, quality, writers
from gridcast.operators.events import coalesce_events, coalesce_from_first
from gridcast.operators.staging import stage
from gridcast.plans import flows, inputs, queries
from gridcast.plans.views import register_views
from gridcast.sources.tables import read_raw
from gridcast.streaming.jobs import refresh_windows, windows_from_first

GFS_UPPER = spec.product("gfs", spec.UPPER)
RUN = dict(dag_id="d", run_id="r", logical_date="2026-03-26 00:00:00")


def test_stream_of_events_equals_the_batch_up_to_the_watermark(spark, sf_dir, fresh):
    source, sink, checkpoint = fresh(), fresh(), fresh()
    batch = inputs.asset_events(spark, sf_dir)
    batch.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    query = (
        refresh_windows(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()
    got = spark.read.parquet(sink)
    closed = batch.agg(F.max("ts") - F.expr("interval 10 minutes")).first()[0]
    batch = batch.withColumn("ts", F.col("ts").cast("timestamp"))
    expected = coalesce_events(batch).where(F.col("window_end") <= F.lit(closed))
    assert got.count() > 0
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


URI = "s3://b/weather_data/delta_lake/gfs_raw/gfs_{}/"


def plain_windows(events):
    """Windows of (time, model) by one loop over the events."""
    out = []
    for ts, model in sorted(events):
        if not out or ts >= out[-1][0] + timedelta(minutes=5):
            out.append([ts, set(), 0])
        out[-1][1].add(model)
        out[-1][2] += 1
    return [(a, a + timedelta(minutes=5), ",".join(sorted(m)), n) for a, m, n in out]


def bursts(n=400, seed=3):
    """Events in bursts and pauses: ties, gaps of exactly five minutes, long unbroken stretches."""
    r, at, out = random.Random(seed), datetime(2026, 3, 26), []
    for _ in range(n):
        at += timedelta(seconds=r.choice([0, 1, 20, 90, 150, 299, 300, 301, 700]))
        out.append((at, r.choice(["upper", "surface"])))
    return out


def as_rows(spark, events):
    return spark.createDataFrame([(ts, URI.format(kind)) for ts, kind in events], "ts timestamp_ntz, uri string")


def test_windows_opened_by_an_event(spark):
    events = bursts()
    df = as_rows(spark, events).unionAll(spark.createDataFrame([(None, URI.format("upper")), (events[0][0], "s3://b/other/")], "ts timestamp_ntz, uri string"))
    got = sorted(tuple(r) for r in coalesce_from_first(df.repartition(5)).collect())
    assert got == plain_windows([(ts, f"gfs_{kind}") for ts, kind in events])
    assert coalesce_from_first(df.limit(0)).count() == 0


@pytest.mark.parametrize("cuts", [1, 4])
def test_stream_of_windows_opened_by_an_event(spark, fresh, cuts):
    """However the events are cut into micro-batches, and shuffled within the lateness, the windows are the same."""
    source, sink, checkpoint = fresh(), fresh(), fresh()
    events = bursts(120)
    r = random.Random(cuts)
    late = sorted(events, key=lambda e: e[0] + timedelta(minutes=r.random() * 8))
    last = events[-1][0]
    step = -(-len(late) // cuts)
    for i in range(0, len(late), step):
        as_rows(spark, late[i : i + step]).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("ts timestamp_ntz, uri string").parquet(source)
        query = windows_from_first(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start(sink).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    expected = plain_windows([(ts, f"gfs_{kind}") for ts, kind in events])
    assert got == [w for w in expected if w[1] <= last - timedelta(minutes=10)] and len(got) > 10


@pytest.fixture(scope="module")
def messages(spark):
    """Two messages of one cycle on a 4 x 4 grid, one of them twice."""
    lat, lon = [90.0, 40.5, -10.0, -10.25], [0.0, 90.0, 180.0, 285.75]
    values = [float(i) for i in range(16)]
    holes = [None if i == 5 else v for i, v in enumerate(values)]
    rows = [
        (datetime(2026, 3, 26, 6), timedelta(hours=240), level, lat, lon, z, values, values, values)
        for level, z in ((500, values), (850, holes), (500, values))
    ]
    return spark.createDataFrame(
        rows,
        "forecast_reference_time timestamp, step interval day to second, isobaricInhPa int, lat array<double>, "
        "lon array<double>, gh array<double>, t array<double>, u array<double>, v array<double>",
    )


def test_ingest_of_a_cycle(spark, messages, fresh):
    path, audit_path = fresh(), fresh()
    for _ in range(2):  # ingesting the cycle again replaces it
        audit = flows.ingest_cycle(messages, GFS_UPPER, path, ["gh", "t", "u", "v"], RUN, audit_path, spread_over=2)
        raw = read_raw(spark, path, spec.UPPER)
        # 3 of 4 latitudes, 4 longitudes, 2 levels, one hole, no repeats.
        assert raw.count() == 23
        assert audit.first().status == "SUCCESS" and audit.first().records_loaded == 23
    assert {r.longitude for r in raw.collect()} == {0.0, 90.0, -180.0, -74.25}
    assert {(r.forecast_date, r.forecast_cycle, r.step_hours) for r in raw.collect()} == {("2026-03-26", 6, 240)}
    assert spark.read.parquet(audit_path).count() == 2


def test_the_order_of_messages_decides_between_repeats(spark, messages, fresh):
    """The third message repeats the first; with other values it wins or loses by its place, not by the values."""
    path = fresh()
    for first in (1, 3):
        numbered = messages.where("isobaricInhPa = 500").withColumn("n", F.monotonically_increasing_id())
        least = numbered.agg(F.min("n")).first()[0]
        arrived = F.when(F.col("n") == least, 2).otherwise(first).alias("arrived")
        gh = F.when(F.col("n") == least, F.col("gh")).otherwise(F.transform("gh", lambda x: x + 100)).alias("gh")
        given = numbered.select(arrived, gh, *[c for c in messages.columns if c != "gh"])
        flows.ingest_cycle(given, GFS_UPPER, path, ["gh", "t", "u", "v"], RUN, order=["arrived"])
        rows = read_raw(spark, path, spec.UPPER)
        assert rows.columns == spec.raw_schema(spec.UPPER).names and rows.count() == 12
        assert rows.agg(F.min("gh")).first()[0] == (100.0 if first == 1 else 0.0)


def test_ingest_needs_its_variables(messages, fresh):
    with pytest.raises(ingest.MissingVariables):
        flows.ingest_cycle(messages, GFS_UPPER, fresh(), ["gh", "t"], RUN)


def test_a_failed_load_leaves_an_audit_row(spark, messages, fresh):
    path, audit_path = fresh(), fresh()
    with pytest.raises(ingest.MissingVariables):
        flows.ingest_cycle(messages, GFS_UPPER, path, ["gh", "t"], RUN, audit_path)
    south = messages.withColumn("lat", F.transform("lat", lambda x: -80 - F.abs(x) / 100))
    with pytest.raises(ingest.EmptyBatch):
        flows.ingest_cycle(south, GFS_UPPER, path, ["gh", "t", "u", "v"], RUN, audit_path)
    rows = spark.read.parquet(audit_path).collect()
    assert [r.status for r in rows] == ["FAILED"] * 2 and any("EmptyBatch" in r.validation_details for r in rows)
    assert not writers.table_exists(spark, path)


def test_a_new_variable_can_be_read_back(spark, messages, fresh):
    path = fresh()
    more = messages.withColumn("q", F.col("t"))
    flows.ingest_cycle(more, GFS_UPPER, path, ["gh", "t", "u", "v", "q"], RUN)
    raw = read_raw(spark, path, spec.UPPER)
    assert raw.columns[-1] == "q" and raw.where("q is null").count() == raw.where("t is null").count()


def raw_table(spark, sf_dir, fresh, product):
    path = fresh()
    writers.append_partitions(inputs.raw(spark, sf_dir, product.shape, product.model), path)
    return path


@pytest.mark.parametrize("rule", flows.LOAD_RULES)
def test_load_rules(spark, sf_dir, fresh, rule):
    raw_path, fact_path = raw_table(spark, sf_dir, fresh, GFS_UPPER), fresh()
    staged = stage(read_raw(spark, raw_path, spec.UPPER), spec.UPPER)
    since = {"latest": 1, "merge": 1, "window": 3}.get(rule, 99)
    window = staged.where(F.col("cycle_date") >= F.date_sub(F.lit("2026-03-26").cast("date"), since))
    if rule == "merge":
        window = window.dropDuplicates(spec.fact_key(spec.UPPER))
    first = window.count()
    for run in range(2):
        flows.load_fact(spark, GFS_UPPER, raw_path, fact_path, rule, "2026-03-26", inputs.STAMP)
        loaded = spark.read.parquet(fact_path).count()
        if rule == "latest":
            assert 0 < loaded <= first
        elif rule == "window" and run == 1:
            assert loaded > first  # this rule appends its window again
        else:
            assert loaded == first


def test_unknown_load_rule(spark):
    with pytest.raises(ValueError):
        flows.load_fact(spark, GFS_UPPER, "a", "b", "guess", "2026-03-26", inputs.STAMP)


def test_refresh_loads_only_what_was_updated(spark, sf_dir, fresh):
    root = fresh()
    writers.append_partitions(inputs.raw(spark, sf_dir, spec.UPPER, "gfs"), f"{root}/raw/gfs_upper")
    event = spark.createDataFrame([("2026-03-26 11:59:00", "s3://x/gfs_raw/gfs_upper/")], "t string, uri string").select(
        F.col("t").cast("timestamp_ntz").alias("ts"), "uri"
    )
    runs = spark.createDataFrame([], "state string, start_date timestamp_ntz")
    args = (root, "2026-03-26", inputs.STAMP)
    assert flows.refresh_updated(spark, event, runs, "2026-03-26 12:00:00", *args) == ["fct_gfs_upper"]
    assert flows.refresh_updated(spark, event, runs, "2026-03-26 13:00:00", *args) == []
    assert spark.read.parquet(f"{root}/gold/fct_gfs_upper").count() > 0


def test_daily_run(spark, sf_dir, fresh):
    root = fresh()
    for p in spec.PRODUCTS:
        if p.published:
            rows = inputs.raw(spark, sf_dir, p.shape, p.model)
            # Every cycle of the day before must be there: copy one where the data has gaps.
            fill = rows.limit(1).select(
                *[c for c in rows.columns if c not in spec.RAW_PARTITIONS],
                F.lit("2026-03-25").alias("forecast_date"),
                F.explode(F.array(*[F.lit(c) for c in p.cycles])).alias("forecast_cycle"),
            )
            writers.append_partitions(rows.unionByName(fill), f"{root}/raw/{p.table}")
    instant = F.lit("2026-03-26 12:00:00").cast("timestamp")
    got = flows.daily_run(spark, root, instant, "2026-03-26", inputs.STAMP)
    assert {(r.view_name, r.status) for r in got.collect()} == {(f"fct_{s}_forecast", "SUCCESS") for s in spec.SHAPES}
    with pytest.raises(RuntimeError, match="missing"):
        flows.daily_run(spark, root, F.lit("2026-04-20 12:00:00").cast("timestamp"), "2026-04-20", inputs.STAMP)

    def count(name):
        there = writers.table_exists(spark, f"{root}/{name}")  # a city fact without rows has no partitions
        return spark.read.parquet(f"{root}/{name}").count() if there else 0

    first = {n: count(f"gold/{n}") for n in ("dim_grid_points", "dim_locations", "dim_times", "partition_calendar")}
    assert all(first.values()) and first["dim_times"] == 64
    cities = {s: count(f"gold/fct_{s}_forecast_cities") for s in spec.SHAPES}
    assert spark.read.parquet(f"{root}/audit/gold").first().status == "SUCCESS"
    flows.daily_run(spark, root, instant, "2026-03-26", inputs.STAMP, keep_days=2)
    assert {n: count(f"gold/{n}") for n in first} == first  # nothing is added twice
    assert {s: count(f"gold/fct_{s}_forecast_cities") for s in spec.SHAPES} == cities
    assert count("audit/gold") == 2
    # The second run measured the newest cycles only; its check says what one over all rows says, and one made anew.
    again = flows.daily_run(spark, root, instant, "2026-03-26", inputs.STAMP)
    views = {s: {p.model: f"{root}/gold/{p.fact}" for p in spec.PRODUCTS if p.published and p.shape == s} for s in spec.SHAPES}
    scanned = quality.verify_gold({f"fct_{s}_forecast": flows.unified_view(spark, v, s) for s, v in views.items()}).collect()
    assert again.collect() == scanned
    assert flows.daily_run(spark, root, instant, "2026-03-26", inputs.STAMP, recheck=True).collect() == scanned
    dates = {p["forecast_date"] for p in writers.partition_dirs(spark, f"{root}/raw/gfs_upper", spec.RAW_PARTITIONS)}
    assert dates and min(dates) >= "2026-03-24"

    names = register_views(spark, root, "2026-03-26", inputs.STAMP)
    assert len(names) == 7 + 7 + 7 + 1 + 3 + 6
    got = spark.sql(
        """SELECT f.weather_model, count(*) AS n, sum(CASE WHEN s.lat_i IS NULL THEN 1 ELSE 0 END) AS unknown
           FROM fct_upper_forecast f LEFT JOIN dim_grid_points s ON f.lat_i = s.lat_i AND f.lon_i = s.lon_i
           WHERE f.cycle_date = DATE'2026-03-25' GROUP BY 1"""
    )
    assert {r.weather_model: r.unknown for r in got.collect()}["gfs"] == 0
    assert spark.sql("SELECT count(*) AS n FROM fct_upper_forecast_cities c JOIN ref_weather_station USING (lat_i, lon_i)").count() == 1
    assert spark.table("stg_ecmwf_ifs_spread").count() > 0 and spark.table("dim_times").count() == 64

    forecast = flows.unified_view(spark, {"gfs": f"{root}/gold/fct_gfs_upper"}, spec.UPPER)
    staged = stage(inputs.raw(spark, "/root/testdata/sf0.01", spec.UPPER, "gfs"), spec.UPPER)
    points = dims.city_points(staged, dims.stations(spark))
    path = fresh()
    for _ in range(2):
        flows.refresh_city_fact(forecast, points, dims.stations(spark), spec.UPPER, path)
    city = spark.read.parquet(path)
    assert city.count() == city.select("unique_key").distinct().count()


def test_both_cuts_read_one_raw_table(spark, sf_dir, monkeypatch):
    """Each delivery of a model is written once, and streams that don't wait for each other run at once."""
    written, active, append, start = [], [], writers.append_partitions, queries.load_arrivals_stream

    def counted(df, path, *args, **kwargs):
        written.append(path)
        append(df, path, *args, **kwargs)

    def started(*args):
        stream = start(*args)
        active.append(stream)
        return stream

    monkeypatch.setattr(writers, "append_partitions", counted)
    monkeypatch.setattr(queries, "load_arrivals_stream", started)
    got = queries.QUERIES["stream_ingest_cuts"](spark, sf_dir)
    raw = [p for p in written if "raw" in p]
    assert len(raw) == 6 and len(set(raw)) == 3 and len(active) == 9 and not any(s.isActive for s in active)
    sides = [got.where(F.col("cut") == c).drop("cut") for c in ("deliveries", "files")]
    assert sides[0].count() > 0 and sides[0].exceptAll(sides[1]).isEmpty() and sides[1].exceptAll(sides[0]).isEmpty()
