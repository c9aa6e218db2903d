"""Registered queries: one per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.functions import hash_key
from gridcast.operators import calendar, dims, events, facts, ingest, profiles, quality, unified, writers
from gridcast.operators.staging import geo_guard, recent_window, region_box, stage
from gridcast.plans import flows, inputs
from gridcast.plans.inputs import AS_OF, EARLIER_STAMP, ORDINAL, STAMP
from gridcast.session import configure, work_path
from gridcast.sources import describe, footers, listing, seeds, tables
from gridcast.streaming.jobs import load_arrivals_stream, load_fact_stream, stream_raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

UPPER, SURFACE, SPREAD = spec.SHAPES
FIRST = list(ORDINAL)


def query(name: str):
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        return run

    return register


def _stored(df: DataFrame, shape: str) -> DataFrame:
    return df.select(*spec.raw_schema(shape).names)


def _staged(spark, sf_dir, shape, model, **options) -> DataFrame:
    return stage(inputs.raw(spark, sf_dir, shape, model, ordinal=bool(options.get("keep"))), shape, **options)


def _fact(spark, sf_dir, shape, model, stamp=STAMP, keep=()) -> DataFrame:
    return facts.to_fact(_staged(spark, sf_dir, shape, model, keep=keep), model, shape, stamp, keep=keep)


def _unified(spark, sf_dir, shape) -> DataFrame:
    models = spec.MODELS if shape != SPREAD else ("aifs", "ifs")
    return unified.unify({m: _fact(spark, sf_dir, shape, m) for m in models}, shape)


def _written_raw(spark, sf_dir, shape, name) -> str:
    path = work_path(spark, name)
    writers.append_partitions(inputs.raw(spark, sf_dir, shape).drop("model"), path)
    return path


# --------------------------------------------------------- scans, sources, sinks


@query("raw_scan")
def raw_scan(spark, sf_dir):
    path = _written_raw(spark, sf_dir, UPPER, "raw_scan")
    return tables.read_raw(spark, path, UPPER, since="2026-03-23")


@query("ext_scan")
def ext_scan(spark, sf_dir):
    path = _written_raw(spark, sf_dir, UPPER, "ext_scan")
    return tables.read_external(spark, f"{path}/forecast_date=2026-03-2*", UPPER)


@query("seed_load")
def seed_load(spark, sf_dir):
    path = work_path(spark, "seed_load")
    dims.station_grid(inputs.customer_cities(spark, sf_dir)).write.option("header", True).csv(path)
    return seeds.load_seed(spark, path, "weather_station")


@query("raw_append")
def raw_append(spark, sf_dir):
    path = work_path(spark, "raw_append")
    batches = inputs.raw(spark, sf_dir, SURFACE).drop("model")
    for part in (F.col("forecast_cycle") < 12, F.col("forecast_cycle") >= 12):
        writers.append_partitions(batches.where(part), path)
    return tables.read_raw(spark, path, SURFACE)


def _replace(spark, sf_dir, wipe):
    """A table holds early cycles; a batch with two (date, cycle) pairs replaces partitions."""
    path = work_path(spark, f"partition_replace_{wipe}")
    rows = inputs.raw(spark, sf_dir, UPPER).drop("model")
    writers.append_partitions(rows, path)
    pairs = ((F.col("forecast_date") == "2026-03-24") & (F.col("forecast_cycle") == 6)) | (
        (F.col("forecast_date") == "2026-03-25") & (F.col("forecast_cycle") == 12)
    )
    batch = rows.where(pairs & F.col("gh").isNotNull()).withColumn("t", (F.col("t") + 1).cast("float"))
    writers.replace_partitions(batch, path, wipe=wipe)
    return tables.read_raw(spark, path, UPPER)


@query("partition_replace")
def partition_replace(spark, sf_dir):
    return _replace(spark, sf_dir, "exact")


@query("partition_replace_product")
def partition_replace_product(spark, sf_dir):
    return _replace(spark, sf_dir, "product")


@query("parquet_export")
def parquet_export(spark, sf_dir):
    path = work_path(spark, "parquet_export")
    rows = inputs.raw(spark, sf_dir, SPREAD).drop("model")
    writers.export_parquet(rows, path)
    # Exporting one day again leaves the other days and does not double this one.
    writers.export_parquet(rows.where("forecast_date = '2026-03-22'"), path)
    return tables.read_raw(spark, path, SPREAD)


@query("index_ranges")
def index_ranges(spark, sf_dir):
    keys = spec.INDEX_KEYS[UPPER] + spec.INDEX_KEYS[SURFACE]
    return listing.index_ranges(inputs.index_texts(spark, sf_dir), keys)


@query("listing_ready")
def listing_ready(spark, sf_dir):
    last = max(spec.STEPS)
    return listing.listing_ready(
        inputs.listing_pages(spark, sf_dir), listing.target_file(last, ensemble=False), listing.sentinel_file(0, last)
    )


DESCRIBED = ("lineitem", "orders", "customer", "supplier", "part", "nation", "region", "events", "documents",
             "embeddings", "pages", "benchmark", "labels", "conversations")


@query("schema_map")
def schema_map(spark, sf_dir):
    described = [describe.describe(spark.read.parquet(f"{sf_dir}/{t}.parquet"), t) for t in DESCRIBED]
    return reduce(DataFrame.unionByName, described)


# -------------------------------------------------------------- grids to rows


def _grid_messages(spark, sf_dir):
    """Embeddings as 8 x 8 grids whose south edge depends on the label; two variables."""
    steps = F.sequence(F.lit(0), F.lit(7))
    south = F.lit(-11.0) + F.col("label") * F.lit(0.25)
    return inputs.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("message_id"),
        F.transform(steps, lambda i: south + i * F.lit(0.25)).alias("lat"),
        F.transform(steps, lambda i: F.lit(178.0) + i * F.lit(0.5)).alias("lon"),
        F.col("embedding").alias("gh"),
        F.reverse("embedding").alias("t"),
    )


@query("grid_flatten")
def grid_flatten(spark, sf_dir):
    points = ingest.flatten_grid(_grid_messages(spark, sf_dir), ["gh", "t"], spec.CROP_SOUTH, spec.CROP_NORTH)
    return ingest.normalize_longitude(points)


@query("ingest_order")
def ingest_order(spark, sf_dir):
    """Messages that repeat each other's points into a raw table: of a point the latest message's value stays."""
    path = work_path(spark, "ingest_order")
    messages = _grid_messages(spark, sf_dir).select(
        (-F.col("message_id")).alias("arrived"),
        (F.lit("2026-03-26 00:00:00").cast("timestamp") + F.make_dt_interval(hours=(F.col("message_id") % 4 * 6).cast("int"))).alias("forecast_reference_time"),
        F.make_dt_interval(hours=F.lit(240)).alias("step"),
        F.get(F.array(F.lit(250), F.lit(500), F.lit(850)), (F.col("message_id") % 3).cast("int")).alias("isobaricInhPa"),
        "lat", "lon", "gh", "t", F.col("gh").alias("u"), F.col("t").alias("v"),
    )
    about = {"dag_id": "ingest_order", "run_id": AS_OF, "logical_date": AS_OF}
    flows.ingest_cycle(messages, spec.product("gfs", UPPER), path, ["gh", "t", "u", "v"], about, order=["arrived"])
    return tables.read_raw(spark, path, UPPER)


def _plain(spark, sf_dir, *columns):
    return inputs.all_upper(spark, sf_dir).select(*ORDINAL, *columns)


@query("lon_normalize")
def lon_normalize(spark, sf_dir):
    return ingest.normalize_longitude(_plain(spark, sf_dir, "longitude_360"), "longitude_360")


@query("lat_crop")
def lat_crop(spark, sf_dir):
    # Shift the fixture south so that both ends of the band cut.
    df = _plain(spark, sf_dir, (F.col("latitude") - 30).alias("latitude"))
    return ingest.crop_latitude(df)


@query("drop_missing_target")
def drop_missing_target(spark, sf_dir):
    gh = F.when(F.col("src_qty") == 7, F.lit("NaN").cast("float")).otherwise(F.col("gh")).alias("gh")
    return ingest.drop_missing_target(_plain(spark, sf_dir, gh, "t"))


@query("fixed_point_index")
def fixed_point_index(spark, sf_dir):
    df = inputs.base(spark, sf_dir).select(
        *ORDINAL, "latitude", F.col("longitude_360").alias("longitude"), F.col("src_disc").alias("tp")
    )
    return ingest.add_index(df, ["tp"])


@query("time_derive")
def time_derive(spark, sf_dir):
    df = inputs.all_upper(spark, sf_dir).select(
        *ORDINAL, "forecast_reference_time", F.make_dt_interval(hours=F.col("step_hours"), mins=F.lit(30)).alias("step")
    )
    return ingest.derive_times(df)


@query("dedup_first")
def dedup_first(spark, sf_dir):
    df = inputs.raw(spark, sf_dir, UPPER, ordinal=True).drop("model")
    return _stored(ingest.dedup_first(df, spec.raw_key(df.columns), FIRST), UPPER)


@query("union_by_name")
def union_by_name(spark, sf_dir):
    rows = inputs.raw(spark, sf_dir, SURFACE).drop("model")
    batches = [
        rows.where("step_hours = 192").drop("tp"),
        rows.where("step_hours = 240").drop("d2m", "surface"),
        rows.where("step_hours > 240"),
    ]
    return ingest.union_by_name(batches)


@query("rename_mandatory")
def rename_mandatory(spark, sf_dir):
    rows = inputs.raw(spark, sf_dir, SURFACE).drop("model").withColumnsRenamed(
        {"t2m": "2t", "d2m": "2d", "msl": "prmsl", "tp": "apcp"}
    )
    return ingest.require_variables(ingest.canonical_names(rows), SURFACE)


@query("z_to_gh")
def z_to_gh(spark, sf_dir):
    z = (F.col("src_part") * 49).cast("float").alias("z")
    return ingest.geopotential_to_height(_plain(spark, sf_dir, "gh", z))


@query("schema_evolve")
def schema_evolve(spark, sf_dir):
    """A later batch lacks u and brings q, a column of no declared schema, which can be read back."""
    path = work_path(spark, "schema_evolve")
    rows = inputs.raw(spark, sf_dir, UPPER).drop("model")
    first = rows.drop("v")
    writers.append_partitions(first.where("forecast_date < '2026-03-24'"), path)
    writers.keep_schema(spark, path, first.schema)
    later = rows.drop("u").where("forecast_date >= '2026-03-24'").withColumn("q", (F.col("t") / 1000).cast("float"))
    batch = ingest.evolve_to(later, first.schema)
    writers.replace_partitions(batch, path)
    writers.keep_schema(spark, path, batch.schema)
    return tables.read_raw(spark, path, UPPER)


@query("schema_widen")
def schema_widen(spark, sf_dir):
    """Three deliveries: the second brings wider types, the third the first's again; all can be read back."""
    path = work_path(spark, "schema_widen")
    rows = inputs.raw(spark, sf_dir, UPPER).drop("model")
    narrow = {"n": F.col("step_hours"), "q": (F.col("t") / 1000).cast("float"), "w": F.col("step_hours")}
    broad = {"n": F.col("step_hours").cast("bigint") * 10**9, "q": F.col("t") / 1000, "w": F.col("t")}
    day = F.col("forecast_date")
    for taken, extra in ((day < "2026-03-23", narrow), (day.between("2026-03-23", "2026-03-24"), broad), (day > "2026-03-24", narrow)):
        known = writers.stored_schema(spark, path) or spec.raw_schema(UPPER)
        batch = ingest.evolve_to(rows.where(taken).withColumns(extra), known)
        writers.keep_schema(spark, path, batch.schema)
        writers.append_partitions(batch, path)
    return tables.read_raw(spark, path, UPPER)


@query("schema_strict")
def schema_strict(spark, sf_dir):
    rows = inputs.raw(spark, sf_dir, SPREAD).drop("model")
    loose = rows.select(*[F.col(c).cast("double").alias(c) if t == "float" else F.col(c) for c, t in reversed(rows.dtypes)])
    return ingest.align_strict(loose, spec.raw_schema(SPREAD))


@query("product_filter")
def product_filter(spark, sf_dir):
    # Cycles and steps as the upper fixture has them, so that unpublished ones occur.
    rows = inputs.raw(spark, sf_dir, UPPER).select("model", *spec.RAW_KEY, "gh", "t")
    return ingest.filter_published(rows, SPREAD)


def _triggers(spark, sf_dir):
    tasks = F.array(*[F.lit(p.task) for p in spec.PRODUCTS], F.lit("other"))
    return inputs.table(spark, sf_dir, "events").select(
        "event_id",
        F.get(tasks, (F.col("user_id") % 9).cast("int")).alias("task"),
        F.col("ts").cast("timestamp").alias("trigger_time"),
    )


@query("cycle_resolve")
def cycle_resolve(spark, sf_dir):
    return ingest.resolve_cycle(_triggers(spark, sf_dir))


@query("cycle_resolve_own")
def cycle_resolve_own(spark, sf_dir):
    return ingest.resolve_cycle(_triggers(spark, sf_dir), own_cycles=True)


FIELD = ("model", "forecast_date", "forecast_cycle", "step_hours")


@query("z500_scale")
def z500_scale(spark, sf_dir):
    rows = inputs.raw(spark, sf_dir, UPPER, ordinal=True)
    # AIFS heights as geopotential, IFS heights as decametres: the fields must tell.
    factor = F.when(F.col("model") == "aifs", F.lit(10.0)).when(F.col("model") == "ifs", F.lit(0.125)).otherwise(F.lit(1.0))
    rows = rows.withColumn("gh", (F.col("gh").cast("double") * factor).cast("float"))
    return ingest.scale_z500(rows, FIELD).select(*FIELD, *ORDINAL, "gh", "z500_dam")


@query("nearest_sample")
def nearest_sample(spark, sf_dir):
    points = inputs.customer_cities(spark, sf_dir).select("city_name", "latitude", "longitude")
    # The raw rows of all models and times; of several rows for a cell the least value counts.
    grid = inputs.raw(spark, sf_dir, SURFACE).drop("model")
    return ingest.sample_nearest(points, grid, "t2m")


@query("last_slice")
def last_slice(spark, sf_dir):
    rows = inputs.raw(spark, sf_dir, UPPER)
    return ingest.last_slice(rows, ["model", "forecast_date", "forecast_cycle"], ["step_hours", "isobaricInhPa"]).select(
        "model", *spec.raw_key(rows.columns), "gh", "t"
    )


# -------------------------------------------------------------------- staging


def _register_staging():
    for p in spec.PRODUCTS:
        def run(spark, sf_dir, p=p):
            return _staged(spark, sf_dir, p.shape, p.model)

        # The first model of a shape carries the shape's own name.
        query(f"stg_{p.shape}_{p.model}")(run)
    QUERIES["stg_upper"] = QUERIES.pop("stg_upper_gfs")
    QUERIES["stg_surface"] = QUERIES.pop("stg_surface_gfs")
    QUERIES["stg_spread"] = QUERIES.pop("stg_spread_aifs")


_register_staging()


@query("geo_guard")
def geo_guard_query(spark, sf_dir):
    return geo_guard(inputs.raw(spark, sf_dir, SURFACE))


@query("region_box")
def region_box_query(spark, sf_dir):
    # In the 0..360 convention too: half the box's definition.
    rows = inputs.all_surface(spark, sf_dir).withColumn(
        "longitude", F.when(F.col("model_no") == 1, F.col("longitude_360")).otherwise(F.col("longitude"))
    )
    return region_box(geo_guard(rows)).select(*ORDINAL, "latitude", "longitude", "t2m")


@query("recent_window")
def recent_window_query(spark, sf_dir):
    return recent_window(inputs.raw(spark, sf_dir, UPPER), AS_OF)


def _register_staging_variants():
    for shape in spec.SHAPES:
        model = "ifs" if shape == SPREAD else "gfs"

        def windowed(spark, sf_dir, shape=shape, model=model):
            return _staged(spark, sf_dir, shape, model, since=(AS_OF, 1), cycle_from_time=True, wide_coordinates=True)

        def boxed(spark, sf_dir, shape=shape, model=model):
            return _staged(spark, sf_dir, shape, model, region=True)

        query(f"stg_{shape}_windowed")(windowed)
        query(f"stg_{shape}_region")(boxed)


_register_staging_variants()


# ---------------------------------------------------------------- fact loads

# The target as an earlier run left it: everything up to this day.
LOADED_UNTIL = "2026-03-24"


def _loaded(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("cycle_date") <= F.lit(LOADED_UNTIL).cast("date"))


def _each(shape: str, load: Callable[[str], DataFrame]) -> DataFrame:
    """What a load makes of each model's rows: every model has a table of its own."""
    models = spec.MODELS if shape != SPREAD else ("aifs", "ifs")
    return reduce(DataFrame.unionByName, [load(m) for m in models])


@query("fact_append_hwm")
def fact_append_hwm(spark, sf_dir):
    """Append to a written table by its high-water mark; the result is the table."""

    def load(model):
        path = work_path(spark, f"fact_append_hwm_{model}")
        writers.append_partitions(_loaded(_fact(spark, sf_dir, UPPER, model, EARLIER_STAMP)), path, spec.FACT_PARTITIONS)
        target = footers.partition_rows(spark, path, spec.FACT_PARTITIONS)
        new = facts.rows_above_mark(_fact(spark, sf_dir, UPPER, model), target, AS_OF, days=7)
        writers.append_partitions(new, path, spec.FACT_PARTITIONS)
        return spark.read.parquet(path).select(*spec.fact_columns(UPPER))

    return _each(UPPER, load)


@query("fact_append_hwm_strict")
def fact_append_hwm_strict(spark, sf_dir):
    """Rows taken for a target with cycles in the window, and none for one without."""

    def load(model):
        fact = _fact(spark, sf_dir, SPREAD, model)
        stale = fact.where(F.col("cycle_date") < F.lit("2026-03-22").cast("date"))
        taken = facts.rows_above_mark(fact, _loaded(fact), AS_OF, days=4, null_mark="block")
        blocked = facts.rows_above_mark(fact, stale, AS_OF, days=4, null_mark="block")
        return taken.withColumn("target", F.lit("current")).unionByName(blocked.withColumn("target", F.lit("stale")))

    return _each(SPREAD, load)


@query("fact_latest_window")
def fact_latest_window(spark, sf_dir):
    return _each(UPPER, lambda model: facts.latest_window(_fact(spark, sf_dir, UPPER, model), AS_OF))


@query("fact_merge")
def fact_merge(spark, sf_dir):
    """First load keeps the first row per key; the merge of the last days the last row."""
    keys, columns = spec.fact_key(UPPER), spec.fact_columns(UPPER)

    def load(model):
        path = work_path(spark, f"fact_merge_{model}")
        rows = _fact(spark, sf_dir, UPPER, model, EARLIER_STAMP, keep=ORDINAL)
        writers.merge_on_key(rows, path, keys, order=FIRST, columns=columns)
        late = facts.window_rows(_fact(spark, sf_dir, UPPER, model, STAMP, keep=ORDINAL), AS_OF, 1)
        late = late.where("forecast_step_hours > 192")
        last = [F.col(c).desc() for c in ORDINAL]
        writers.merge_on_key(late, path, keys, order=last, columns=columns)
        return spark.read.parquet(path).select(*columns)

    return _each(UPPER, load)


@query("merge_backfill")
def merge_backfill(spark, sf_dir):
    """A merge that touches over a thousand dates, and rows without a date. Its two batches hold all orders."""
    path = work_path(spark, "merge_backfill")
    start = F.lit("1992-01-01").cast("date")
    day = F.when(F.col("o_orderkey") % 97 != 0, F.date_add(start, F.date_diff("o_orderdate", start) % 1100))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(day.alias("day"), "o_orderkey", "o_totalprice", "o_orderstatus")
    writers.merge_on_key(orders.where("o_orderkey % 3 <> 0"), path, ["day", "o_orderkey"], ["day"])
    later = orders.where("o_orderkey % 2 = 0 or o_orderkey % 3 = 0").withColumns({"o_totalprice": F.col("o_totalprice") + 1, "o_orderstatus": F.lit("B")})
    writers.merge_on_key(later, path, ["day", "o_orderkey"], ["day"], order=["o_orderstatus"])
    return spark.read.parquet(path).select(*orders.columns)


@query("merge_hot_key")
def merge_hot_key(spark, sf_dir):
    """Line items keyed by ship month and part, where a third of all rows are delivered under one key of one month.

    The dearest row of a key wins; the later delivery, the returned items, replaces what it holds."""
    path = work_path(spark, "merge_hot_key")
    usual = F.col("l_suppkey") % 3 > 0
    hot = inputs.table(spark, sf_dir, "lineitem").select(
        F.when(usual, F.trunc("l_shipdate", "month")).otherwise(F.lit("1995-01-01").cast("date")).alias("month"),
        F.when(usual, F.col("l_partkey")).otherwise(F.lit(-1)).alias("part"),
        "l_extendedprice", "l_orderkey", "l_linenumber", "l_returnflag",
    )
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"]
    writers.merge_on_key(hot.where("l_returnflag <> 'R'"), path, ["month", "part"], ["month"], order)
    writers.merge_on_key(hot.where("l_returnflag = 'R'"), path, ["month", "part"], ["month"], order)
    return spark.read.parquet(path).select(*hot.columns)


@query("fact_append_window")
def fact_append_window(spark, sf_dir):
    """First load of three days, then an append of one: the overlap is there twice."""

    def load(model):
        path = work_path(spark, f"fact_append_window_{model}")
        fact = _fact(spark, sf_dir, SURFACE, model)
        for days in (3, 1):
            writers.append_partitions(facts.window_rows(fact, AS_OF, days), path, spec.FACT_PARTITIONS)
        return spark.read.parquet(path).select(*spec.fact_columns(SURFACE))

    return _each(SURFACE, load)


@query("delete_insert")
def delete_insert(spark, sf_dir):
    """Locations of all days, then those of the last day again with shifted coordinates."""

    def load(model):
        path = work_path(spark, f"delete_insert_{model}")
        staged = _staged(spark, sf_dir, SURFACE, model)
        writers.delete_insert(dims.grid_points(staged), path, spec.GRID_KEY)
        latest = dims.grid_points(facts.window_rows(staged, AS_OF, 0)).withColumn("lat", (F.col("lat") + 100).cast("float"))
        writers.delete_insert(latest, path, spec.GRID_KEY)
        return spark.read.parquet(path).withColumn("weather_model", F.lit(model))

    return _each(SURFACE, load)


@query("full_refresh")
def full_refresh(spark, sf_dir):
    """Rebuild a table from a query that reads the table itself."""

    def load(model):
        path = work_path(spark, f"full_refresh_{model}")
        writers.overwrite_table(_fact(spark, sf_dir, SPREAD, model), path, spec.FACT_PARTITIONS)
        again = spark.read.parquet(path).where("pressure_level_hpa = 500")
        writers.overwrite_table(again, path, spec.FACT_PARTITIONS)
        return spark.read.parquet(path).select(*spec.fact_columns(SPREAD))

    return _each(SPREAD, load)


@query("fact_surface_project")
def fact_surface_project(spark, sf_dir):
    return _fact(spark, sf_dir, SURFACE, "gfs")


def _register_facts():
    for p in spec.PRODUCTS:
        if (p.model, p.shape) == ("gfs", SURFACE):
            continue

        def run(spark, sf_dir, p=p):
            return _fact(spark, sf_dir, p.shape, p.model)

        query(f"fact_{p.shape}_{p.model}")(run)


_register_facts()


# ------------------------------------------------- dimensions, joins, set operations


@query("dim_grid")
def dim_grid(spark, sf_dir):
    return dims.grid_dimension(_staged(spark, sf_dir, UPPER, "gfs"), dims.stations(spark))


@query("dim_grid_plain")
def dim_grid_plain(spark, sf_dir):
    return dims.grid_points(_staged(spark, sf_dir, UPPER, "gfs"))


@query("dim_locations")
def dim_locations(spark, sf_dir):
    staged = [_staged(spark, sf_dir, SURFACE, m) for m in ("gfs", "ifs", "aifs")]
    return dims.location_dimension(staged, AS_OF)


def _anchor(spark, sf_dir):
    """The newest cycle date of the raw table, as the run's day."""
    return inputs.base(spark, sf_dir).agg(F.max("frt_date").alias("as_of")).withColumn(
        "dbt_updated_at", facts.stamp_column(STAMP)
    )


@query("dim_locations_again")
def dim_locations_again(spark, sf_dir):
    """The location table built once; a second load has nothing to add to it."""
    path = work_path(spark, "dim_locations_again")
    staged = [_staged(spark, sf_dir, SURFACE, m) for m in ("gfs", "ifs", "aifs")]
    writers.append_partitions(dims.location_dimension(staged, AS_OF), path, ())
    writers.append_partitions(dims.location_dimension([], AS_OF, existing=spark.read.parquet(path)), path, ())
    return spark.read.parquet(path)


@query("dim_times")
def dim_times(spark, sf_dir):
    return dims.time_dimension(_anchor(spark, sf_dir), days=4)


@query("unified_upper")
def unified_upper(spark, sf_dir):
    return _unified(spark, sf_dir, UPPER)


@query("unified_surface")
def unified_surface(spark, sf_dir):
    return _unified(spark, sf_dir, SURFACE)


@query("unified_spread")
def unified_spread(spark, sf_dir):
    return _unified(spark, sf_dir, SPREAD)


def _city(spark, sf_dir, shape, forecast=None, city_in_key=False):
    stations = dims.stations(spark)
    points = dims.city_points(_staged(spark, sf_dir, UPPER, "gfs"), stations)
    forecast = _unified(spark, sf_dir, shape) if forecast is None else forecast
    return unified.city_forecast(forecast, points, shape, city_in_key)


@query("city_upper")
def city_upper(spark, sf_dir):
    return _city(spark, sf_dir, UPPER)


@query("city_surface")
def city_surface(spark, sf_dir):
    return _city(spark, sf_dir, SURFACE)


@query("city_spread")
def city_spread(spark, sf_dir):
    return _city(spark, sf_dir, SPREAD)


@query("hash_key")
def hash_key_query(spark, sf_dir):
    df = _unified(spark, sf_dir, UPPER)
    return df.select(hash_key(spec.hash_key_columns(UPPER)).alias("unique_key"), *spec.hash_key_columns(UPPER))


def _city_incremental(spark, sf_dir, shape):
    """The earlier load holds old days; rows stamped since then are deleted and inserted."""
    path = work_path(spark, f"city_incremental_{shape}")
    forecast = unified.unify(
        {
            p.model: ingest.dedup_first(_fact(spark, sf_dir, shape, p.model, keep=ORDINAL), spec.fact_key(shape), FIRST).select(
                *spec.fact_columns(shape)
            )
            for p in spec.PRODUCTS
            if p.shape == shape
        },
        shape,
    )
    stamped = forecast.withColumn(
        "dbt_updated_at",
        F.when(F.col("cycle_date") < F.lit("2026-03-24").cast("date"), facts.stamp_column("2026-03-23 12:00:00"))
        .when(F.col("cycle_date") < F.lit("2026-03-25").cast("date"), facts.stamp_column(EARLIER_STAMP))
        .otherwise(facts.stamp_column(STAMP)),
    )
    kelvin = next(c for c in spec.FACT_METRICS[shape] if c.endswith("kelvin"))
    held = stamped.where(F.col("cycle_date") <= F.lit(LOADED_UNTIL).cast("date")).withColumn(
        kelvin, (F.col(kelvin) + 100).cast("float")
    )
    writers.delete_insert(_city(spark, sf_dir, shape, held, city_in_key=True), path, ["unique_key"], spec.FACT_PARTITIONS)
    changed = unified.changed_since(stamped, spark.read.parquet(path))
    rows = _city(spark, sf_dir, shape, changed, city_in_key=True)
    writers.delete_insert(rows, path, ["unique_key"], spec.FACT_PARTITIONS)
    return spark.read.parquet(path)


@query("city_incremental")
def city_incremental(spark, sf_dir):
    return _city_incremental(spark, sf_dir, UPPER)


@query("city_incremental_surface")
def city_incremental_surface(spark, sf_dir):
    return _city_incremental(spark, sf_dir, SURFACE)


@query("city_incremental_spread")
def city_incremental_spread(spark, sf_dir):
    return _city_incremental(spark, sf_dir, SPREAD)


# -------------------------------------------------------------------- quality


@query("profile_columns")
def profile_columns(spark, sf_dir):
    rows = inputs.raw(spark, sf_dir, UPPER).drop("model")
    nan = F.when(F.col("t") == 260, F.lit("NaN").cast("float")).otherwise(F.col("t"))
    return quality.profile_columns(rows.withColumn("t", nan))


@query("profile_rollup")
def profile_rollup(spark, sf_dir):
    return quality.profile_rollup(inputs.raw(spark, sf_dir, SURFACE).drop("model"))


@query("profile_incremental")
def profile_incremental(spark, sf_dir):
    """The roll-up from a profile kept per partition; the second delivery adds to one day and brings later ones."""
    path, profile = (work_path(spark, f"profile_incremental_{n}") for n in ("raw", "profile"))
    rows = inputs.raw(spark, sf_dir, SURFACE).drop("model")
    early = (F.col("forecast_date") < "2026-03-24") | ((F.col("forecast_date") == "2026-03-24") & (F.col("step_hours") < 300))
    for delivery, stale in ((early, None), (~early, F.col("forecast_date") >= "2026-03-24")):
        writers.append_partitions(rows.where(delivery), path)
        kept = profiles.refresh(tables.read_raw(spark, path, SURFACE), profile, stale=stale)
    return profiles.rollup(kept)


@query("coord_rule")
def coord_rule(spark, sf_dir):
    return quality.coordinate_rules(quality.profile_rollup(inputs.raw(spark, sf_dir, UPPER).drop("model")))


@query("duplicate_keys")
def duplicate_keys(spark, sf_dir):
    rows = inputs.raw(spark, sf_dir, UPPER).drop("model")
    return quality.duplicate_keys(rows, spec.raw_key(rows.columns))


@query("audit_row")
def audit_row(spark, sf_dir):
    """One audit row per model, appended to a log; read back with its JSON details parsed."""
    path = work_path(spark, "audit_row")
    for model in spec.MODELS:
        rows = inputs.raw(spark, sf_dir, UPPER, model)
        audit = quality.audit_row(
            rows,
            dag_id=f"extract.{model}.upper",
            run_id="manual",
            logical_date=STAMP,
            model_name=model,
            layer_type=UPPER,
            keys=spec.raw_key([*rows.columns, "level"]),
        )
        audit.write.mode("append").parquet(path)
    check = "null_count bigint, nan_count bigint, null_percentage double, min_value double, max_value double"
    details = F.from_json(
        "validation_details",
        f"validation_error string, checks map<string, struct<{check.replace(' b', ':b').replace(' d', ':d')}>>, "
        "duplicate_check struct<passed: boolean, duplicate_count: bigint, pk_columns: array<string>>",
    )
    log = spark.read.parquet(path).withColumn("details", details)
    return log.drop("validation_details", "details").join(
        log.select(
            "model_name",
            "details.validation_error",
            F.col("details.duplicate_check.passed").alias("keys_unique"),
            F.array_join("details.duplicate_check.pk_columns", ",").alias("key_columns"),
            F.explode("details.checks").alias("column_name", "check"),
        ).select("*", "check.*").drop("check"),
        "model_name",
    )


@query("verify_gold")
def verify_gold(spark, sf_dir):
    return quality.verify_gold({f"fct_{s}_forecast": _unified(spark, sf_dir, s) for s in spec.SHAPES})


@query("test_not_null")
def not_null(spark, sf_dir):
    checks = []
    for shape in spec.SHAPES:
        df = _unified(spark, sf_dir, shape)
        checks.append(quality.check_not_null(df, df.columns))
    return reduce(DataFrame.unionByName, checks)


@query("test_unique")
def unique(spark, sf_dir):
    checks = []
    for shape in spec.SHAPES:
        df = _unified(spark, sf_dir, shape)
        checks.append(quality.check_unique(df, ["weather_model", *spec.fact_key(shape)], f"unique_{shape}"))
    return reduce(DataFrame.unionByName, checks)


@query("test_accepted_values")
def accepted_values(spark, sf_dir):
    accepted = {
        "weather_model": ("gfs", "aifs"),
        "cycle_hour": spec.HALF_DAY,
        "forecast_step_hours": spec.STEPS,
        "pressure_level_hpa": (500, 850),
    }
    checks = []
    for shape in spec.SHAPES:
        df = _unified(spark, sf_dir, shape)
        own = {c: v for c, v in accepted.items() if c in df.columns}
        checks.append(quality.check_accepted_values(df, own).withColumn("shape", F.lit(shape)))
    return reduce(DataFrame.unionByName, checks)


@query("test_expression")
def expression(spark, sf_dir):
    checked = [quality.check_expression(_unified(spark, sf_dir, s)).withColumn("shape", F.lit(s)) for s in spec.SHAPES]
    return reduce(DataFrame.unionByName, checked)


@query("read_back")
def read_back(spark, sf_dir):
    path = work_path(spark, "read_back")
    rows = inputs.raw(spark, sf_dir, UPPER).drop("model")
    writers.append_partitions(rows, path)
    return quality.read_back(rows, footers.read_pushed(spark, path, spec.raw_schema(UPPER)), spec.RAW_PARTITIONS)


# -------------------------------------------------- calendar, retention, events


def _partitions(spark, sf_dir):
    """Partitions of all raw tables and their facts, found in one pass over the rows."""
    usual, half_day = F.col("usual_cycle"), 12 * (F.col("cycle_no") % 2)
    tables = [
        F.when(
            F.col("model_no") == inputs.MODEL_NO[p.model],
            F.struct(
                F.lit(p.source).alias("source"),
                F.lit(p.table).alias("table_name"),
                F.lit(p.fact).alias("fact_name"),
                (half_day if p.shape == SPREAD else usual).cast("int").alias("forecast_cycle"),
            ),
        )
        for p in spec.PRODUCTS
    ]
    return (
        inputs.base(spark, sf_dir)
        .select("model_no", "frt_date", "cycle_no")
        .distinct()
        .withColumn("usual_cycle", F.when(F.col("model_no") == 2, half_day).otherwise(6 * F.col("cycle_no")))
        .select("frt_date", F.inline(F.array_compact(F.array(*tables))))
        .distinct()
    )


def _partition_paths(spark, sf_dir):
    """Paths of the raw tables' partitions, as an object listing would show them."""
    return _partitions(spark, sf_dir).select(
        F.concat_ws(
            "/",
            F.lit("bucket"),
            "source",
            "table_name",
            F.concat(F.lit("forecast_date="), F.date_format("frt_date", "yyyy-MM-dd")),
            F.concat(F.lit("forecast_cycle="), F.col("forecast_cycle").cast("string")),
            F.lit("part-0.parquet"),
        ).alias("path")
    )


@query("partition_readiness")
def partition_readiness(spark, sf_dir):
    # 03:00 UTC is still the evening before in New York, so the 25th is checked. The
    # surface tables of that day have lost their midnight cycle.
    lost = F.contains(F.col("path"), F.lit("surface/forecast_date=2026-03-25/forecast_cycle=0/"))
    found = calendar.parse_listing(_partition_paths(spark, sf_dir).where(~lost))
    instant = F.lit("2026-03-27 03:00:00").cast("timestamp")
    return calendar.missing_partitions(found, instant, calendar.product_table(spark))


def _partition_names(spark, sf_dir):
    name = calendar.partition_name("fact_name", "forecast_cycle", "frt_date")
    return _partitions(spark, sf_dir).select(name.alias("partition_name"))


@query("partition_calendar")
def partition_calendar(spark, sf_dir):
    wanted = calendar.partition_calendar(calendar.product_table(spark), F.lit(AS_OF).cast("date"))
    return calendar.partitions_to_create(wanted, _partition_names(spark, sf_dir))


@query("retention_raw")
def retention_raw(spark, sf_dir):
    path = _written_raw(spark, sf_dir, SURFACE, "retention_raw")
    writers.expire_partitions(spark, path, as_of="2026-03-30", keep_days=7)
    return tables.read_raw(spark, path, SURFACE)


@query("retention_gold")
def retention_gold(spark, sf_dir):
    return calendar.expired_partitions(_partition_names(spark, sf_dir), as_of="2026-05-08", keep_days=45)


@query("repartition_fact")
def repartition_fact(spark, sf_dir):
    keys = ["weather_model", "cycle_hour", "cycle_date"]

    def load(model):
        source, target = (work_path(spark, f"repartition_{n}_{model}") for n in ("source", "target"))
        _fact(spark, sf_dir, UPPER, model).write.parquet(source)
        for _ in range(2):  # the second call finds the work done
            writers.repartition_fact(spark, source, target)
        before = spark.read.parquet(source).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_before"))
        after = spark.read.parquet(target).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_after"))
        return before.join(after, keys, "full")

    return _each(UPPER, load)


@query("recent_snapshot")
def recent_snapshot(spark, sf_dir):
    path = work_path(spark, "recent_snapshot")
    raw = inputs.raw(spark, sf_dir, SPREAD).drop("model")
    writers.overwrite_table(calendar.recent_snapshot(raw, as_of="2026-03-30"), path)
    return spark.read.parquet(path)


@query("event_routing")
def event_routing(spark, sf_dir):
    return events.models_to_refresh(
        inputs.asset_events(spark, sf_dir), inputs.runs(spark, sf_dir), run_start="2024-01-31 00:00:00"
    )


@query("event_coalesce")
def event_coalesce(spark, sf_dir):
    return events.coalesce_events(inputs.asset_events(spark, sf_dir))


@query("event_coalesce_first")
def event_coalesce_first(spark, sf_dir):
    return events.coalesce_from_first(inputs.asset_events(spark, sf_dir))


def _deliveries(spark, sf_dir, model):
    """Two deliveries of raw files; the second one brings other temperatures."""
    rows = inputs.raw(spark, sf_dir, UPPER, model, ordinal=True)
    return rows.where("step_hours < 360"), rows.where("step_hours > 240").withColumn("t", (F.col("t") + 1).cast("float"))


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    """Two deliveries of raw files, each followed by a run of the stream."""

    def load(model):
        raw_path, fact_path, checkpoint = (work_path(spark, f"stream_{n}_{model}") for n in ("raw", "fact", "checkpoint"))
        for number, delivery in enumerate(_deliveries(spark, sf_dir, model)):
            extra = ", ".join(f"{n} {t}" for n, t in delivery.select(*ORDINAL).dtypes)
            writers.append_partitions(delivery, raw_path)
            stamp = (EARLIER_STAMP, STAMP)[number]
            stream = load_fact_stream(
                stream_raw(spark, raw_path, UPPER, extra=extra),
                model,
                UPPER,
                fact_path,
                checkpoint,
                stamp=lambda _, s=stamp: s,
                order=FIRST,
                keep=ORDINAL,
            )
            stream.awaitTermination()
        return spark.read.parquet(fact_path).select(*spec.fact_columns(UPPER))

    return _each(UPPER, load)


@query("stream_ingest_cuts")
def stream_ingest_cuts(spark, sf_dir):
    """The same deliveries by arrival: a run after each, and one run over all files in several micro-batches.

    Both read the same raw table. Streams that don't wait for each other run at once.
    """
    stored = ("delivery", *ORDINAL)
    arrival = [F.desc("delivery"), *FIRST]
    stamp = F.when(F.col("delivery") == 0, F.lit(EARLIER_STAMP)).otherwise(F.lit(STAMP)).cast("timestamp")
    cuts = ("deliveries", "files")
    raw_paths = {model: work_path(spark, f"cuts_raw_{model}") for model in spec.MODELS}
    places = {(m, c): tuple(work_path(spark, f"cuts_{c}_{n}_{m}") for n in ("fact", "checkpoint")) for m in spec.MODELS for c in cuts}

    def deliver(model, number):
        delivery = _deliveries(spark, sf_dir, model)[number].withColumn("delivery", F.lit(number))
        writers.append_partitions(delivery, raw_paths[model])
        return ", ".join(f"{n} {t}" for n, t in delivery.select(*stored).dtypes)

    def start(model, cut, extra):
        stream = stream_raw(spark, raw_paths[model], UPPER, files_per_trigger=20 if cut == "files" else None, extra=extra)
        return load_arrivals_stream(stream, model, UPPER, *places[model, cut], arrival, stored, stamp)

    for number in range(2):
        extra = {model: deliver(model, number) for model in spec.MODELS}
        running = [start(m, c, extra[m]) for m, c in places if c == "deliveries" or number == 1]
        try:
            for stream in running:
                stream.awaitTermination()
        finally:
            for stream in running:  # if one failed
                stream.stop()

    def loaded(model, cut):
        return spark.read.parquet(places[model, cut][0]).select(*spec.fact_columns(UPPER)).withColumn("cut", F.lit(cut))

    return _each(UPPER, lambda model: loaded(model, cuts[0]).unionByName(loaded(model, cuts[1])))


# ------------------------------------------------------------ reference data


@query("station_grid")
def station_grid(spark, sf_dir):
    return dims.station_grid(inputs.customer_cities(spark, sf_dir))
