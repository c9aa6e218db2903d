"""The three flows of the engine: a cycle into raw tables, raw tables into facts, and the
daily run over everything. They only call operators in order."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.operators import calendar, dims, ingest, profiles, quality, writers
from gridcast.operators.events import models_to_refresh
from gridcast.operators.facts import latest_window, rows_above_mark, stamp_column, to_fact, window_rows
from gridcast.operators.staging import stage
from gridcast.operators.unified import changed_since, city_forecast, unify
from gridcast.sources.footers import partition_rows
from gridcast.sources.tables import read_raw

LOAD_RULES = ("append", "append_strict", "latest", "merge", "window", "refresh")

# Days before the run's day that a load changes in a table that is there; the other rules rebuild it.
LOAD_DAYS = {"append": 7, "append_strict": 4, "merge": 1, "window": 1}


def ingest_cycle(
    messages: DataFrame,
    product: spec.Product,
    path: str,
    variables: Sequence[str],
    run: dict[str, str],
    audit_path: str | None = None,
    order: Sequence[str] = (),
    spread_over: int | None = None,
) -> DataFrame:
    """Decoded messages of one product into its raw table; returns the audit row.

    ``messages`` has lat, lon, one array per variable, forecast_reference_time, a step
    interval and, off the surface, isobaricInhPa. ``spread_over`` deals few, large messages
    to that many tasks before they are flattened.

    Of repeated points the first in the order of input stays. ``order`` names the columns of ``messages``
    that tell the order of the messages, which are not stored; within a message points follow its axes. Messages that tie go by their values.
    """
    spark = messages.sparkSession
    about = {"model_name": product.model, "layer_type": product.shape, **run}
    try:
        keys = _store_cycle(messages, product, path, variables, order, spread_over)
    except Exception as e:
        if audit_path:
            failed = quality.audit_row(None, spark=spark, status="FAILED", error=f"{type(e).__name__}: {e}"[:1000], **about)
            failed.write.mode("append").parquet(audit_path)
        raise
    # The messages tell which partitions were written without making the rows again.
    stamped = ingest.derive_times(messages.select("forecast_reference_time"), step=None)
    loaded = writers.touched_partitions(read_raw(spark, path, product.shape), stamped, spec.RAW_PARTITIONS)
    audit = quality.audit_row(loaded, keys=keys, **about)
    if audit_path:
        audit.write.mode("append").parquet(audit_path)
    return audit


def _store_cycle(messages, product, path, variables, order, spread_over) -> list[str]:
    """Writes the partitions of a cycle; returns the key of its rows."""
    if spread_over:
        messages = messages.repartition(spread_over)
    ranked = messages.withColumn("_order", F.struct(*order)) if order else messages
    points = ingest.flatten_grid(ranked, variables, spec.CROP_SOUTH, spec.CROP_NORTH, ordinal=True)
    points = ingest.geopotential_to_height(ingest.canonical_names(points))
    if product.model == "gfs":
        ingest.require_variables(points, product.shape)
    about = [c for c in ("_order", "lat_n", "lon_n") if c in points.columns]
    metrics = [c for c, t in points.dtypes if c not in (*spec.NOT_METRICS, *order) and t in ("float", "double")]
    points = ingest.drop_missing_target(ingest.normalize_longitude(points))
    if points.isEmpty():  # stops at the first row
        raise ingest.EmptyBatch(f"no row of {product.table} lies in the kept band and has its variable")
    rows = ingest.derive_times(ingest.add_index(points, metrics))
    keys = spec.raw_key(rows.columns)
    values = [F.col(c).asc_nulls_last() for c in ("latitude", "longitude", *metrics)]
    unique = ingest.dedup_first(rows, keys, [*about, *values]).drop(*about, *order)
    batch = ingest.evolve_to(unique, spec.raw_schema(product.shape))
    writers.keep_schema(messages.sparkSession, path, batch.schema)
    writers.replace_partitions(batch, path)
    return keys


def load_fact(
    spark: SparkSession,
    product: spec.Product,
    raw_path: str,
    fact_path: str,
    rule: str,
    as_of: str,
    stamp: str,
    days: int | None = None,
    **staging,
) -> None:
    """Load one fact table from one raw table by one of the load rules.

    append: cycles above the high-water mark, 7 days (append_strict: 4 days, an empty
    window takes nothing). latest: rebuild from the last day. merge: merge on the key.
    window: append a window, 3 days at first and 1 later. refresh: rebuild from everything.
    """
    if rule not in LOAD_RULES:
        raise ValueError(f"load rule is one of {LOAD_RULES}, not {rule!r}")
    exists = writers.table_exists(spark, fact_path)
    default_days = LOAD_DAYS | {"latest": 1, "window": LOAD_DAYS["window"] if exists else 3}
    days = default_days.get(rule) if days is None else days
    first_append = rule.startswith("append") and not exists
    since = None
    if rule != "refresh" and not first_append:
        since = (date.fromisoformat(as_of) - timedelta(days=days)).isoformat()
    raw = read_raw(spark, raw_path, product.shape, since)
    fact = to_fact(stage(raw, product.shape, **staging), product.model, product.shape, stamp)
    if rule == "refresh":
        writers.overwrite_table(fact, fact_path, spec.FACT_PARTITIONS)
    elif rule == "latest":
        writers.overwrite_table(latest_window(fact, as_of, days), fact_path, spec.FACT_PARTITIONS)
    elif rule == "merge":
        metrics = [F.col(c).asc_nulls_last() for c in spec.FACT_METRICS[product.shape]]
        writers.merge_on_key(window_rows(fact, as_of, days), fact_path, spec.fact_key(product.shape), order=metrics)
    elif rule == "window":
        writers.append_partitions(window_rows(fact, as_of, days), fact_path, spec.FACT_PARTITIONS)
    else:
        if not first_append:
            target = partition_rows(spark, fact_path, spec.FACT_PARTITIONS)
            mark = "block" if rule == "append_strict" else "epoch"
            fact = rows_above_mark(fact, target, as_of, days, mark)
        writers.append_partitions(fact, fact_path, spec.FACT_PARTITIONS)


def unified_view(spark: SparkSession, fact_paths: dict[str, str], shape: str) -> DataFrame:
    """The unified view of one shape over fact tables given as {model: path}."""
    return unify({m: spark.read.parquet(p) for m, p in fact_paths.items()}, shape)


def store_dimensions(spark: SparkSession, root: str, as_of: str, stamp: str) -> dict[str, int]:
    """Grid points, locations and valid times as tables below gold/; returns the rows added to each.

    The grid dimension and the locations don't change: where their table is there, nothing is read again. Times are
    built for four days and then refreshed by two, each valid time once.
    """
    added = {}
    surfaces = [p for p in spec.PRODUCTS if p.shape == spec.SURFACE and p.published]
    staged = lambda p: stage(read_raw(spark, f"{root}/raw/{p.table}", p.shape), p.shape)
    grid, places, times = (f"{root}/gold/{n}" for n in ("dim_grid_points", "dim_locations", "dim_times"))
    known = {path: writers.table_exists(spark, path) for path in (grid, places, times)}
    if not known[grid]:
        writers.overwrite_table(dims.grid_dimension(staged(spec.product("gfs", spec.UPPER)), dims.stations(spark)), grid)
    existing = spark.read.parquet(places) if known[places] else None
    new = dims.location_dimension([] if known[places] else [staged(p) for p in surfaces], as_of, existing)
    if not known[places]:
        writers.append_partitions(new, places, ())
    anchor = spark.range(1).select(F.lit(as_of).cast("date").alias("as_of"), stamp_column(stamp).alias("dbt_updated_at"))
    fresh = dims.time_dimension(anchor, days=2 if known[times] else 4)
    writers.delete_insert(fresh, times, spec.TIME_KEY)
    for path in (grid, places):
        added[path.rsplit("/", 1)[1]] = 0 if known[path] else spark.read.parquet(path).count()
    return added | {"dim_times": fresh.count()}


def refresh_city_fact(
    forecast: DataFrame, points: DataFrame, stations: DataFrame, shape: str, path: str, since: str | None = None
) -> None:
    """Delete and insert the city rows of a forecast, on the key with the city in it.

    ``points`` is the stored grid dimension, or its city rows. Where the city fact is there, only rows stamped since its
    newest stamp are read and only their partitions are rewritten; ``since`` (a date) lets the scan prune older cycles.
    """
    spark = forecast.sparkSession
    if writers.table_exists(spark, path):
        forecast = changed_since(forecast, spark.read.parquet(path))
        forecast = forecast.where(F.col("cycle_date") >= F.lit(since).cast("date")) if since else forecast
    rows = city_forecast(forecast, points, shape, city_in_key=True, stations=stations)
    writers.delete_insert(rows, path, ["unique_key"], spec.FACT_PARTITIONS)


def refresh_updated(
    spark: SparkSession,
    events: DataFrame,
    runs: DataFrame,
    run_start: str,
    root: str,
    as_of: str,
    stamp: str,
    rule: str = "append",
    manual: bool = False,
) -> list[str]:
    """Load the facts of the models updated since the last successful run; returns their names."""
    # Never more than the eight models.
    updated = {r.model for r in models_to_refresh(events, runs, run_start, manual=manual).collect()}
    loaded = [p for p in spec.PRODUCTS if f"{p.model}_{p.shape}" in updated]
    for p in loaded:
        load_fact(spark, p, f"{root}/raw/{p.table}", f"{root}/gold/{p.fact}", rule, as_of, stamp)
    return [p.fact for p in loaded]


def daily_run(
    spark: SparkSession,
    root: str,
    instant: Column,
    as_of: str,
    stamp: str,
    rule: str = "merge",
    keep_days: int | None = None,
    recheck: bool = False,
) -> DataFrame:
    """Readiness, facts, dimensions, city facts, partition calendar, check of the unified views, audit, retention.

    ``root`` holds raw/<table> and receives gold/<fact>, gold/fct_<shape>_forecast_cities, the dimensions,
    gold/partition_calendar and audit/gold. Raw partitions older than ``keep_days`` go last. Returns the verification
    rows; if partitions of the previous day are missing, raises before anything is written.

    The check keeps a profile per cycle in audit/profile_<shape> and measures only the cycles that the load can have
    changed. ``recheck`` measures all, which a backfill past the load's own days needs.
    """
    tables = [p for p in spec.PRODUCTS if p.published]
    found = None
    for p in tables:
        listing = writers.partition_listing(spark, f"{root}/raw/{p.table}", spec.RAW_PARTITIONS)
        found = listing if found is None else found.unionAll(listing)
    products = calendar.product_table(spark)
    missing = calendar.missing_partitions(calendar.parse_listing(found), instant, products)
    # At most one row per product and cycle.
    absent = missing.collect()
    if absent:
        raise RuntimeError(f"{len(absent)} partitions are missing, first: {absent[0]}")
    whole = recheck or rule not in LOAD_DAYS or not all(writers.table_exists(spark, f"{root}/gold/{p.fact}") for p in tables)
    for p in tables:
        load_fact(spark, p, f"{root}/raw/{p.table}", f"{root}/gold/{p.fact}", rule, as_of, stamp)
    store_dimensions(spark, root, as_of, stamp)
    views = {
        shape: unified_view(spark, {p.model: f"{root}/gold/{p.fact}" for p in tables if p.shape == shape}, shape)
        for shape in spec.SHAPES
    }
    stations, grid = dims.stations(spark), spark.read.parquet(f"{root}/gold/dim_grid_points")
    for shape, view in views.items():
        refresh_city_fact(view, grid, stations, shape, f"{root}/gold/fct_{shape}_forecast_cities")
    planned = calendar.partition_calendar(products, F.lit(as_of).cast("date"))
    writers.overwrite_table(planned, f"{root}/gold/partition_calendar")
    loaded = None if whole else F.col("cycle_date") >= F.date_sub(F.lit(as_of).cast("date"), LOAD_DAYS[rule])
    measured = {
        shape: profiles.refresh(
            view, f"{root}/audit/profile_{shape}", ("weather_model", *spec.FACT_PARTITIONS), loaded, quality.measured_gold
        )
        for shape, view in views.items()
    }
    checked = quality.gold_verdicts({f"fct_{shape}_forecast": profiles.merged(m) for shape, m in measured.items()})
    audit = quality.gold_audit_row(
        checked, dag_id="daily_run", run_id=as_of, logical_date=as_of, model_name="all", layer_type="gold"
    )
    audit.write.mode("append").parquet(f"{root}/audit/gold")
    if keep_days is not None:
        for p in tables:
            writers.expire_partitions(spark, f"{root}/raw/{p.table}", as_of, keep_days)
    return checked
