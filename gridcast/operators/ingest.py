"""From decoded grids to raw rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridcast import spec
from gridcast.functions import (
    as_float,
    expand,
    grid_index_f32,
    is_missing,
    quarter_degree,
    wrap_longitude,
)


class MissingVariables(ValueError):
    """A batch lacks variables its shape requires."""


class SchemaMismatch(ValueError):
    """A batch's columns differ from its table's."""


# ------------------------------------------------------------- grid to rows


class EmptyBatch(ValueError):
    """Nothing of a delivery is left to store."""


def flatten_grid(
    messages: DataFrame,
    variables: Sequence[str],
    south: float | None = None,
    north: float | None = None,
    ordinal: bool = False,
) -> DataFrame:
    """One row per grid point of each message.

    ``ordinal`` adds the place of a point in its message, lat_n and lon_n (from 0). With a column that tells the order of
    the messages they are the order of input, which the values of a row don't give.

    A message row holds the axes ``lat`` and ``lon``, one row-major array per variable and
    scalar columns, which are repeated; other arrays are left out. A latitude band is cut
    before any point is made. A message is first cut into one row per latitude, each with
    its own slice of the values, then every slice into points: neither step copies the
    whole arrays along, and nothing is shuffled. A table with few, large messages is
    spread first with ``repartition``.
    """
    scalars = [f.name for f in messages.schema if not isinstance(f.dataType, T.ArrayType)]
    types = dict(messages.dtypes)
    low, high = F.lit(-90.0 if south is None else south), F.lit(90.0 if north is None else north)
    width = F.size("lon")

    # A variable a message lacks altogether is NULL at its points.
    present = messages.select(
        *scalars, "lat", "lon", *[F.coalesce(v, F.array().cast(types[v])).alias(v) for v in variables]
    )
    indexed = F.transform("lat", lambda lat, i: F.struct(lat.alias("latitude"), i.alias("i")))
    band = F.filter(indexed, lambda r: r["latitude"].between(low, high))
    by_latitude = F.transform(
        band,
        lambda r: F.struct(
            r["latitude"].alias("latitude"),
            *([r["i"].alias("lat_n")] if ordinal else []),
            *[F.slice(F.col(v), r["i"] * width + 1, width).alias(v) for v in variables],
        ),
    )
    along = F.arrays_zip(F.col("lon").alias("longitude"), *[F.col(v) for v in variables])
    rows = present.select(*scalars, "lon", F.inline(by_latitude))
    if not ordinal:
        return rows.select(*scalars, "latitude", F.inline(along))
    numbered = F.transform(along, lambda x, i: F.struct(i.alias("lon_n"), x["longitude"].alias("longitude"), *[x[v].alias(v) for v in variables]))
    return rows.select(*scalars, "latitude", "lat_n", F.inline(numbered))


def normalize_longitude(df: DataFrame, column: str = "longitude") -> DataFrame:
    return df.withColumn(column, wrap_longitude(column))


def crop_latitude(df: DataFrame, south: float = spec.CROP_SOUTH, north: float = spec.CROP_NORTH) -> DataFrame:
    return df.where(F.col("latitude").between(south, north))


def drop_missing_target(df: DataFrame, targets: Sequence[str] = spec.TARGETS) -> DataFrame:
    """Drop points without a value of the first target variable the batch has."""
    types = dict(df.dtypes)
    target = next((t for t in targets if t in types), None)
    return df.where(~is_missing(target, types[target])) if target else df


def add_index(df: DataFrame, metrics: Sequence[str] = ()) -> DataFrame:
    """Fixed-point lat_i / lon_i, and metrics narrowed to 32-bit floats."""
    return df.withColumns(
        {
            **{m: as_float(m) for m in metrics},
            "lat_i": grid_index_f32("latitude", 90),
            "lon_i": grid_index_f32("longitude", 180),
        }
    )


def derive_times(df: DataFrame, step: str | None = "step") -> DataFrame:
    """Valid time, whole step hours and the partition columns from reference time and step.

    ``step`` names a day-time interval column; without one the valid time is the reference
    time itself.
    """
    frt = F.col("forecast_reference_time")
    times = {"forecast_date": frt.cast("date").cast("string"), "forecast_cycle": F.hour(frt)}
    if step and step in df.columns:
        hours = F.extract(F.lit("DAY"), F.col(step)) * 24 + F.extract(F.lit("HOUR"), F.col(step))
        times |= {"valid_time": frt + F.col(step), "step_hours": hours.cast("int")}
        return df.withColumns(times).drop(step)
    return df.withColumns(times | {"valid_time": frt})


def dedup_first(df: DataFrame, keys: Iterable[str], order: Iterable[Column | str]) -> DataFrame:
    """The first row per key in the given order.

    The filter on row_number() lets Spark cut each key to one row per task before the
    shuffle, so a key that repeats a billion times still moves as one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def union_by_name(batches: Sequence[DataFrame]) -> DataFrame:
    """Concatenate batches; columns in first-seen order, NULL where a batch lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def canonical_names(df: DataFrame) -> DataFrame:
    """Rename model-specific variable names to the unified ones."""
    present = {old: new for old, new in spec.RENAMES.items() if old in df.columns and new not in df.columns}
    return df.withColumnsRenamed(present)


def require_variables(df: DataFrame, shape: str) -> DataFrame:
    """Fail before any data is read if a mandatory variable is absent."""
    missing = [v for v in spec.MANDATORY.get(shape, ()) if v not in df.columns]
    if missing:
        raise MissingVariables(f"{shape} batch lacks mandatory variables {missing}")
    return df


def geopotential_to_height(df: DataFrame, z: str = "z", gh: str = "gh") -> DataFrame:
    """Height from geopotential where given; a height that is already one stays as it is."""
    if z not in df.columns:
        return df
    height = (F.col(z) / F.lit(spec.STANDARD_GRAVITY)).cast("float")
    if gh in df.columns:
        height = F.when(F.col(gh).isNull(), height).otherwise(F.col(gh))
    return df.withColumn(gh, height).drop(z)


# ------------------------------------------------------- schema of the target


_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_REAL = (T.FloatType(), T.DoubleType())


def wider(a: T.DataType, b: T.DataType, name: str = "column") -> T.DataType:
    """The least type that holds the values of both: whole numbers grow to the longer, all other pairs of numbers to double."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {a, b} <= {*_WHOLE, *_REAL}:
        return T.DoubleType()
    raise SchemaMismatch(f"{name} is {a.simpleString()} in one place and {b.simpleString()} in another")


def evolve_to(df: DataFrame, table_schema: T.StructType) -> DataFrame:
    """Table columns first, in table order, NULL where the batch lacks one; then new columns.

    A column that both have gets the wider of its two types; types that have no wider one are an error.
    """
    own = {f.name: f.dataType for f in df.schema}
    known = [
        F.col(f.name).cast(wider(own[f.name], f.dataType, f.name)).alias(f.name)
        if f.name in own
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in table_schema
    ]
    extra = [c for c in df.columns if c not in set(table_schema.names)]
    return df.select(*known, *extra)


def align_strict(df: DataFrame, table_schema: T.StructType) -> DataFrame:
    """Cast to the table's types in the table's order; any column difference is an error."""
    have, want = set(df.columns), set(table_schema.names)
    if have != want:
        raise SchemaMismatch(f"missing {sorted(want - have)}, unexpected {sorted(have - want)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema])


# ------------------------------------------------------- products and cycles


def filter_published(df: DataFrame, shape: str, model: str = "model", cycle: str = "forecast_cycle", step: str = "step_hours") -> DataFrame:
    """Keep rows of runs the centre publishes: known cycles and steps of published products."""
    published = [p for p in spec.PRODUCTS if p.shape == shape and p.published]
    keep = reduce(
        lambda a, b: a | b,
        [(F.col(model) == p.model) & F.col(cycle).isin(*p.cycles) & F.col(step).isin(*p.steps) for p in published],
        F.lit(False),
    )
    return df.where(keep)


def resolve_cycle(triggers: DataFrame, own_cycles: bool = False) -> DataFrame:
    """Forecast cycle a trigger stands for, from (task, trigger_time).

    The publication delay is taken off and the hour rounded to a multiple of 6, half to
    even; 24 is hour 0 of the next day. ``own_cycles`` takes instead the product's last
    own cycle at or before the nominal time.
    """
    delays = F.create_map(*[F.lit(x) for p in spec.PRODUCTS for x in (p.task, int(p.delay_hours * 60))])
    minutes = F.coalesce(F.try_element_at(delays, F.col("task")), F.lit(int(4.67 * 60)))
    nominal = F.col("trigger_time") - F.make_dt_interval(mins=minutes)
    df = triggers.withColumn("nominal_time", nominal)
    hour = F.hour("nominal_time")
    if own_cycles:
        cycles = F.create_map(
            *[x for p in spec.PRODUCTS for x in (F.lit(p.task), F.array(*[F.lit(c) for c in p.cycles]))]
        )
        known = F.coalesce(F.try_element_at(cycles, F.col("task")), F.array(*[F.lit(c) for c in spec.SIX_HOURLY]))
        resolved = F.array_max(F.filter(known, lambda c: c <= hour))
    else:
        resolved = (F.rint(hour / 6) * 6).cast("int")
    return (
        df.withColumn("_resolved", resolved)
        .withColumns(
            {
                "cycle_date": F.date_add(F.to_date("nominal_time"), F.when(F.col("_resolved") == 24, 1).otherwise(0)),
                "cycle_hour": F.when(F.col("_resolved") == 24, 0).otherwise(F.col("_resolved")),
            }
        )
        .drop("_resolved")
    )


# ------------------------------------------------------------ field analysis

# Field means above which heights are geopotential, or metres.
GEOPOTENTIAL_MEAN = 40000
METRE_MEAN = 4000


def scale_z500(df: DataFrame, field: Sequence[str], value: str = "gh", level: str = "isobaricInhPa") -> DataFrame:
    """Heights at 500 hPa in decametres, the unit told from each field's mean.

    ``field`` names the columns that identify one field. The means are aggregated (partial
    sums per task) and joined back, so a field is never gathered in one place; AQE
    broadcasts the means when they are small and splits skewed fields when not. A field
    without any value yields nothing.
    """
    at_500 = df.where(F.col(level) == 500)
    known = ~is_missing(value, dict(df.dtypes)[value])
    means = at_500.where(known).groupBy(*field).agg(F.avg(F.col(value).cast("double")).alias("field_mean"))
    wide = F.col(value).cast("double")
    scaled = (
        F.when(F.col("field_mean") > GEOPOTENTIAL_MEAN, wide / spec.STANDARD_GRAVITY / 10.0)
        .when(F.col("field_mean") > METRE_MEAN, wide / 10.0)
        .otherwise(wide)
        .cast("float")
    )
    return at_500.join(means, list(field)).withColumn("z500_dam", scaled).drop("field_mean")


# Fixed-point indexes of a thousandth of a degree: the largest of each axis.
LAT_CELLS, LON_CELLS = 180_000, 360_000


def _axis_cells(grid: DataFrame, index: str, bin_width: int) -> DataFrame:
    """Axis values with the index interval each is nearest to, spread over coarse bins.

    The caller keeps to the globe, so an axis has at most LAT_CELLS + 1 or LON_CELLS + 1 values,
    which bounds the global sort and the table that comes out of it.
    """
    axis = grid.select(index).distinct()
    whole = Window.orderBy(index)
    before, after = F.lag(index).over(whole), F.lead(index).over(whole)
    # Interval bounds in half index units keep midpoints whole; a tie goes to the higher value.
    cells = axis.select(
        index,
        F.coalesce(before + F.col(index), F.lit(-(2**30))).alias("low"),
        F.coalesce(after + F.col(index), F.lit(2**30)).alias("high"),
    )
    first = F.greatest(F.floor(F.col("low") / (2 * bin_width)), F.lit(-1))
    last = F.least(F.floor(F.col("high") / (2 * bin_width)), F.lit(LON_CELLS // bin_width + 1))
    return cells.select(index, "low", "high", F.explode(F.sequence(first, last)).alias("bin"))


def sample_nearest(points: DataFrame, grid: DataFrame, value: str, bin_width: int = 1000) -> DataFrame:
    """Grid value nearest to each point, 0.0 where there is none.

    As on a rectangular array, the nearest axis value is taken per axis (beyond the edge:
    the edge; a tie: the higher one) and then the cell is looked up. Points' longitudes
    are first brought into the grid's [-180, 180). Finding the axis value is an equi-join
    on one-degree bins; the lookup an equi-join on the cell.
    """
    # What lies off the globe is no cell; of several rows for one cell the least value counts.
    grid = (
        grid.where(F.col("lat_i").between(0, LAT_CELLS) & F.col("lon_i").between(0, LON_CELLS))
        .groupBy("lat_i", "lon_i")
        .agg(F.min(F.col(value).cast("double")).alias("_value"))
    )
    lat_cells = _axis_cells(grid, "lat_i", bin_width)
    lon_cells = _axis_cells(grid, "lon_i", bin_width)

    def snap(df: DataFrame, cells: DataFrame, index: str, at: Column) -> DataFrame:
        # Twice the exact fixed-point position, to compare with the half-unit bounds.
        placed = df.withColumn("_at2", at * 2)
        bins = F.least(
            F.greatest(F.floor(F.col("_at2") / (2 * bin_width)), F.lit(-1)), F.lit(LON_CELLS // bin_width + 1)
        )
        placed = placed.withColumn("_bin", bins)
        match = (
            (placed["_bin"] == cells["bin"]) & (placed["_at2"] >= cells["low"]) & (placed["_at2"] < cells["high"])
        )
        return placed.join(cells, match, "left").drop("_at2", "_bin", "bin", "low", "high")

    lat_at = (F.col("latitude") + 90) * 1000
    lon_at = (wrap_longitude("longitude") + 180) * 1000
    snapped = snap(snap(points, lat_cells, "lat_i", lat_at), lon_cells, "lon_i", lon_at)
    known = grid.withColumnRenamed("_value", "sampled")
    return snapped.join(known, ["lat_i", "lon_i"], "left").withColumn(
        "sampled", F.coalesce(F.nanvl("sampled", F.lit(0.0)), F.lit(0.0))
    )


def last_slice(df: DataFrame, array: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """Reduce each array to two dimensions: keep the last index of every further axis.

    ``array`` identifies one array, ``axes`` its non-spatial axes. The axis ends are
    partial maxima joined back, not a sort of each point's rows.
    """
    ends = df.groupBy(*array).agg(*[F.max(a).alias(a) for a in axes])
    return df.join(ends, [*array, *axes], "left_semi")


# ------------------------------------------------------------------ stations


def station_grid(cities: DataFrame) -> DataFrame:
    """Each city's 3 x 3 quarter-degree neighbourhood, without points off its coast.

    ``cities`` has city columns, latitude, longitude and optional bounds east_limit and
    west_limit. Two explodes of a three-value list; no join.
    """
    offsets = (-0.25, 0.0, 0.25)
    about = [c for c in cities.columns if c not in ("latitude", "longitude", "east_limit", "west_limit")]
    limits = ["east_limit", "west_limit"]
    points = (
        cities.withColumn("_dlat", expand(offsets))
        .withColumn("_dlon", expand(offsets))
        .select(
            *about,
            *limits,
            (quarter_degree("latitude") + F.col("_dlat")).alias("lat"),
            (quarter_degree("longitude") + F.col("_dlon")).alias("lon"),
        )
    )
    on_land = (F.col("east_limit").isNull() | (F.col("lon") <= F.col("east_limit"))) & (
        F.col("west_limit").isNull() | (F.col("lon") >= F.col("west_limit"))
    )
    return points.where(on_land).select(
        *about,
        ((F.col("lat") + 90) * 1000).cast("int").alias("lat_i"),
        ((F.col("lon") + 180) * 1000).cast("int").alias("lon_i"),
        "lat",
        "lon",
    )
