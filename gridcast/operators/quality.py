"""Column profiles, rule checks and the load audit.

Checks on one table share one aggregation, so a table is scanned once however many rules
apply; only keys (uniqueness) need a shuffle, after partial counts per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.functions import is_missing

FLOATING = ("float", "double")


def metric_columns(df: DataFrame, ignore: Sequence[str] = spec.NOT_METRICS) -> list[str]:
    return [c for c in df.columns if c not in ignore]


def _count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _known(c: str, data_type: str) -> Column:
    return F.when(~is_missing(c, data_type), F.col(c)).cast("double")


# ---------------------------------------------------------------- load profile


def _column_measures(c: str, data_type: str) -> list[Column]:
    """NULLs, NaNs, minimum and maximum of a column; NaN is neither NULL nor a bound."""
    nan = _count_if(F.isnan(c)) if data_type in FLOATING else F.count_if(F.lit(False))
    return [
        _count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
        nan.alias(f"{c}__nans"),
        F.min(_known(c, data_type)).alias(f"{c}__min"),
        F.max(_known(c, data_type)).alias(f"{c}__max"),
    ]


def _measure(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: row count and the measures of every named column, in one scan."""
    types = dict(df.dtypes)
    measures = [m for c in columns for m in _column_measures(c, types[c])]
    return df.agg(F.count(F.lit(1)).alias("rows"), *measures)


def _profile_struct(c: str) -> Column:
    share = F.when(F.col("rows") > 0, F.col(f"{c}__nulls") / F.col("rows") * 100.0).otherwise(0.0)
    return F.struct(
        F.col(f"{c}__nulls").alias("null_count"),
        F.col(f"{c}__nans").alias("nan_count"),
        share.alias("null_percentage"),
        F.col(f"{c}__min").alias("min_value"),
        F.col(f"{c}__max").alias("max_value"),
    )


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per metric column: NULLs, NaNs, NULL share, minimum and maximum of the real values."""
    columns = list(columns or metric_columns(df))
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col("rows").alias("row_count"), _profile_struct(c).alias("p"))
        for c in columns
    ]
    return _measure(df, columns).select(F.inline(F.array(*rows))).select("column_name", "row_count", "p.*")


COORDINATES = ("latitude", "longitude")


def rollup_columns(metrics: Sequence[str]) -> list[Column]:
    """Roll-up over measured columns: totals over metrics, and the coordinates' own."""

    def over(suffix: str, combine) -> Column:
        parts = [F.col(f"{m}__{suffix}") for m in metrics]
        return combine(*parts) if len(parts) > 1 else parts[0]

    return [
        F.col("rows").alias("records_extracted"),
        *[F.col(f"{c}__nulls").alias(f"null_count_{c}") for c in (*COORDINATES, "valid_time")],
        reduce(lambda a, b: a + b, [F.col(f"{m}__nulls") for m in metrics]).alias("null_count_metric_values"),
        *[F.col(f"{c}__{n}").alias(f"{n}_{c}") for c in COORDINATES for n in ("min", "max")],
        over("min", F.least).alias("min_metric_value"),
        over("max", F.greatest).alias("max_metric_value"),
    ]


def measured_load(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Measures of coordinates and metrics, and the NULLs of the valid time: one row, or one per value of ``by``."""
    types = dict(df.dtypes)
    columns = [*COORDINATES, *[c for c in metric_columns(df) if c not in by]]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        _count_if(F.col("valid_time").isNull()).alias("valid_time__nulls"),
        *[m for c in columns for m in _column_measures(c, types[c])],
    )


def profile_rollup(df: DataFrame) -> DataFrame:
    """One row: NULLs over all metrics, bounds over all metrics, and the coordinates' own."""
    return measured_load(df).select(*rollup_columns(metric_columns(df)))


def coordinate_rules(rollup: DataFrame) -> DataFrame:
    """Observed against allowed bounds, one row per coordinate that has any value."""
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"min_{c}").alias("min_value"),
            F.col(f"max_{c}").alias("max_value"),
            F.lit(low).alias("rule_min"),
            F.lit(high).alias("rule_max"),
            ((F.col(f"min_{c}") >= low) & (F.col(f"max_{c}") <= high)).alias("passed"),
        )
        for c, (low, high) in spec.COORDINATE_RULES.items()
    ]
    checked = rollup.select(F.inline(F.array(*rows))).where(F.col("min_value").isNotNull())
    return checked.withColumn("status", F.when(F.col("passed"), "SUCCESS").otherwise("WARNING"))


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows beyond the first of each key; NULL parts count as values.

    Keys are counted per task before the shuffle, so a hot key costs one row per task.
    """
    active = [k for k in keys if k in df.columns]
    counts = df.groupBy(*active).count()
    total = F.coalesce(F.sum("count"), F.lit(0))
    return counts.agg(
        total.alias("row_count"), (total - F.count(F.lit(1))).alias("duplicate_records_count")
    ).withColumn("status", F.when(F.col("duplicate_records_count") > 0, "WARNING").otherwise("SUCCESS"))


def audit_row(
    df: DataFrame | None,
    *,
    dag_id: str,
    run_id: str,
    logical_date: str,
    model_name: str,
    layer_type: str,
    keys: Iterable[str] = (),
    status: str = "SUCCESS",
    error: str | None = None,
    seconds: float = 0.0,
    spark=None,
) -> DataFrame:
    """One audit row for a load, to be appended to the audit log.

    A rule or duplicate violation turns SUCCESS into WARNING; an error or an empty batch
    makes it FAILED. Details are JSON. ``df`` is None when a load produced nothing.
    """
    head = {
        "dag_id": F.lit(dag_id),
        "run_id": F.lit(run_id),
        "logical_date": F.lit(logical_date).cast("timestamp"),
        "model_name": F.lit(model_name),
        "layer_type": F.lit(layer_type),
    }
    tail = {"execution_time_seconds": F.lit(float(seconds))}
    if df is None:
        zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("double")
        details = F.to_json(F.create_map(F.lit("validation_error"), F.lit(error).cast("string")))
        stats = {
            "status": F.lit("FAILED" if error else status),
            **{c: zero for c in _AUDIT_COUNTS},
            **{c: none for c in _AUDIT_BOUNDS},
            "validation_details": details,
        }
        return spark.range(1).select(*[v.alias(k) for k, v in {**head, **stats, **tail}.items()])

    metrics = metric_columns(df)
    checks = F.create_map(*[x for c in metrics for x in (F.lit(c), _profile_struct(c))])
    rollup = measured_load(df).select(*rollup_columns(metrics), checks.alias("checks"), F.lit(1).alias("_one"))
    active = [k for k in keys if k in df.columns]
    if active:
        duplicates = duplicate_keys(df, active).select("duplicate_records_count", F.lit(1).alias("_one"))
    else:
        duplicates = df.sparkSession.range(1).select(
            F.lit(0).cast("bigint").alias("duplicate_records_count"), F.lit(1).alias("_one")
        )
    in_bounds = reduce(
        lambda a, b: a & b,
        [
            F.coalesce((F.col(f"min_{c}") >= low) & (F.col(f"max_{c}") <= high), F.lit(True))
            for c, (low, high) in spec.COORDINATE_RULES.items()
        ],
    )
    failed = F.lit(error is not None) | (F.col("records_extracted") == 0)
    verdict = (
        F.when(failed, "FAILED")
        .when(~in_bounds | (F.col("duplicate_records_count") > 0), "WARNING")
        .otherwise(F.lit(status))
    )
    loaded = F.col("records_extracted") if status == "SUCCESS" else F.lit(0).cast("bigint")
    details = F.to_json(
        F.struct(
            F.lit(error).cast("string").alias("validation_error"),
            F.col("checks"),
            F.struct(
                (F.col("duplicate_records_count") == 0).alias("passed"),
                F.col("duplicate_records_count").alias("duplicate_count"),
                F.array(*[F.lit(k) for k in active]).cast("array<string>").alias("pk_columns"),
            ).alias("duplicate_check"),
        )
    )
    # Two one-row results, joined on a constant.
    joined = rollup.join(duplicates, "_one")
    stats = {"status": verdict, "records_loaded": loaded, "validation_details": details}
    columns = [*head, "status", *_AUDIT_COUNTS, *_AUDIT_BOUNDS, "validation_details", *tail]
    return joined.withColumns({**head, **stats, **tail}).select(*columns)


_AUDIT_COUNTS = (
    "records_extracted",
    "records_loaded",
    "null_count_latitude",
    "null_count_longitude",
    "null_count_valid_time",
    "null_count_metric_values",
    "duplicate_records_count",
)
_AUDIT_BOUNDS = (
    "min_latitude",
    "max_latitude",
    "min_longitude",
    "max_longitude",
    "min_metric_value",
    "max_metric_value",
)


# -------------------------------------------------------------- declared tests


Test = tuple[str, Column, str]  # name, condition under which a row fails, severity


def _verdicts(df: DataFrame, tests: Sequence[Test]) -> DataFrame:
    """One aggregation over ``df``; one output row per test."""
    counted = df.agg(*[_count_if(failing).alias(f"t{i}") for i, (_, failing, _) in enumerate(tests)])
    rows = [
        F.struct(
            F.lit(name).alias("test_name"),
            F.col(f"t{i}").alias("failures"),
            F.lit(severity).alias("severity"),
            (F.col(f"t{i}") == 0).alias("passed"),
        )
        for i, (name, _, severity) in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*rows)))


def not_null_tests(columns: Iterable[str]) -> list[Test]:
    return [(f"not_null_{c}", F.col(c).isNull(), "error") for c in columns]


def accepted_value_tests(accepted: Mapping[str, Sequence]) -> list[Test]:
    return [(f"accepted_values_{c}", ~F.col(c).isin(*values), "error") for c, values in accepted.items()]


def range_tests(df: DataFrame, rules: Mapping[str, tuple[float, float]] = spec.RANGE_RULES) -> list[Test]:
    """Range rules for the columns ``df`` has. A NULL is not a failure: not_null covers it."""
    return [
        (f"expression_is_true_{c}", ~((F.col(c) >= low) & (F.col(c) <= high)), "warn")
        for c, (low, high) in rules.items()
        if c in df.columns
    ]


def check_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _verdicts(df, not_null_tests(columns))


def check_accepted_values(df: DataFrame, accepted: Mapping[str, Sequence]) -> DataFrame:
    return _verdicts(df, accepted_value_tests(accepted))


def check_expression(df: DataFrame, rules: Mapping[str, tuple[float, float]] = spec.RANGE_RULES) -> DataFrame:
    return _verdicts(df, range_tests(df, rules))


def check_unique(df: DataFrame, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """Keys that occur more than once; keys with a NULL part are left to not_null."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    repeated = df.where(whole).groupBy(*keys).count().where("count > 1")
    failures = F.count(F.lit(1))
    return repeated.agg(
        F.lit(name or f"unique_{'_'.join(keys)}").alias("test_name"),
        failures.alias("failures"),
        F.lit("error").alias("severity"),
        (failures == 0).alias("passed"),
    )


def check_table(
    df: DataFrame,
    required: Iterable[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
    rules: Mapping[str, tuple[float, float]] = spec.RANGE_RULES,
) -> DataFrame:
    """Every row-wise test of a table in a single scan."""
    return _verdicts(df, [*not_null_tests(required), *accepted_value_tests(accepted or {}), *range_tests(df, rules)])


def check_fact(df: DataFrame, model: str, shape: str) -> DataFrame:
    """All declared tests of one fact table: one scan, and one shuffle for its key."""
    required = [c for c in spec.fact_columns(shape) if c in df.columns]
    rowwise = check_table(df, required, spec.accepted_values(model, shape))
    return rowwise.unionByName(check_unique(df, spec.fact_key(shape)))


def check_seed(df: DataFrame, name: str) -> DataFrame:
    """Declared tests of a seed: its key is there and unique, its words are known ones."""
    keys = spec.SEED_KEYS[name]
    accepted = {"logic_type": spec.ACCEPTED_LOGIC} if "logic_type" in df.columns else {}
    return check_table(df, keys, accepted, {}).unionByName(check_unique(df, keys))


def check_times(df: DataFrame) -> DataFrame:
    """Declared tests of the time dimension."""
    return check_table(df, spec.TIME_KEY, {"cycle_hour": spec.SIX_HOURLY}, {}).unionByName(
        check_unique(df, spec.TIME_KEY)
    )


# ------------------------------------------------------------ published tables


def verify_gold(views: Mapping[str, DataFrame], column: str = "valid_date") -> DataFrame:
    """Rows, NULL valid dates and freshness of each published view."""
    return gold_verdicts({name: measured_gold(df, column=column) for name, df in views.items()})


def measured_gold(df: DataFrame, by: Sequence[str] = (), column: str = "valid_date") -> DataFrame:
    """Rows, NULL valid dates and the newest one: one row, or one per value of ``by``."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        _count_if(F.col(column).isNull()).alias("valid_date__nulls"),
        F.max(column).alias("valid_date__max"),
    )


def gold_verdicts(measured: Mapping[str, DataFrame]) -> DataFrame:
    """The verdict on each view from its one row of measures."""
    results = [
        df.select(
            F.lit(name).alias("view_name"),
            F.col("rows").alias("row_count"),
            F.col("valid_date__nulls").alias("null_valid_date_count"),
            F.col("valid_date__max").alias("max_valid_date"),
        )
        for name, df in measured.items()
    ]
    passed = (F.col("row_count") > 0) & (F.col("null_valid_date_count") == 0)
    return reduce(DataFrame.unionByName, results).withColumns(
        {"passed": passed, "status": F.when(passed, "SUCCESS").otherwise("WARNING")}
    )


def gold_audit_row(verification: DataFrame, seconds: float = 0.0, **run: str) -> DataFrame:
    """Verification rows, one per view, as a single audit row with JSON details."""
    details = F.map_from_entries(
        F.collect_list(
            F.struct("view_name", F.struct("row_count", "null_valid_date_count", "max_valid_date", "passed"))
        )
    )
    summary = verification.agg(F.to_json(details).alias("details"), F.bool_and("passed").alias("passed"))
    empty = audit_row(None, spark=verification.sparkSession, seconds=seconds, **run)
    return (
        empty.withColumn("_one", F.lit(1))
        .join(summary.withColumn("_one", F.lit(1)), "_one")
        .withColumns(
            {"status": F.when(F.col("passed"), "SUCCESS").otherwise("WARNING"), "validation_details": F.col("details")}
        )
        .select(*empty.columns)
    )


def read_back(written: DataFrame, table: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows written against rows read back, per partition of the write."""
    sent = written.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("rows_written"))
    found = table.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("rows_read"))
    return (
        sent.join(found, list(partition_by), "left")
        .withColumn("rows_read", F.coalesce("rows_read", F.lit(0)))
        .withColumn("passed", F.col("rows_written") == F.col("rows_read"))
    )
