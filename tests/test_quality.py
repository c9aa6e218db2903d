import json

import pytest

from gridcast.operators import dims, facts, quality
from gridcast.operators.staging import stage
from gridcast.plans import inputs

RUN = dict(dag_id="d", run_id="r", logical_date="2026-03-26 00:00:00", model_name="gfs", layer_type="upper")
DDL = "latitude double, longitude double, valid_time timestamp, lat_i int, gh float, t float"


@pytest.fixture
def clean(spark):
    return spark.createDataFrame([(1.0, 2.0, None, 1, 5.0, None), (3.0, 4.0, None, 2, float("nan"), 6.0)], DDL)


def test_profile_tells_nan_from_null(clean):
    got = {r.column_name: r for r in quality.profile_columns(clean).collect()}
    assert (got["gh"].null_count, got["gh"].nan_count, got["gh"].min_value, got["gh"].max_value) == (0, 1, 5.0, 5.0)
    assert (got["t"].null_count, got["t"].null_percentage) == (1, 50.0)


def test_profile_of_nothing(clean):
    row = quality.profile_columns(clean.limit(0)).first()
    assert (row.row_count, row.null_count, row.null_percentage, row.min_value) == (0, 0, 0.0, None)


@pytest.mark.parametrize(
    "change,keys,error,status,expected,loaded",
    [
        (lambda d: d, ["lat_i"], None, "SUCCESS", "SUCCESS", 2),
        (lambda d: d.union(d), ["lat_i", "absent"], None, "SUCCESS", "WARNING", 4),
        (lambda d: d.selectExpr("latitude + 89 as latitude", *d.columns[1:]), [], None, "SUCCESS", "WARNING", 2),
        (lambda d: d, ["lat_i"], "boom", "SUCCESS", "FAILED", 2),
        (lambda d: d, ["lat_i"], None, "FAILED", "FAILED", 0),
        (lambda d: d.limit(0), ["lat_i"], None, "SUCCESS", "FAILED", 0),
    ],
)
def test_audit_status(clean, change, keys, error, status, expected, loaded):
    row = quality.audit_row(change(clean), keys=keys, error=error, status=status, **RUN).first()
    assert (row.status, row.records_loaded) == (expected, loaded)
    details = json.loads(row.validation_details)
    assert details.get("validation_error") == error and set(details["checks"]) == {"gh", "t"}


def test_audit_of_a_load_that_made_nothing(spark, clean):
    row = quality.audit_row(None, spark=spark, error="no rows", **RUN)
    assert row.columns == quality.audit_row(clean, **RUN).columns
    assert (row.first().status, row.first().records_extracted) == ("FAILED", 0)


def test_duplicates_count_null_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (None, None)], "a int, b int")
    row = quality.duplicate_keys(df, ["a", "b"]).first()
    assert (row.row_count, row.duplicate_records_count, row.status) == (4, 1, "WARNING")


def test_unique_leaves_null_keys_alone(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "a int")
    row = quality.check_unique(df, ["a"]).first()
    assert (row.failures, row.passed) == (1, False)


def test_rules_do_not_count_nulls(spark):
    df = spark.createDataFrame([(None,), (100.0,), (200.0,), (400.0,)], "temp_kelvin float")
    row = quality.check_expression(df).first()
    assert (row.test_name, row.failures, row.severity) == ("expression_is_true_temp_kelvin", 2, "warn")
    assert quality.check_not_null(df, ["temp_kelvin"]).first().failures == 1
    accepted = quality.check_accepted_values(df, {"temp_kelvin": (100.0,)}).first()
    assert accepted.failures == 2


def test_whole_table_is_one_scan(spark):
    df = spark.createDataFrame([(None, "x")], "temp_kelvin float, weather_model string")
    checks = quality.check_table(df, ["temp_kelvin"], {"weather_model": ("gfs",)})
    assert {r.test_name: r.failures for r in checks.collect()} == {
        "not_null_temp_kelvin": 1,
        "accepted_values_weather_model": 1,
        "expression_is_true_temp_kelvin": 0,
    }
    assert checks._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def failures(df):
    return {r.test_name: r.failures for r in df.collect()}


def test_declared_tests_of_a_fact(spark, sf_dir):
    rows = facts.to_fact(stage(inputs.raw(spark, sf_dir, "upper", "ifs"), "upper"), "ifs", "upper", inputs.STAMP)
    got = failures(quality.check_fact(rows, "ifs", "upper"))
    assert len(got) == 15 + 3 + 6 + 1
    assert got["accepted_values_cycle_hour"] == got["not_null_lat_i"] == 0
    assert got["not_null_geopotential_height_m"] == rows.where("geopotential_height_m IS NULL").count() > 0
    assert failures(quality.check_fact(rows, "aifs", "upper"))["accepted_values_weather_model"] == rows.count()


def test_declared_tests_of_seeds_and_times(spark):
    assert set(failures(quality.check_seed(dims.stations(spark), "weather_station")).values()) == {0}
    seed = spark.createDataFrame([("a", "MAX"), ("a", "GT"), (None, "MIN")], "threshold_id string, logic_type string")
    assert failures(quality.check_seed(seed, "physical_thresholds")) == {
        "not_null_threshold_id": 1,
        "accepted_values_logic_type": 1,
        "unique_threshold_id": 1,
    }
    anchor = spark.range(1).selectExpr("DATE'2026-03-26' AS as_of", "TIMESTAMP'2026-03-26 12:00:00' AS dbt_updated_at")
    assert set(failures(quality.check_times(dims.time_dimension(anchor, 4))).values()) == {0}


def test_gold_verification(spark):
    df = spark.createDataFrame([("2026-03-26",), (None,)], "d string").selectExpr("cast(d as date) valid_date")
    got = {r.view_name: r.status for r in quality.verify_gold({"ok": df.dropna(), "nulls": df, "empty": df.limit(0)}).collect()}
    assert got == {"ok": "SUCCESS", "nulls": "WARNING", "empty": "WARNING"}
    for views, status in (({"ok": df.dropna()}, "SUCCESS"), ({"ok": df.dropna(), "nulls": df}, "WARNING")):
        row = quality.gold_audit_row(quality.verify_gold(views), **RUN).first()
        assert row.status == status
        assert json.loads(row.validation_details)["ok"] == {
            "row_count": 1, "null_valid_date_count": 0, "max_valid_date": "2026-03-26", "passed": True
        }


def test_read_back_reports_lost_rows(spark):
    sent = spark.createDataFrame([("a",), ("a",), ("b",)], "d string")
    got = {r.d: (r.rows_written, r.rows_read, r.passed) for r in quality.read_back(sent, sent.limit(1), ["d"]).collect()}
    assert got["b"][2] is False or got["a"][2] is False
    assert {v[1] for v in got.values()} == {0, 1}
