"""Profiles kept per partition, counts from footers, widening of column types."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast import spec
from gridcast.operators import facts, ingest, profiles, quality, writers
from gridcast.sources.footers import partition_rows, read_pushed

PART = ("d", "h")
DDL = "latitude double, longitude double, valid_time timestamp_ntz, gh float, t float, d string, h int"


def load(spark, rows):
    return spark.createDataFrame([(lat, 1.0, None, gh, t, d, h) for lat, gh, t, d, h in rows], DDL)


def whole(df):
    return quality.profile_rollup(df.drop(*PART)).first()


START = [(1.0, 2.0, None, "a", 0), (5.0, float("nan"), 3.0, "a", 6), (None, 9.0, 4.0, "b", 0), (7.0, 1.0, 1.0, None, 0)]


def test_profile_follows_the_table(spark, fresh):
    path = fresh()
    kept = profiles.refresh(load(spark, START), path, PART)
    assert kept.count() == 4 and profiles.rollup(kept).first() == whole(load(spark, START))
    # Partition b lost its row, a new one came, the row without a partition changed; a is not measured again.
    later = [*START[:2], (8.0, 3.0, 3.0, "c", 0), (70.0, None, 1.0, None, 0)]
    kept = profiles.refresh(load(spark, later), path, PART, F.col("d") >= "b")
    assert profiles.rollup(kept).first() == whole(load(spark, later))
    assert {r.d for r in kept.collect()} == {"a", "c", None}


def test_only_stale_partitions_are_measured(spark, fresh):
    path = fresh()
    profiles.refresh(load(spark, START), path, PART)
    changed = [(90.0, 2.0, None, "a", 0), *START[1:]]
    kept = profiles.refresh(load(spark, changed), path, PART, F.col("d") >= "b")
    assert profiles.rollup(kept).first() == whole(load(spark, START))


def test_a_column_that_only_later_loads_have(spark, fresh):
    path = fresh()
    profiles.refresh(load(spark, START[:2]), path, PART)
    both = load(spark, START).withColumn("q", F.when(F.col("d") == "b", F.lit(1.5).cast("float")))
    kept = profiles.refresh(both, path, PART, F.col("d") >= "b")
    assert profiles.rollup(kept).first() == whole(both)


def test_profile_of_an_empty_table(spark, fresh):
    got = profiles.rollup(profiles.refresh(load(spark, []), fresh(), PART)).first()
    assert (got.records_extracted, got.null_count_latitude, got.min_latitude) == (0, 0, None)


def test_views_are_verified_from_profiles(spark, fresh):
    view = spark.sql("SELECT date'2026-03-20' + int(id % 4) AS cycle_date, int(id % 2) AS cycle_hour, "
                     "if(id = 7, NULL, date'2026-03-20' + int(id)) AS valid_date FROM range(20)")  # fmt: skip
    path = fresh()
    for stale in (None, F.col("cycle_date") >= F.lit("2026-03-22").cast("date")):
        kept = profiles.refresh(view, path, spec.FACT_PARTITIONS, stale, quality.measured_gold)
        assert quality.gold_verdicts({"v": profiles.merged(kept)}).collect() == quality.verify_gold({"v": view}).collect()


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact") / "t")
    rows = spark.sql("SELECT date'2026-03-20' + int(id % 6) AS cycle_date, int(12 * (id % 2)) AS cycle_hour, id AS v FROM range(60)")
    writers.append_partitions(rows, path, spec.FACT_PARTITIONS)
    return path


def test_the_mark_reads_no_data(spark, fact):
    held = partition_rows(spark, fact, spec.FACT_PARTITIONS)
    plan = held.where("cycle_date >= date'2026-03-24'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PartitionFilters: [isnotnull(cycle_date" in plan and "v#" not in plan
    table = spark.read.parquet(fact)
    later = spark.sql("SELECT date'2026-03-25' + int(id) AS cycle_date, 12 AS cycle_hour, id AS v FROM range(3)")
    for mark in ("epoch", "block"):
        for as_of in ("2026-03-26", "2026-05-01"):
            got, expected = (facts.rows_above_mark(later, t, as_of, 7, mark).collect() for t in (held, table))
            assert got == expected
    assert {tuple(r)[:2]: r.rows for r in held.collect()} == {tuple(r)[:2]: r["count"] for r in table.groupBy(*spec.FACT_PARTITIONS).count().collect()}


def test_footers_leave_other_reads_alone(spark, fact):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    read_pushed(spark, fact)
    with pytest.raises(Exception):
        read_pushed(spark, fact + "-absent")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert partition_rows(spark, fact, spec.FACT_PARTITIONS, spark.read.parquet(fact).schema).count() == 6


B, S, I, L, R, D = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()


@pytest.mark.parametrize("a,b,c", [(I, I, I), (B, I, I), (I, L, L), (L, S, L), (R, D, D), (I, R, D), (L, R, D), (D, B, D), (R, R, R)])
def test_wider(a, b, c):
    assert ingest.wider(a, b) == ingest.wider(b, a) == c


def test_unlike_types_are_an_error(spark):
    for other in (T.StringType(), T.DateType(), T.BooleanType()):
        with pytest.raises(ingest.SchemaMismatch, match="k is"):
            ingest.wider(I, other, "k")
    with pytest.raises(ingest.SchemaMismatch):
        ingest.evolve_to(spark.createDataFrame([("x",)], "k string"), T.StructType([T.StructField("k", I)]))


def test_evolve_casts_up_and_never_down(spark):
    table = T.StructType([T.StructField("a", L), T.StructField("b", R), T.StructField("c", I)])
    df = spark.createDataFrame([(1, 2.5)], "a int, b double")
    assert dict(ingest.evolve_to(df, table).dtypes) == {"a": "bigint", "b": "double", "c": "int"}


def test_schema_beside_the_table_widens(spark, fresh):
    path = fresh()

    def schema(ddl):
        return T.StructType.fromDDL(ddl)

    writers.keep_schema(spark, path, schema("a int, b float"))
    assert writers.keep_schema(spark, path, schema("b double, a bigint, c int")) == schema("a bigint, b double, c int")
    assert writers.keep_schema(spark, path, schema("a int, c smallint")) == schema("a bigint, b double, c int")
    with pytest.raises(ingest.SchemaMismatch, match="rewrite"):
        writers.keep_schema(spark, path, schema("a double"))
    assert writers.stored_schema(spark, path) == schema("a bigint, b double, c int")
