import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.operators import writers

PART = ("d", "h")
DDL = "d string, h int, k int, v int"


def rows(df):
    return sorted(tuple(r[c] for c in ("d", "h", "k", "v")) for r in df.collect())


def read(spark, path):
    return spark.read.schema("k int, v int, d string, h int").parquet(path)


START = [("a", 0, 1, 1), ("a", 6, 2, 1), ("b", 0, 3, 1), ("b", 6, 4, 1)]


@pytest.fixture
def table(spark, fresh):
    path = fresh()
    writers.append_partitions(spark.createDataFrame(START, DDL), path, PART)
    return path


def test_append_keeps_what_is_there(spark, table):
    writers.append_partitions(spark.createDataFrame(START[:1], DDL), table, PART, rebalance=False)
    assert rows(read(spark, table)) == sorted(START + START[:1])


@pytest.mark.parametrize("wipe,left", [("exact", [START[1], START[2]]), ("product", [])])
def test_replace(spark, table, wipe, left):
    batch = [("a", 0, 9, 2), ("b", 6, 9, 2)]
    for _ in range(2):  # replacing again changes nothing
        writers.replace_partitions(spark.createDataFrame(batch, DDL), table, PART, wipe=wipe)
        assert rows(read(spark, table)) == sorted(left + batch)


def test_replace_rejects_unknown_mode(spark, table):
    with pytest.raises(ValueError):
        writers.replace_partitions(spark.createDataFrame(START, DDL), table, PART, wipe="all")


def test_replace_may_read_its_target(spark, table):
    bumped = read(spark, table).where("d = 'a'").withColumn("v", F.col("v") + 1)
    writers.replace_partitions(bumped, table, PART)
    assert rows(read(spark, table)) == [("a", 0, 1, 2), ("a", 6, 2, 2), ("b", 0, 3, 1), ("b", 6, 4, 1)]


def test_merge_updates_inserts_and_repeats(spark, table):
    batch = spark.createDataFrame([("a", 0, 1, 7), ("a", 0, 5, 7), ("c", 0, 1, 7)], DDL)
    for _ in range(2):
        writers.merge_on_key(batch, table, ["d", "h", "k"], PART)
        assert rows(read(spark, table)) == sorted([("a", 0, 1, 7), ("a", 0, 5, 7), ("c", 0, 1, 7), *START[1:]])


def test_merge_leaves_unmatched_repeats_alone(spark, table):
    writers.append_partitions(spark.createDataFrame(START[:1], DDL), table, PART)
    writers.merge_on_key(spark.createDataFrame([("a", 0, 2, 9)], DDL), table, ["d", "h", "k"], PART)
    assert rows(read(spark, table)).count(("a", 0, 1, 1)) == 2


def test_merge_matches_null_key_parts(spark, table):
    batch = spark.createDataFrame([("a", 0, None, 7)], DDL)
    for _ in range(2):
        writers.merge_on_key(batch, table, ["d", "h", "k"], PART)
        assert read(spark, table).where("k is null").count() == 1


def test_merge_orders_repeated_keys_and_drops_helpers(spark, table):
    batch = spark.createDataFrame([("a", 0, 1, 7, 2), ("a", 0, 1, 8, 1)], DDL + ", n int")
    writers.merge_on_key(batch, table, ["d", "h", "k"], PART, order=["n"], columns=["d", "h", "k", "v"])
    assert ("a", 0, 1, 8) in rows(read(spark, table))


def test_merge_needs_partitions_in_the_key(spark, table):
    with pytest.raises(ValueError):
        writers.merge_on_key(spark.createDataFrame(START, DDL), table, ["k"], PART)


def test_touched_partitions_prune_and_match_null(spark, table):
    writers.append_partitions(spark.createDataFrame([(None, 0, 9, 9), ("a", None, 8, 8)], DDL), table, PART)
    batch = spark.createDataFrame([("a", 6, 0, 0), (None, 0, 0, 0)], DDL)
    found = writers.touched_partitions(read(spark, table), batch, PART)
    assert sorted(map(tuple, found.select("d", "h", "k", "v").collect()), key=str) == [("a", 6, 2, 1), (None, 0, 9, 9)]
    assert "PartitionFilters: [(((d" in found._jdf.queryExecution().executedPlan().toString()


def test_touched_partitions_read_the_batch_once(spark, table, fresh):
    """The rows they give don't read the batch again, whatever it costs to make; a batch without rows touches none."""
    path = fresh()
    spark.createDataFrame([("a", 6, 0, 0), ("a", 6, 1, 0)], DDL).write.parquet(path)
    found = writers.touched_partitions(read(spark, table), spark.read.parquet(path), PART)
    assert found.count() == 1 and not any(path in f for f in found.inputFiles())
    assert writers.touched_partitions(read(spark, table), spark.createDataFrame([], DDL), PART).count() == 0


@pytest.mark.parametrize("load", ["merge", "delete_insert"])
def test_rows_with_null_partition_values_stay(spark, fresh, load):
    path = fresh()
    ddl = "d date, h int, k int, v int"
    old = spark.createDataFrame([(date(2026, 3, 1), 0, 1, 1), (None, 0, 2, 1), (None, None, 3, 1)], ddl)
    new = spark.createDataFrame([(None, 0, 4, 2), (None, None, 3, 2)], ddl)
    for batch in (old, new):
        if load == "merge":
            writers.merge_on_key(batch, path, ["d", "h", "k"], PART)
        else:
            writers.delete_insert(batch, path, ["d", "h", "k"], PART)
    got = sorted((r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (2, 1), (3, 2), (4, 2)]


def test_a_hot_key_gathers_nowhere(spark, table, monkeypatch):
    """Before any shuffle by key, each task reduces the batch to one row a key; the table goes through no window."""
    plans = []
    monkeypatch.setattr(writers, "_writer", lambda df, *a, **k: plans.append(df) or type("W", (), {"save": lambda self, p: None})())
    monkeypatch.setattr(writers, "overwrite_table", lambda df, *a, **k: plans.append(df))
    batch = spark.range(5).select(F.lit("a").alias("d"), F.lit(0).alias("h"), F.col("id").cast("int").alias("k"), F.lit(1).alias("v"))
    writers.merge_on_key(batch, table, ["d", "h", "k"], PART, order=["v"])
    writers.merge_by_arrival(batch, table, ["d", "h", "k"], ["v"], PART)
    writers.delete_insert(batch, table, ["d", "h", "k"], PART)
    for df, windows in zip(plans, (1, 1, 0)):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
        assert len(re.findall(r"\bWindow \[", plan)) == windows
        assert len(re.findall(r"WindowGroupLimit .*Partial", plan)) == windows


def test_merge_of_a_hot_key(spark, table):
    """A third of the batch is one key: the first row wins, and a repeat of the load changes nothing."""
    hot = spark.range(3000).select(
        F.lit("a").alias("d"), F.lit(0).alias("h"), F.when(F.col("id") % 3 > 0, F.col("id") + 100).otherwise(1).cast("int").alias("k"), (5000 - F.col("id")).cast("int").alias("v")
    )
    for _ in range(2):
        writers.merge_on_key(hot, table, ["d", "h", "k"], PART, order=["v"])
        got = read(spark, table).where("k = 1 and d = 'a' and h = 0").collect()
        assert [r.v for r in got] == [5000 - 2997] and read(spark, table).count() == 2000 + len(START)


@pytest.mark.parametrize("cuts", [[[0, 1, 2, 3, 4, 5]], [[5, 0], [1, 3], [4], [2]], [[3], [2], [1], [0], [5], [4], [4], [0]]])
def test_merge_by_arrival_does_not_depend_on_the_cuts(spark, fresh, cuts):
    path = fresh()
    given = [("a", 0, 1, 10, 2), ("a", 0, 1, 11, 1), ("a", 0, 1, 12, 3), ("a", 0, 2, 13, 1), ("b", 6, None, 14, 1), ("b", 6, None, 15, 2)]
    for cut in cuts:
        batch = spark.createDataFrame([given[i] for i in cut], DDL + ", n int")
        writers.merge_by_arrival(batch, path, ["d", "h", "k"], [F.desc("n")], PART)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [12, 13, 15]


def test_a_failed_first_write_is_no_table(spark, fresh):
    path = fresh()
    with pytest.raises(Exception):
        spark.range(3).select(F.raise_error(F.lit("no")).alias("v")).write.parquet(path)
    spark.range(0).write.mode("overwrite").parquet(f"{path}/_temporary/0")
    assert not writers.table_exists(spark, path)


def test_a_failed_swap_puts_the_table_back(spark, table, monkeypatch):
    real = writers._file_system
    moves = []

    class Stubborn:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            moves.append(1)
            return False if len(moves) == 2 else self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    monkeypatch.setattr(writers, "_file_system", lambda s, p: (Stubborn(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError, match="the old table is back"):
        writers.overwrite_table(spark.createDataFrame([("z", 0, 9, 9)], DDL), table, PART)
    assert rows(read(spark, table)) == START


@pytest.mark.parametrize("partition_by", [(), PART])
def test_delete_insert(spark, fresh, partition_by):
    path = fresh()
    writers.delete_insert(spark.createDataFrame(START, DDL), path, ["d", "k"], partition_by)
    # The batch holds a key twice: both rows go in.
    writers.delete_insert(spark.createDataFrame([("a", 0, 1, 5), ("a", 0, 1, 6)], DDL), path, ["d", "k"], partition_by)
    assert rows(read(spark, path)) == sorted([("a", 0, 1, 5), ("a", 0, 1, 6), *START[1:]])


def test_overwrite_may_read_its_target(spark, table):
    writers.overwrite_table(read(spark, table).where("k > 2"), table, PART)
    assert rows(read(spark, table)) == START[2:]


def test_failed_overwrite_leaves_the_table(spark, table):
    broken = read(spark, table).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        writers.overwrite_table(broken, table, PART)
    assert rows(read(spark, table)) == START


def test_expire_and_listing(spark, fresh):
    path = fresh()
    data = [("2026-03-18", 0, 1, 1), ("2026-03-19", 6, 1, 1), ("2026-03-20", 0, 1, 1)]
    writers.append_partitions(spark.createDataFrame(data, DDL), path, PART)
    assert writers.partition_listing(spark, path, PART).count() == 3
    dropped = writers.expire_partitions(spark, path, "2026-03-26", 7, PART)
    assert [p["d"] for p in dropped] == ["2026-03-18"]
    assert rows(read(spark, path)) == data[1:]


def test_repartition_fact_runs_once(spark, fresh):
    source, target = fresh(), fresh()
    spark.createDataFrame([("2026-03-18", 0, 1, 1)], "cycle_date string, cycle_hour int, k int, v int").write.parquet(source)
    assert writers.repartition_fact(spark, source, target) is True
    assert writers.repartition_fact(spark, source, target) is False
    assert writers.partition_dirs(spark, target, ("cycle_hour", "cycle_date"))[0]["cycle_hour"] == "0"


def test_rows_are_laid_down_by_place_with_one_sort(spark, fresh):
    path = fresh()
    df = spark.range(20_000).select(
        (F.col("id") % 2).cast("int").alias("h"),
        (F.hash("id") % 1000).alias("lat_i"),
        F.hash(F.col("id") + 1).alias("lon_i"),
        F.expr("nullif(if(id % 3 = 0, 'a', 'b'), if(id = 7, 'b', 'c')) AS d"),
    )
    plan = writers.clustered(df, PART)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1
    writers.append_partitions(df, path, PART)
    for f in spark.read.parquet(path).inputFiles():
        index = [r.lat_i for r in spark.read.parquet(f).collect()]
        assert index == sorted(index)
    assert spark.read.parquet(path).where("d IS NULL").count() == 1


def test_export_is_zstd(spark, fresh):
    path = fresh()
    writers.export_parquet(spark.createDataFrame(START, DDL), path, PART)
    assert all(".zstd." in f for f in spark.read.parquet(path).inputFiles())


def test_hot_partition_is_written_by_several_tasks(spark, fresh):
    path = fresh()
    hot = spark.range(400_000).select(F.lit("a").alias("d"), F.lit(0).alias("h"), F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        writers.append_partitions(hot, path, PART)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert len(spark.read.parquet(path).inputFiles()) > 1
    assert spark.read.parquet(path).count() == 400_000
    assert spec.FACT_PARTITIONS == ("cycle_date", "cycle_hour")
