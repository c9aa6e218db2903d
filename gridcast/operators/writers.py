"""Write strategies for partitioned tables.

All of them write with one Spark job per target. Output is rebalanced on the partition
columns first: AQE then merges small pieces and splits a partition that holds much of the
data over several tasks, so a hot (date, cycle) is not written by one task. Rows that are
already grouped by partition are better written with ``rebalance=False``, which saves
the shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast import spec
from gridcast.operators.ingest import SchemaMismatch, dedup_first, wider

# Fixed value: directory name of a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def rebalanced(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in columns])


def clustered(df: DataFrame, partition_by: Sequence[str], rebalance: bool = True) -> DataFrame:
    """Rows as they are laid down: by partition, then by place.

    Writing partitions sorts by the partition columns anyway; going on with the grid index
    costs no second sort, compresses the index to runs, and lets a scan for a region skip
    row groups by their bounds.
    """
    place = [c for c in spec.GRID_KEY if c in df.columns and c not in partition_by]
    # Spark re-sorts nullable text partition columns; naming NULL as its directory does avoids that.
    text = [c for c, t in df.dtypes if c in partition_by and t == "string"]
    df = df.withColumns({c: F.coalesce(c, F.lit(NULL_PARTITION)) for c in text}) if text else df
    return (rebalanced(df, partition_by) if rebalance else df).sortWithinPartitions(*partition_by, *place)


def _writer(
    df: DataFrame, partition_by: Sequence[str], mode: str, overwrite: str, codec: str, rebalance: bool = True
):
    return (
        clustered(df, partition_by, rebalance)
        .write.format("parquet")
        .mode(mode)
        .option("partitionOverwriteMode", overwrite)
        .option("compression", codec)
        .partitionBy(*partition_by)
    )


# ------------------------------------------------------------------ file system


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds files or partitions; what a failed first write leaves behind is hidden and no table."""
    fs, where = _file_system(spark, path)
    return fs.exists(where) and any(str(s.getPath().getName())[0] not in "_." for s in fs.listStatus(where))


def partition_dirs(spark: SparkSession, path: str, partition_by: Sequence[str]) -> list[dict[str, str]]:
    """Partitions of a table from its directory names; no file is opened."""
    fs, _ = _file_system(spark, path)
    pattern = _file_system(spark, "/".join([path, *[f"{c}=*" for c in partition_by]]))[1]
    found = fs.globStatus(pattern) or []
    return [
        {**dict(p.split("=", 1) for p in str(s.getPath()).split("/")[-len(partition_by) :]), "path": str(s.getPath())}
        for s in found
    ]


def partition_listing(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """The partition directories as a DataFrame of (path)."""
    rows = [(p["path"] + "/",) for p in partition_dirs(spark, path, partition_by)]
    return spark.createDataFrame(rows, "path string")


def drop_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], doomed) -> list[dict[str, str]]:
    """Remove the partitions for which ``doomed(values)`` holds, as a catalogue's DROP PARTITION does."""
    fs, _ = _file_system(spark, path)
    dropped = [p for p in partition_dirs(spark, path, partition_by) if doomed(p)]
    for p in dropped:
        fs.delete(_file_system(spark, p["path"])[1], True)
    return dropped


# ------------------------------------------------------------- schema of a table

# Hidden from scans by its underscore.
SCHEMA_FILE = "_table_schema.json"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept beside a table's partitions, if there is one."""
    fs, where = _file_system(spark, f"{path}/{SCHEMA_FILE}")
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return T.StructType.fromJson(json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """Notes the columns of a batch beside the table: those known keep their place, new ones follow.

    A column takes the wider of its noted and its new type (see ``ingest.wider``), and readers then see all files in it.
    Call it before the batch is written: files of the narrower type can be read in the wider one, not the other way
    round. Long integers can't be read as doubles; that widening is an error, and needs the table to be rewritten.
    """
    known = stored_schema(spark, path) or T.StructType()
    fresh = {f.name: f.dataType for f in schema}
    fields = [T.StructField(f.name, wider(f.dataType, fresh.get(f.name, f.dataType), f.name)) for f in known]
    for old, new in zip(known, fields):
        if old.dataType == T.LongType() and new.dataType != old.dataType:
            raise SchemaMismatch(f"{new.name} is a long integer in {path}; rewrite the table before it can hold doubles")
    fields += [f for f in schema if f.name not in known.names]
    if [(f.name, f.dataType) for f in fields] != [(f.name, f.dataType) for f in known]:
        fs, where = _file_system(spark, f"{path}/{SCHEMA_FILE}")
        stream = fs.create(where, True)
        try:
            stream.write(bytearray(T.StructType(fields).json(), "utf-8"))
        finally:
            stream.close()
    return T.StructType(fields)


# ------------------------------------------------------------- write strategies


def append_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = spec.RAW_PARTITIONS,
    codec: str = "snappy",
    rebalance: bool = True,
) -> None:
    """Create the table on first write, append afterwards."""
    _writer(df, partition_by, "append", "dynamic", codec, rebalance).save(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = spec.RAW_PARTITIONS,
    wipe: str = "exact",
    codec: str = "snappy",
    rebalance: bool = True,
) -> None:
    """Replace the partitions the batch holds.

    ``exact`` replaces the batch's own value combinations in one job commit. ``product``
    also removes combinations of the batch's dates with its cycles that the batch does
    not hold, as a predicate ``date IN (..) AND cycle IN (..)`` would.
    """
    _writer(df, partition_by, "overwrite", "dynamic", codec, rebalance).save(path)
    if wipe == "product":
        # Partition values only, in directory-name form: as many rows as partitions written.
        held = {tuple(str(v) for v in r) for r in df.select(*partition_by).distinct().toLocalIterator()}
        values = [set(column) for column in zip(*held)]
        drop_partitions(
            df.sparkSession,
            path,
            partition_by,
            lambda p: all(p[c] in v for c, v in zip(partition_by, values))
            and tuple(p[c] for c in partition_by) not in held,
        )
    elif wipe != "exact":
        raise ValueError(f"wipe is 'exact' or 'product', not {wipe!r}")


def export_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = spec.RAW_PARTITIONS) -> None:
    """Hive-partitioned ZSTD files; partitions of the batch are overwritten, others stay."""
    _writer(df, partition_by, "overwrite", "dynamic", "zstd").save(path)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Rebuild a table. The new files are written beside the old ones and swapped in, so
    the query may read the table it replaces and a failed job leaves it untouched.

    A file system reports a failed rename by its result. If the swap fails half way, the
    old table is put back and the error names what lies where.
    """
    spark = df.sparkSession
    fresh = f"{path}__{uuid4().hex}"
    writer = (clustered(df, partition_by) if partition_by else df).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(fresh)
    fs, current = _file_system(spark, path)
    made = _file_system(spark, fresh)[1]
    retired = _file_system(spark, f"{path}__{uuid4().hex}")[1]
    replaced = fs.exists(current)
    if replaced and not fs.rename(current, retired):
        fs.delete(made, True)
        raise OSError(f"{path} could not be moved aside; it is unchanged")
    if not fs.rename(made, current):
        back = not replaced or fs.rename(retired, current)
        raise OSError(f"{fresh} could not be moved to {path}; " + ("the old table is back" if back else f"the old table is at {retired}"))
    if replaced:
        fs.delete(retired, True)


def touched_partitions(table: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The table's rows in the partitions the batch touches; NULL partition values match each other.

    The least and the greatest first partition value of the batch prune the scan, a null-safe semi join on the touched
    values then takes exactly those partitions. Both are the same for one touched partition and for a backfill of years.
    The batch is read once for them: there are as many as partitions it writes, which the driver lists anyway.
    """
    first = partition_by[0]
    values = batch.select(*partition_by).distinct()
    touched = values.toArrow()
    values = batch.sparkSession.createDataFrame(touched, values.schema)
    known = touched.column(first).drop_null().to_pylist()
    low, high = (F.lit(f(known, default=None)) for f in (min, max))
    near = table.where(F.col(first).between(low, high) | F.col(first).isNull())
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"b.{c}")) for c in partition_by]
    return near.alias("t").join(F.broadcast(values).alias("b"), reduce(lambda a, b: a & b, same), "left_semi")


def _unmatched(table: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table's rows whose key the batch does not hold; NULL key parts match each other.

    The batch's keys are reduced to one row a key per task before they are shuffled, and the table's rows of one key only
    stream past them: a key that repeats without bound, on either side, gathers nowhere. A small batch is broadcast by
    Spark's size check, and the table is then not shuffled at all.
    """
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return table.alias("t").join(batch.select(*keys).distinct().alias("b"), reduce(lambda a, b: a & b, same), "left_anti")


def merge_on_key(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = spec.FACT_PARTITIONS,
    order: Iterable[Column | str] | None = None,
    columns: Sequence[str] | None = None,
) -> None:
    """Update matching keys, insert the rest, in the partitions the batch touches.

    ``order`` names which of several batch rows with one key wins (the first); without it
    the batch must be unique on the key. ``columns`` names those that are stored, if the
    batch carries others to order by. The partition columns must be part of the key,
    since a key then never lies outside the touched partitions. Merging the same batch
    again changes nothing.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the merge key")
    spark = batch.sparkSession
    if not table_exists(spark, path):
        batch = dedup_first(batch, keys, order) if order is not None else batch
        append_partitions(batch.select(*columns) if columns is not None else batch, path, partition_by)
        return
    table = spark.read.parquet(path)
    kept = _unmatched(touched_partitions(table, batch, partition_by), batch, keys)
    best = dedup_first(batch, keys, order) if order is not None else batch
    rows = best.select(*table.columns).unionByName(kept.select(*table.columns))
    _writer(rows, partition_by, "overwrite", "dynamic", "snappy").save(path)


def merge_by_arrival(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    arrival: Sequence[Column | str],
    partition_by: Sequence[str] = spec.FACT_PARTITIONS,
) -> None:
    """Keep, of each key, the row that comes first in the order of arrival, whether the batch or the table has it.

    The columns that `arrival` sorts by are stored with the rows. As the least row of a union is the least of the least
    rows, the table does not depend on how its input was cut into batches, in which order these came, or how often one
    was repeated. One shuffle, ahead of which each task reduces a key to one row.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the merge key")
    spark = batch.sparkSession
    if not table_exists(spark, path):
        append_partitions(dedup_first(batch, keys, arrival), path, partition_by)
        return
    table = spark.read.parquet(path)
    both = touched_partitions(table, batch, partition_by).unionByName(batch.select(*table.columns))
    _writer(dedup_first(both, keys, arrival), partition_by, "overwrite", "dynamic", "snappy").save(path)


def delete_insert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    touches: DataFrame | None = None,
) -> None:
    """Delete the table's rows whose key the batch holds, then insert the whole batch.

    ``partition_by`` partitions the table and, where a key lies in one partition only
    (as a hash over the partition columns does), limits the rewrite to the partitions the
    batch touches. Without it the table is rewritten, which suits dimensions. ``touches``
    is a frame with at least the batch's partition values that is cheaper to read.
    """
    spark = batch.sparkSession
    if not table_exists(spark, path):
        overwrite_table(batch, path, partition_by)
        return
    table = spark.read.parquet(path)
    old = touched_partitions(table, batch if touches is None else touches, partition_by) if partition_by else table
    rows = batch.select(*table.columns).unionByName(_unmatched(old, batch, keys).select(*table.columns))
    if partition_by:
        _writer(rows, partition_by, "overwrite", "dynamic", "snappy").save(path)
    else:
        overwrite_table(rows, path)


def expire_partitions(spark: SparkSession, path: str, as_of: str, keep_days: int = 7, partition_by: Sequence[str] = spec.RAW_PARTITIONS) -> list[dict[str, str]]:
    """Drop whole partitions dated before ``as_of`` minus ``keep_days``."""
    cutoff = (date.fromisoformat(as_of) - timedelta(days=keep_days)).isoformat()
    return drop_partitions(spark, path, partition_by, lambda p: p[partition_by[0]] < cutoff)


def repartition_fact(spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = ("cycle_hour", "cycle_date")) -> bool:
    """Copy a fact into cycle_hour / cycle_date partitions; False if that was done before."""
    if table_exists(spark, target):
        return False
    append_partitions(spark.read.parquet(source), target, partition_by, codec="zstd")
    return True
