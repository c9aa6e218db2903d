"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins whose build side turns out small per task skip the sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Counts come from footers where a table is read through sources.footers.
    "spark.sql.parquet.aggregatePushdown": "true",
}

_own_shared: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on (UTC times, AQE)."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "gridcast", memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    partitions = cpus if str(cpus).isdigit() else 8
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Where ``spark.checkpoint.dir`` is unset, a session on a single machine (as in tests) uses
    a folder of its own. On a cluster that folder would be another one on every executor, so
    there it is an error.
    """
    global _own_shared
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    if _own_shared is None:
        _own_shared = tempfile.mkdtemp(prefix="gridcast-")
    return _own_shared


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return f"{shared_dir(spark)}/gridcast/{name}-{uuid.uuid4().hex}"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, (list, tuple)):
        return f"array({', '.join(map(_literal, value))})"
    return f"{value!r}D" if isinstance(value, float) else str(value).lower()


def literal_table(spark: SparkSession, columns: Iterable[str], rows: Iterable[tuple]) -> DataFrame:
    """A small fixed table as part of the plan, so that Spark knows its size."""
    values = ", ".join(f"({', '.join(map(_literal, row))})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
