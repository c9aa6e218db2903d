"""Relational sinks and sources through Spark's JDBC connector.

These need a database the executors can reach, so no registered query uses them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_table(
    df: DataFrame, url: str, table: str, mode: str = "append", properties: dict[str, str] | None = None,
    connections: int | None = None, batch_rows: int = 10_000,
) -> None:
    """Write to a relational table; ``connections`` bounds the concurrent writers."""
    options = {"batchsize": str(batch_rows), **(properties or {})}
    if connections:
        options["numPartitions"] = str(connections)
    df.write.jdbc(url, table, mode=mode, properties=options)


def read_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
    split_on: str | None = None, bounds: tuple[str, str] | None = None, splits: int = 1,
) -> DataFrame:
    """Read a relational table, in ``splits`` ranges of ``split_on`` when bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    if split_on and bounds:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=str(splits)
        )
    return reader.load()
