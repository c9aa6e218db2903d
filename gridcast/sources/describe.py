"""Column types of a source in the vocabulary of a relational target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Relational type for each source type; what is not listed becomes text.
RELATIONAL_TYPES = {
    "boolean": "bool",
    "bigint": "int8",
    "int": "int4",
    "smallint": "int2",
    "tinyint": "int2",
    "float": "float4",
    "double": "float8",
    "date": "date",
    "timestamp": "timestamptz",
    "timestamp_ntz": "timestamp",
    "string": "text",
    "binary": "bytea",
}


def relational_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.ArrayType):
        return relational_type(data_type.elementType) + "[]"
    if isinstance(data_type, T.DecimalType):
        return f"numeric({data_type.precision},{data_type.scale})"
    return RELATIONAL_TYPES.get(data_type.simpleString(), "text")


def relational_columns(df: DataFrame) -> dict[str, str]:
    """Target type by lower-case column name, from the schema alone."""
    return {f.name.lower(): relational_type(f.dataType) for f in df.schema}


def describe(df: DataFrame, table: str) -> DataFrame:
    """One row per column: types on both sides and how many rows hold a value (one scan)."""
    counts = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in df.schema])
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(f.name.lower()).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("source_type"),
                F.lit(relational_type(f.dataType)).alias("target_type"),
                F.col(f.name).alias("rows_with_value"),
            )
            for f in df.schema
        ]
    )
    return counts.select(F.inline(rows))
