"""Scalar column expressions.

Metrics are 32-bit floats end to end. Spark widens ``float - 273.15`` to double, so every
unit conversion here keeps both operands FLOAT.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# 0 degrees Celsius in kelvin; scale of the fixed-point coordinates.
FREEZING_KELVIN = 273.15
INDEX_SCALE = 1000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_float(c: Column | str) -> Column:
    return _col(c).cast("float")


def celsius(kelvin: Column | str) -> Column:
    return as_float(kelvin) - F.lit(FREEZING_KELVIN).cast("float")


def hectopascal(pascal: Column | str) -> Column:
    # Spark divides in double; rounding the quotient to float equals a float division.
    return (as_float(pascal) / F.lit(100.0)).cast("float")


def millimetre(metre: Column | str) -> Column:
    return as_float(metre) * F.lit(1000.0).cast("float")


def round_half_away(x: Column) -> Column:
    """Nearest whole double, ties away from zero.

    Same as ``round`` on a double, which goes through a decimal object per row; ``rint``
    (ties to even) is one instruction, and only exact ties differ.
    """
    even = F.rint(x)
    return F.when(F.abs(x - even) == 0.5, x + F.signum(x) * 0.5).otherwise(even)


def grid_index(degrees: Column | str, shift: int) -> Column:
    """Fixed-point index of a coordinate, half away from zero; -1 if it has none."""
    scaled = (_col(degrees) + F.lit(shift)) * F.lit(INDEX_SCALE)
    return F.coalesce(round_half_away(scaled).try_cast("int"), F.lit(-1))


def grid_index_f32(degrees: Column | str, shift: int) -> Column:
    """Fixed-point index as ingest makes it: in 32-bit floats, half to even."""
    shifted = as_float(degrees) + F.lit(shift).cast("float")
    return F.rint(shifted * F.lit(INDEX_SCALE).cast("float")).try_cast("int")


def wrap_longitude(degrees: Column | str) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(_col(degrees) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def quarter_degree(degrees: Column | str) -> Column:
    """Nearest multiple of 0.25, half to even."""
    return F.rint(_col(degrees) * F.lit(4.0)) / F.lit(4.0)


def cycle_number(date: Column | str, hour: Column | str) -> Column:
    """Start of a forecast cycle in whole hours since 1970-01-01, for ordering cycles."""
    return F.unix_date(_col(date)) * 24 + _col(hour)


def hours(n: Column | str) -> Column:
    """A whole number of hours as an interval."""
    return F.expr("INTERVAL '1' HOUR") * _col(n)


def hash_key(columns: Iterable[str]) -> Column:
    """MD5 of the columns' text joined by dashes; NULL parts are left out."""
    return F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in columns]))


def is_missing(c: Column | str, data_type: str) -> Column:
    """NULL, or NaN where the type has one."""
    missing = _col(c).isNull()
    return missing | F.isnan(_col(c)) if data_type in ("float", "double") else missing


def expand(values: Iterable) -> Column:
    """One row per value of a short fixed list; the list is part of the plan, not a join."""
    return F.explode(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]))
