"""Column expressions shared by the operators. All are built-in Spark functions."""

from gridcast.functions.columns import (
    as_float,
    celsius,
    cycle_number,
    expand,
    grid_index,
    grid_index_f32,
    hash_key,
    hectopascal,
    hours,
    is_missing,
    millimetre,
    quarter_degree,
    round_half_away,
    wrap_longitude,
)

__all__ = [
    "as_float",
    "celsius",
    "cycle_number",
    "expand",
    "grid_index",
    "grid_index_f32",
    "hash_key",
    "hectopascal",
    "hours",
    "is_missing",
    "millimetre",
    "quarter_degree",
    "round_half_away",
    "wrap_longitude",
]
