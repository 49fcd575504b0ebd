"""Column-level helpers built from Spark's built-in functions."""

from tablelab.functions.columns import (
    col_of,
    exact_avg,
    exact_sum,
    hash_uniform,
    instant_to_ntz,
    ntz_to_instant,
)

__all__ = [
    "col_of",
    "exact_avg",
    "exact_sum",
    "hash_uniform",
    "instant_to_ntz",
    "ntz_to_instant",
]
