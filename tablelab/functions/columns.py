"""Column expressions shared by the operators.  All are built-in Spark functions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAX_HASH_BITS = 53  # doubles hold 53 mantissa bits exactly


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_uniform(*cols: str | Column, seed: int = 42) -> Column:
    """A value in [0, 1) derived from a hash of the given columns.

    Replaces ``rand()``: the value depends only on the row, so a retried task
    produces the same numbers (``rand()`` would not).
    """
    h = F.xxhash64(*[col_of(c) for c in cols], F.lit(seed))
    bits = F.shiftrightunsigned(h, 64 - _MAX_HASH_BITS)
    return bits.cast("double") / F.lit(float(1 << _MAX_HASH_BITS))


def exact_sum(c: str | Column, scale: int = 2) -> Column:
    """Order-independent sum of a double column at a fixed decimal ``scale``.

    Double addition depends on the order of the rows; decimal addition does not, so
    the result is the same on every run and in every engine.  The sum is kept as
    ``decimal(38, scale)`` (exact up to 10^(38-scale)) and returned as double.  A
    ``bigint`` sum of scaled units would be faster but overflows at 100 TB scale
    (a TPC-H-like price column alone reaches ~2e18 cents), so it is not used.
    """
    return F.sum(col_of(c).cast(f"decimal(38,{scale})")).cast("double")


def exact_avg(c: str | Column, scale: int = 2) -> Column:
    """Average as exact decimal sum divided by the count (a double division)."""
    return exact_sum(c, scale) / F.count(col_of(c)).cast("double")


def ntz_to_instant(c: str | Column) -> Column:
    """Read a ``timestamp_ntz`` wall-clock as UTC and return a ``timestamp``.

    Streaming watermarks need ``timestamp``; going through UTC makes windows
    independent of the session time zone.
    """
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), col_of(c).cast("timestamp_ntz")).cast("timestamp")


def instant_to_ntz(c: str | Column) -> Column:
    """Inverse of :func:`ntz_to_instant`: a ``timestamp`` as a UTC wall-clock ``timestamp_ntz``."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col_of(c).cast("timestamp_ntz"))
