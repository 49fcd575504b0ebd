"""Column statistics of Parquet files: a zone map, checked against the decoded pages.

Readers skip row groups by the least and greatest value that a footer states for a column.  A
wrong statement loses rows without an error; zones that overlap skip nothing.  ``zone_map``
reads the footers into a table, ``check_zones`` decodes each column chunk on its own and compares,
``zone_overlap`` tells how many zones a value of a column lies in.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablelab.sources.io import list_files
from tablelab.sources.parquet_audit import _open

_ZONE = "path string, row_group int, column_name string, rows long, nulls long, min_value string, max_value string, low double, high double"
ZONE_SCHEMA = _ZONE + ", error string"
CHECK_SCHEMA = _ZONE + ", wrong string"


def _text(value) -> str | None:
    if value is None:
        return None
    return value.decode("utf-8", "backslashreplace") if isinstance(value, bytes) else str(value)


def _number(value) -> float | None:
    """A value's place on a line, where it has one: numbers, dates and times (seconds since 1970)."""
    if isinstance(value, bool) or isinstance(value, (int, float, decimal.Decimal)):
        return float(value)
    if isinstance(value, dt.datetime):
        return (value.replace(tzinfo=None) - dt.datetime(1970, 1, 1)).total_seconds()
    if isinstance(value, dt.date):
        return (value - dt.date(1970, 1, 1)).days * 86400.0
    return None


def _stated(meta, g: int, c: int) -> tuple:
    """(rows, nulls, least, greatest) as a footer states them; None where it doesn't."""
    chunk = meta.row_group(g).column(c)
    s = chunk.statistics
    known = s is not None and s.has_min_max
    return chunk.num_values, (s.null_count if s is not None and s.has_null_count else None), *((s.min, s.max) if known else (None, None))


def _zones(path: str, decode: bool) -> Iterator[tuple]:
    import pyarrow.parquet as pq

    fs, p = _open(path)
    with fs.open_input_file(p) as f:
        parquet = pq.ParquetFile(f)
        meta = parquet.metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                name = meta.schema.column(c).path
                rows, nulls, least, most = _stated(meta, g, c)
                row = (path, g, name, rows, nulls, _text(least), _text(most), _number(least), _number(most))
                yield (*row, _compare(parquet, g, name, rows, nulls, least, most) if decode else None)


def _compare(parquet, g: int, name: str, rows: int, nulls: int | None, least, most) -> str | None:
    """What a footer says wrongly of a column chunk; None if nothing.  One chunk is decoded at a time."""
    if "." in name:
        return None  # a leaf of a nested column: its values aren't rows
    values = parquet.read_row_group(g, columns=[name]).column(0)
    if len(values) != rows:
        return f"{len(values)} values, not {rows}"
    if nulls is not None and values.null_count != nulls:
        return f"{values.null_count} nulls, not {nulls}"
    if least is None or values.null_count == len(values):
        return None
    if pa.types.is_dictionary(values.type):
        values = values.cast(values.type.value_type)
    if pa.types.is_floating(values.type):
        values = values.filter(pc.invert(pc.is_nan(values)))  # NaN is in no statistics
    real = pc.min_max(values).as_py()
    # Bounds of long texts may be cut: a zone may be wider than its values, never narrower.
    if real["min"] is not None and (real["min"] < least or real["max"] > most):
        return f"values from {_text(real['min'])} to {_text(real['max'])}, not {_text(least)} to {_text(most)}"
    return None


def _scan(spark: SparkSession, root: str, glob: str | None, decode: bool, schema: str) -> DataFrame:
    columns = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                try:
                    rows = list(_zones(path, decode))
                except Exception as e:  # an unreadable file is a finding, not a crash
                    rows = [(path, *[None] * 8, f"{type(e).__name__}: {e}")]
                out = pd.DataFrame(rows, columns=columns)
                yield out.astype({"row_group": "Int32", "rows": "Int64", "nulls": "Int64", "low": "Float64", "high": "Float64"})

    return list_files(spark, root, glob or "*.parquet").select("path").mapInPandas(run, schema)


def zone_map(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """A row per file, row group and column from the footers alone: ``rows, nulls, min_value, max_value``
    as stated (null where a footer says nothing), ``low`` and ``high`` as numbers for numbers,
    dates and times, and ``error`` for a file that can't be read."""
    return _scan(spark, root, glob, False, ZONE_SCHEMA)


def check_zones(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """The zone map with ``wrong``: how a column's decoded values contradict its footer, else null.

    A zone narrower than its values, or another count of nulls, is wrong: a reader would skip
    rows that match.  Tasks decode one column of one row group at a time.  Leaves of
    nested columns aren't compared; a file that can't be read is one row with the error in ``wrong``."""
    return _scan(spark, root, glob, True, CHECK_SCHEMA)


def zone_overlap(zones: DataFrame) -> DataFrame:
    """``column_name, zones, depth, mean_depth``: in how many zones a value lies at most, and on average by rows.

    1 is a table sorted by the column; the number of zones is one that no filter can prune.
    Zones without ``low`` aren't counted.  The sweep runs over a column's zone ends, two a row
    group; zones are merged at equal ends first."""
    known = zones.where("low is not null")
    ends = known.select("column_name", F.inline(F.array(
        F.struct(F.col("low").alias("at"), F.lit(0).alias("side"), F.lit(1).alias("step")),
        F.struct(F.col("high").alias("at"), F.lit(1).alias("side"), F.lit(-1).alias("step")),
    ))).groupBy("column_name", "at", "side").agg(F.sum("step").alias("step"))
    sweep = Window.partitionBy("column_name").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    depth = ends.withColumn("open", F.sum("step").over(sweep)).groupBy("column_name").agg(F.max("open").alias("depth"))
    # How many zones a zone meets: those that begin by its end, less those that ended before it began.
    upto = Window.partitionBy("column_name").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    marks = known.select("column_name", "rows", F.col("low"), F.col("high"))
    points = marks.select("column_name", "rows", F.inline(F.array(
        F.struct(F.col("low").alias("at"), F.lit(0).alias("side"), F.lit(1).alias("begun"), F.lit(0).alias("ended")),
        F.struct(F.col("high").alias("at"), F.lit(1).alias("side"), F.lit(0).alias("begun"), F.lit(1).alias("ended")),
    ))).groupBy("column_name", "at", "side").agg(
        F.sum("begun").alias("begun"), F.sum("ended").alias("ended"), F.sum(F.when(F.col("begun") == 1, F.col("rows"))).alias("from_rows"),
        F.sum(F.when(F.col("ended") == 1, F.col("rows"))).alias("to_rows"),
    )
    # Weighted by rows: sum over zones of (begun by its end) minus (ended before its start).
    counted = points.withColumn("b", F.sum("begun").over(upto)).withColumn("e", F.sum("ended").over(upto) - F.col("ended"))
    met = counted.groupBy("column_name").agg(
        F.sum(F.when(F.col("side") == 1, F.col("b") * F.col("to_rows")).otherwise(-F.col("e") * F.col("from_rows"))).alias("met"),
    )
    every = known.groupBy("column_name").agg(F.count(F.lit(1)).alias("zones"), F.sum("rows").alias("rows"))
    return every.join(depth, "column_name").join(met, "column_name").select(
        "column_name", "zones", "depth", F.when(F.col("rows") > 0, F.col("met") / F.col("rows")).alias("mean_depth")
    )
