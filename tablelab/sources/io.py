"""Parquet and catalog I/O, unions, SQL over a DataFrame, and file inventories."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.session import scratch_dir


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Read Parquet with an explicit schema when given (no inference, no footer merge)."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    max_records_per_file: int | None = None,
) -> str:
    """Write Parquet (overwrite by default)."""
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def roundtrip_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write then read back with the written schema: partition values keep their type
    (no inference turning "01" into 1) and columns keep the caller's order.

    A folder name can't tell an empty string from null, so the files hold the partition
    columns too and folders are named after copies of them."""
    copies = {f"_part_{c}": F.col(f"`{c}`") for c in partition_by or ()}
    write_parquet(df.withColumns(copies) if copies else df, path, partition_by=list(copies))
    return read_parquet(df.sparkSession, path, df.schema).select(*[F.col(f"`{c}`") for c in df.columns])


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union keeping duplicates, matching columns by name (never by position).

    With ``allow_missing`` a column absent from one input is null there.
    """
    if not dfs:
        raise ValueError("nothing to union")
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out


def sql_count(spark: SparkSession, df: DataFrame, predicate: str, alias: str = "cnt") -> DataFrame:
    """``SELECT COUNT(*) … WHERE predicate`` over a DataFrame, without a global view."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", alias):
        raise ValueError("bad alias")
    return spark.sql(f"SELECT COUNT(*) AS {alias} FROM {{t}} WHERE {predicate}", t=df)


def save_table(df: DataFrame, name: str, database: str | None = None, mode: str = "overwrite", location: str | None = None) -> int:
    """Write ``df`` as a managed table, creating the database if need be; returns the rows
    written, counted during the write.  ``location`` is where a new database keeps its tables."""
    spark = df.sparkSession
    if database:
        at = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    seen = Observation(f"save-{uuid.uuid4().hex[:8]}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).saveAsTable(qualified(name, database))
    return int(seen.get["rows"])


def qualified(name: str, database: str | None = None) -> str:
    return f"`{database}`.`{name}`" if database else f"`{name}`"


def drop_table(spark: SparkSession, name: str, database: str | None = None, with_database: bool = False) -> None:
    """Drop a table if it exists and, if asked, its database with whatever else is in it."""
    spark.sql(f"DROP TABLE IF EXISTS {qualified(name, database)}")
    if with_database and database:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def catalog_roundtrip(spark: SparkSession, df: DataFrame, table_name: str = "t") -> DataFrame:
    """Save ``df`` as a table of a fresh database, count it with SQL, drop both.

    ``rows_written`` is counted while writing, ``rows_read`` by a query over the table.
    The database gets a unique name and a fresh folder in the shared scratch space;
    dropping happens in ``finally`` so a failed run leaves no catalog entry behind.
    """
    db = f"tablelab_{uuid.uuid4().hex[:10]}"
    try:
        written = save_table(df, table_name, db, location=scratch_dir(spark, db))
        read = spark.sql(f"SELECT COUNT(*) AS cnt FROM {qualified(table_name, db)}").first()["cnt"]
    finally:
        drop_table(spark, table_name, db, with_database=True)
    return spark.createDataFrame([(table_name, written, read)], "table_name string, rows_written long, rows_read long")


def escape_glob(path: str) -> str:
    """A path whose brackets, braces, stars and question marks stand for themselves."""
    return re.sub(r"([\[\]{}*?])", r"\\\1", path)


def list_files(spark: SparkSession, root: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """path, name, length, modified for the files under ``root``; contents are never read.

    ``binaryFile`` prunes its ``content`` column when it is not selected, so this is
    a pure listing, distributed over the file index.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(escape_glob(root))
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def file_rows(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """file_path, file_name, rows of the Parquet files under ``root``, whatever their columns, in one scan.

    No column of theirs is asked for, so footers alone are read."""
    r = spark.read.schema("`__none` string").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.parquet(escape_glob(root)).select("_metadata.file_path", "_metadata.file_name")
    return files.groupBy("file_path", "file_name").agg(F.count(F.lit(1)).alias("rows"))


def file_inventory(spark: SparkSession, root: str, expected: Sequence[str], glob: str | None = None) -> DataFrame:
    """Which of the ``expected`` file names exist under ``root``: name, present, length.

    The expected list comes from the caller (bounded); the listing is joined to it,
    so a missing file is a row with ``present = false`` instead of an exception.
    """
    exp = spark.createDataFrame([(n,) for n in expected], "name string")
    files = list_files(spark, root, glob).select("name", "length")
    found = files.groupBy("name").agg(F.count(F.lit(1)).alias("copies"), F.sum("length").alias("length"))
    return exp.join(found, "name", "left").select(
        "name", F.col("copies").isNotNull().alias("present"), F.coalesce("copies", F.lit(0)).alias("copies"), "length"
    )
