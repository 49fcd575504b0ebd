"""Parquet footer audit and reading only the healthy files.

A corrupt file makes a whole Parquet scan fail (with a schema: at the action;
without: already at schema inference).  ``audit_parquet`` checks every file on
its own, in tasks, reading footers only, and reports path / ok / rows / reason;
``read_healthy`` then reads the good files and hands back the audit rows of the
skipped ones, so nothing is lost silently.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelab.session import scratch_dir
from tablelab.sources.io import escape_glob, list_files

MAGIC = b"PAR1"

AUDIT_SCHEMA = "path string, length long, ok boolean, num_rows long, num_row_groups int, reason string"


def _open(path: str):
    """Open a path as Spark lists it (``file:/x``, ``s3a://b/k``, ``hdfs://…``) with pyarrow."""
    from pyarrow import fs as pafs

    if path.startswith("file:"):
        local = path[5:]
        while local.startswith("//"):
            local = local[1:]
        return pafs.LocalFileSystem(), local
    uri = "s3://" + path[6:] if path.startswith("s3a://") else path
    return pafs.FileSystem.from_uri(uri)


def check_footer(path: str, length: int, pages: bool = False) -> tuple[bool, int | None, int | None, str | None]:
    """(ok, rows, row groups, reason) from the footer of one file; with ``pages`` every page is decoded too."""
    import pyarrow.parquet as pq

    try:
        fs, p = _open(path)
        with fs.open_input_file(p) as f:
            size = f.size()
            if size < 12:
                return False, None, None, f"file too small for parquet: {size} bytes"
            if f.read_at(4, 0) != MAGIC:
                return False, None, None, "missing leading magic bytes"
            tail = f.read_at(8, size - 8)
            if tail[4:] != MAGIC:
                return False, None, None, "missing trailing magic bytes"
            footer_len = int.from_bytes(tail[:4], "little")
            if footer_len > size - 12:
                return False, None, None, f"footer length {footer_len} exceeds file size {size}"
            parquet = pq.ParquetFile(f)
            meta = parquet.metadata
            if pages:
                try:
                    rows = sum(batch.num_rows for batch in parquet.iter_batches(batch_size=8192))
                except Exception as e:
                    return False, None, None, f"pages: {type(e).__name__}: {e}"
                if rows != meta.num_rows:
                    return False, None, None, f"pages hold {rows} rows, the footer says {meta.num_rows}"
            return True, int(meta.num_rows), int(meta.num_row_groups), None
    except Exception as e:  # any unreadable footer is a finding, not a crash
        return False, None, None, f"{type(e).__name__}: {e}"


def _audit_batches(batches: Iterator[pd.DataFrame], pages: bool) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = [(p, int(n), *check_footer(p, int(n), pages)) for p, n in zip(pdf["path"], pdf["length"])]
        yield pd.DataFrame(out, columns=["path", "length", "ok", "num_rows", "num_row_groups", "reason"]).astype(
            {"num_rows": "Int64", "num_row_groups": "Int32"}
        )


def audit_parquet(spark: SparkSession, root: str, glob: str | None = None, pages: bool = False) -> DataFrame:
    """path, length, ok, num_rows, num_row_groups, reason for every data file under ``root``.

    The listing is a ``binaryFile`` scan without content, so its partitions group
    files by size; each task opens only the footers of its own files (through
    pyarrow's file systems: local, HDFS, S3/``s3a``, GCS — executors need the same
    credentials as Spark).  A file that cannot be opened is reported with the error
    as its reason, never skipped.  ``pages`` also decodes every page, a few thousand
    rows at a time: it finds damage behind a whole footer, at the price of a full read.
    """
    files = list_files(spark, root, glob).select("path", "length")
    return files.mapInPandas(lambda batches: _audit_batches(batches, pages), AUDIT_SCHEMA)


def read_healthy(
    spark: SparkSession, root: str, schema, audit: DataFrame | None = None, glob: str | None = None, pages: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows of the healthy files, audit rows of the skipped files).

    By default the audit decodes every page, so that the read can't fail later; with
    ``pages=False`` footers alone decide.  The audit's result is written as a table; only
    the paths of the damaged files come to the driver, where they are left out of the
    file listing by a filter on the files' own paths, before anything is opened.
    """
    audit = audit if audit is not None else audit_parquet(spark, root, glob, pages)
    path = scratch_dir(spark, "parquet-audit")
    audit.write.parquet(path)
    skipped = spark.read.parquet(path).where(~F.col("ok"))
    damaged = [r["path"] for r in skipped.select("path").collect()]
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.parquet(escape_glob(root))
    if damaged:
        rows = rows.where(~F.col("_metadata.file_path").isin(damaged))
    return rows, skipped


def _wiped(data: bytes, at: int) -> bytes:
    """A Parquet file's bytes with everything from ``at`` up to the footer set to zero."""
    footer = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
    return data[:at] + bytes(max(0, footer - at)) + data[max(at, footer) :]


#: What can befall a file, by name: half written, its pages lost, its start lost.
DAMAGE = {
    "cut": lambda data: data[: len(data) // 2],
    "wiped": lambda data: _wiped(data, len(MAGIC)),
    "headless": lambda data: bytes(len(MAGIC)) + data[len(MAGIC) :],
}


def write_damaged(spark: SparkSession, healthy: str, path: str, kind: str) -> str:
    """Damaged copies, of a ``kind`` of ``DAMAGE``, of the Parquet files below ``healthy``, written to ``path``.

    Tasks read each file and write its copy through the file systems that the audit
    opens, so this works wherever the audit does."""
    files = list_files(spark, healthy, "*.parquet").select("path")
    place = path if ":" in path else f"file:{path}"
    fs, folder = _open(place)
    fs.create_dir(folder, recursive=True)

    def damage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for one in pdf["path"]:
                source, name = _open(one)
                with source.open_input_file(name) as f:
                    data = f.read()
                target, folder = _open(place)
                with target.open_output_stream(f"{folder}/{name.rsplit('/', 1)[-1]}") as f:
                    f.write(DAMAGE[kind](data))
            yield pdf

    files.mapInPandas(damage, "path string").write.format("noop").mode("overwrite").save()
    return path


def write_corrupt_parquet(spark: SparkSession, path: str, kind: str = "cut") -> str:
    """A damaged file of whole numbers below ``path``: written whole in scratch, then damaged."""
    whole = scratch_dir(spark, "whole")
    spark.range(1000).coalesce(1).write.parquet(whole)
    return write_damaged(spark, whole, path, kind)
