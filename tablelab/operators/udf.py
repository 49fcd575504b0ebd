"""Python functions over DataFrames without the usual failures.

* ``map_vectorized``: Arrow batches through ``mapInPandas``.  A resource that
  cannot be pickled (a client, a model, a compiled pattern) is built by ``setup()``
  inside each task, once, and never captured in the closure.
* ``map_catching``: a function of one row, called on plain dictionaries; a row whose
  call raises becomes an error row (input as JSON, exception class and message)
  instead of failing the job.  A vectorised twin may be given for whole batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ERROR_FIELDS = [
    T.StructField("__ok", T.BooleanType()),
    T.StructField("__input", T.StringType()),
    T.StructField("__error_class", T.StringType()),
    T.StructField("__error_message", T.StringType()),
]


def _schema(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, str):
        st = T._parse_datatype_string(schema)
        if not isinstance(st, T.StructType):
            raise ValueError("schema must be a struct")
        return st
    return schema


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows out anew if the caller asks for so many partitions; else as they are."""
    return df.repartition(partitions) if partitions and not df.isStreaming else df


def map_vectorized(
    df: DataFrame,
    fn: Callable[[pd.DataFrame, Any], pd.DataFrame],
    schema: T.StructType | str,
    setup: Callable[[], Any] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``fn(batch, resource) -> DataFrame`` on Arrow batches; ``resource = setup()``
    is created once per task, inside the task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup() if setup is not None else None
        for pdf in batches:
            yield fn(pdf, resource)

    return spread(df, partitions).mapInPandas(run, _schema(schema))


def map_catching(
    df: DataFrame,
    fn: Callable[[dict, Any], dict | Iterable[dict] | None],
    schema: T.StructType | str,
    setup: Callable[[], Any] | None = None,
    batch_fn: Callable[[pa.RecordBatch, Any], pa.RecordBatch] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``fn(row, resource)`` for every row; rows whose call raises come back as error rows.

    ``row`` is a dictionary of plain Python values; the result is a dictionary of the
    ``schema``'s columns, several of them, or None for none.  ``batch_fn`` does the same
    for a whole Arrow batch; where it raises, the batch goes row by row.  A result that
    doesn't fit the schema counts as raised.

    Output: the ``schema`` columns plus ``__ok``, ``__input``, ``__error_class``,
    ``__error_message``; use :func:`split_errors` for (ok, errors).  ``__input`` is the
    row as JSON, made by Spark before Python sees it: doubles, whole numbers and
    microseconds are exact, binary is base 64, nulls are kept.
    """
    st = _schema(schema)
    out_schema = T.StructType(st.fields + ERROR_FIELDS)
    names = [f.name for f in st.fields]
    fields = list(to_arrow_schema(st))
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    options = {"ignoreNullFields": "false", "timestampFormat": stamp + "XXX", "timestampNTZFormat": stamp}
    row_json = "__input"
    while row_json in df.columns:
        row_json = "_" + row_json
    as_json = df.withColumn(row_json, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options))

    # Python sees plain names for columns: some of Spark's calls read a dot as a path.
    given = df.columns
    as_json = as_json.toDF(*[f"c{i}" for i in range(len(given))], "json")

    def finished(columns: list, n: int, ok: bool, inputs: list, kinds: list, messages: list) -> pa.RecordBatch:
        strings = [pa.array(x, pa.string()) for x in (inputs, kinds, messages)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([ok] * n, pa.bool_()), *strings], [*names, *[f.name for f in ERROR_FIELDS]]
        )

    def good(columns: list) -> pa.RecordBatch:
        n = len(columns[0]) if columns else 0
        return finished(columns, n, True, [None] * n, [None] * n, [None] * n)

    def row_by_row(batch: pa.RecordBatch, inputs: pa.Array, resource: Any) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in names]
        failed: list[tuple[str, Exception]] = []
        for k, row in enumerate(batch.to_pylist()):
            try:
                res = fn(row, resource)
                made = [] if res is None else [res] if isinstance(res, dict) else list(res)
                # Converted row by row only if the whole doesn't convert.
                values = [[m[n] for n in names] for m in made]
            except Exception as e:
                failed.append((inputs[k].as_py(), e))
                continue
            for one in values:
                for column, v in zip(columns, one, strict=True):
                    column.append((v, k))
        arrays = None
        try:
            arrays = [pa.array([v for v, _ in c], f.type) for c, f in zip(columns, fields, strict=True)]
        except (pa.ArrowInvalid, pa.ArrowTypeError, pa.ArrowNotImplementedError, OverflowError):
            bad: dict[int, Exception] = {}
            for c, f in zip(columns, fields, strict=True):
                for v, k in c:
                    try:
                        pa.scalar(v, f.type)
                    except Exception as e:
                        bad[k] = e
            failed += [(inputs[k].as_py(), e) for k, e in bad.items()]
            arrays = [pa.array([v for v, k in c if k not in bad], f.type) for c, f in zip(columns, fields, strict=True)]
        yield good(arrays)
        if failed:
            nulls = [pa.nulls(len(failed), f.type) for f in fields]
            yield finished(
                nulls, len(failed), False, [i for i, _ in failed], [type(e).__name__ for _, e in failed], [str(e) for _, e in failed]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resource = setup() if setup is not None else None
        for whole in batches:
            inputs = whole.column(len(given))
            batch = pa.RecordBatch.from_arrays(whole.columns[:-1], given)
            if batch_fn is not None:
                try:
                    made = batch_fn(batch, resource)
                    yield good([made.column(f.name).cast(f.type) for f in fields])
                    continue
                except Exception:  # its rows tell which of them fail
                    pass
            yield from row_by_row(batch, inputs, resource)

    return spread(as_json, partitions).mapInArrow(run, out_schema)


def split_errors(result: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok rows with the declared columns, error rows: input, error_class, error_message)."""
    data_cols = [c for c in result.columns if not c.startswith("__")]
    ok = result.where(F.col("__ok")).select(*data_cols)
    errors = result.where(~F.col("__ok")).select(
        F.col("__input").alias("input"),
        F.col("__error_class").alias("error_class"),
        F.col("__error_message").alias("error_message"),
    )
    return ok, errors
