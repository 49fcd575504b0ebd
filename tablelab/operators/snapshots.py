"""Versioned snapshot sets: immutable Parquet folders plus a commit log.

The log is itself a Parquet dataset (one tiny file per commit) read and written as
a DataFrame: generation, version, operation, dirs, schema_json, num_rows,
committed_at.  Data folders are never rewritten or deleted:

* ``commit(mode="overwrite")`` adds a version whose only folder is the new one;
  version numbers keep counting (an overwrite is not a reset).
* ``commit(mode="append")`` adds the new folder; a log entry holds its own folder only,
  and a version's folders are those since the last overwrite.  Columns are matched by the
  session's case rule and written under the table's names.  A column or nested field the
  table does not have, or a wider number type, is an error unless ``merge_schema``; then
  the schema grows and older rows read it as null, or widened.
* ``read(version)`` reads the folders of that version with the schema stored for
  it, so columns added later do not appear in older versions.
* ``reset()`` starts a new generation (history restarts at version 0); re-running
  a seeding script therefore always ends with the same history.  Nothing is deleted;
  ``unreferenced()`` lists the folders that no version of the history needs.

A single writer per table is assumed: there is no concurrent-commit protocol.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.operators.quality import drift_rows

LOG_SCHEMA = T.StructType(
    [
        T.StructField("generation", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("dirs", T.ArrayType(T.StringType())),
        T.StructField("schema_json", T.StringType()),
        T.StructField("num_rows", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)

_RESET = "reset"


class SchemaMismatch(ValueError):
    pass


class Snapshots:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log_path = f"{self.path}/_log"
        self._cache: list[dict] | None = None

    # --- log ---------------------------------------------------------------------

    def log(self) -> DataFrame:
        """The whole commit log (all generations), as a DataFrame."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.log_path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], LOG_SCHEMA)  # no commit yet
        return self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(self.log_path)

    def _entries(self) -> list[dict]:
        # The log grows with the number of commits, not with the data.  With a
        # single writer the copy read after our own last commit stays valid.
        if self._cache is None:
            rows = self.log().orderBy("generation", "version").collect()
            self._cache = [r.asDict() for r in rows]
        return self._cache

    def refresh(self) -> None:
        """Forget the cached log (after another process committed)."""
        self._cache = None

    def _state(self) -> tuple[int, dict | None]:
        entries = self._entries()
        if not entries:
            return 0, None
        gen = max(e["generation"] for e in entries)
        live = [e for e in entries if e["generation"] == gen and e["operation"] != _RESET]
        return gen, (live[-1] if live else None)

    def _append_log(self, gen: int, version: int, op: str, dirs: list[str], schema: T.StructType | None, n: int):
        row = (gen, version, op, dirs, schema.json() if schema else None, n, _dt.datetime.now(_dt.timezone.utc))
        entry = self.spark.createDataFrame([row], LOG_SCHEMA).coalesce(1)
        entry.write.mode("errorifexists").parquet(f"{self.log_path}/g{gen:06d}-v{version:06d}-{op}")
        if self._cache is not None:
            # Single writer: our own entry is the only change since the log was read.
            self._cache = self._cache + [dict(zip(LOG_SCHEMA.fieldNames(), row))]

    # --- writes --------------------------------------------------------------------

    def commit(self, df: DataFrame, mode: str = "append", merge_schema: bool = False) -> int:
        """Write ``df`` as a new version; returns the version number."""
        if mode not in ("append", "overwrite"):
            raise ValueError("mode must be append or overwrite")
        gen, last = self._state()
        version = 0 if last is None else last["version"] + 1
        folded = self.spark.conf.get("spark.sql.caseSensitive") != "true"
        if folded and len({c.lower() for c in df.columns}) < len(df.columns):
            raise SchemaMismatch("two columns differ in case alone")
        if last is None or mode == "overwrite":
            schema = df.schema
        else:
            schema = _merge(T.StructType.fromJson(json.loads(last["schema_json"])), df.schema, merge_schema, folded)
            named = {_key(f.name, folded): f.name for f in schema.fields}
            df = df.toDF(*[named[_key(c, folded)] for c in df.columns])
        folder = f"{self.path}/data/g{gen:06d}-v{version:06d}-{uuid.uuid4().hex[:8]}"
        # The row count is observed while writing: no second pass over the data.
        seen = Observation(f"commit-{uuid.uuid4().hex[:8]}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(folder)
        n = int(seen.get["rows"])
        self._append_log(gen, version, mode, [folder], schema, n)
        return version

    def reset(self) -> int:
        """Start a new generation; earlier data stays on disk but leaves the history."""
        gen, _ = self._state()
        self._append_log(gen + 1, -1, _RESET, [], None, 0)
        return gen + 1

    # --- reads ---------------------------------------------------------------------

    def _version(self, version: int | None) -> dict:
        gen, last = self._state()
        if last is None:
            raise ValueError("no versions")
        if version is None:
            return last
        for e in self._entries():
            if e["generation"] == gen and e["version"] == version:
                return e
        raise ValueError(f"no version {version}")

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._version(version)["schema_json"]))

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of ``version`` (latest when None), with that version's schema."""
        e = self._version(version)
        schema = T.StructType.fromJson(json.loads(e["schema_json"]))
        return self.spark.read.schema(schema).parquet(*self._dirs(e))

    def _dirs(self, entry: dict) -> list[str]:
        """The folders of a version: its own and those before it, back to the last overwrite."""
        out: list[str] = []
        for e in self._entries():
            if e["generation"] == entry["generation"] and e["operation"] != _RESET and e["version"] <= entry["version"]:
                out = (out if e["operation"] == "append" else []) + list(e["dirs"])
        return out

    def unreferenced(self) -> DataFrame:
        """Folders of earlier generations, which no version of the present history needs."""
        gen, _ = self._state()
        old = self.log().where((F.col("generation") < gen) & (F.col("operation") != _RESET))
        return old.select("generation", "version", F.explode("dirs").alias("folder"), "num_rows")

    def history(self) -> DataFrame:
        """One row per commit of the current generation: version, operation,
        num_rows, num_columns, committed_at."""
        gen, _ = self._state()
        h = self.log().where((F.col("generation") == gen) & (F.col("operation") != _RESET))
        ncols = F.size(F.from_json("schema_json", "struct<fields:array<string>>").getField("fields"))
        return h.select(
            "generation", "version", "operation", "num_rows", ncols.cast("long").alias("num_columns"), "committed_at"
        )

    def schema_diff(self, a: int, b: int) -> DataFrame:
        """column_name, change (added / removed / type_changed), from_type, to_type."""
        rows = []
        for r in drift_rows(self.schema(b), self.schema(a)):
            base, obs, status, bt, ot = r[0], r[1], r[2], r[3], r[4]
            if status == "missing":
                rows.append((base, "removed", bt, None))
            elif status == "extra":
                rows.append((obs, "added", None, ot))
            elif status == "type_changed":
                rows.append((base, "type_changed", bt, ot))
        return self.spark.createDataFrame(rows, "column_name string, change string, from_type string, to_type string")

    def changes(self, a: int, b: int) -> DataFrame:
        """Rows added and removed between versions a and b: ``change`` + the columns of
        both schemas (by name; absent ones null).  Duplicates are counted (multiset).

        When b only appended to a, the added rows are the new folders and nothing is
        compared; otherwise rows of b count 1 and rows of a -1, and one aggregate over all
        columns gives the difference.  Maps, at any depth, are compared by their entries and
        returned as they are.  A column whose types differ is returned as text.
        """
        ea, eb = self._version(a), self._version(b)
        sa, sb = self.schema(a), self.schema(b)
        cols = _union_columns(sa, sb)
        target = {c: _common_type(sa, sb, c) for c in cols}
        da, db = self._dirs(ea), self._dirs(eb)
        quoted = [F.col(f"`{c}`") for c in cols]
        if set(da) <= set(db):
            new = [d for d in db if d not in set(da)]
            rows = self.spark.read.schema(sb).parquet(*new) if new else self.read(b).limit(0)
            return _align(rows, cols, target).select(F.lit("added").alias("change"), *quoted)
        both = _align(self.read(b), cols, target).withColumn("__n", F.lit(1)).unionByName(
            _align(self.read(a), cols, target).withColumn("__n", F.lit(-1))
        )
        keys = [_orderable_form(F.col(f"`{c}`"), target[c]).alias(f"__k{i}") for i, c in enumerate(cols)]
        values = [F.first(F.col(f"`{c}`")).alias(c) for c in cols]
        net = both.groupBy(*keys).agg(F.sum("__n").alias("__n"), *values).where("__n <> 0")
        change = F.when(F.col("__n") > 0, F.lit("added")).otherwise(F.lit("removed"))
        # A row met often is repeated in two steps, so that no array holds all its repeats.
        last = F.abs("__n") - 1
        runs = net.select(change.alias("change"), *quoted, last.alias("__last"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / REPEATS).cast("long"))).alias("__run"))
        within = F.least(F.lit(REPEATS - 1), F.col("__last") - F.col("__run") * REPEATS)
        return runs.select("change", *quoted, F.explode(F.sequence(F.lit(0).cast("long"), within.cast("long"))).alias("__t")).drop("__t")


#: Repeats of a row that are made at once.
REPEATS = 1 << 18


#: Number types that hold every value of a narrower one, narrowest first.
_WIDER = [
    [T.ByteType, T.ShortType, T.IntegerType, T.LongType],
    [T.ByteType, T.ShortType, T.IntegerType, T.DoubleType],
    [T.FloatType, T.DoubleType],
]


def _key(name: str, folded: bool) -> str:
    return name.lower() if folded else name


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The wider of two number types, if one holds all values of the other."""
    for chain in _WIDER:
        if type(a) in chain and type(b) in chain:
            return a if chain.index(type(a)) >= chain.index(type(b)) else b
    return None


def _merge_type(name: str, old: T.DataType, new: T.DataType, merge: bool, folded: bool) -> T.DataType:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return _merge(old, new, merge, folded, f"{name}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_merge_type(f"{name}[]", old.elementType, new.elementType, merge, folded), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, _merge_type(f"{name}[]", old.valueType, new.valueType, merge, folded), True)
    if old == new:
        return old
    wide = _wider(old, new)
    # A narrower value fits a wider column as it is.
    if wide is not None and (merge or wide == old):
        return wide
    raise SchemaMismatch(f"column {name}: table has {old.simpleString()}, data has {new.simpleString()}")


def _merge(current: T.StructType, incoming: T.StructType, merge: bool, folded: bool, at: str = "") -> T.StructType:
    """The table's schema after an append: its own names and order, then what is new."""
    new = {_key(f.name, folded): f for f in incoming.fields}
    fields = []
    for f in current.fields:
        other = new.pop(_key(f.name, folded), None)
        kind = f.dataType if other is None else _merge_type(at + f.name, f.dataType, other.dataType, merge, folded)
        fields.append(T.StructField(f.name, kind, True))
    if new and not merge:
        raise SchemaMismatch("new columns " + ", ".join(at + f.name for f in new.values()) + "; pass merge_schema=True")
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in new.values()])


def _union_columns(a: T.StructType, b: T.StructType) -> list[str]:
    names = [f.name for f in a.fields]
    return names + [f.name for f in b.fields if f.name not in set(names)]


def _common_type(a: T.StructType, b: T.StructType, name: str) -> T.DataType:
    """The type both versions have, the wider of two numbers, or text."""
    types = [s[name].dataType for s in (a, b) if name in s.fieldNames()]
    if len(types) == 1 or types[0] == types[1]:
        return types[0]
    return _wider(*types) or T.StringType()


def _align(df: DataFrame, cols: list[str], target: dict[str, T.DataType]) -> DataFrame:
    """Columns ``cols`` in order and of the ``target`` types; a column the version lacks is a typed null."""
    out = []
    for c in cols:
        if c not in df.columns:
            out.append(F.lit(None).cast(target[c]).alias(c))
            continue
        have, value = df.schema[c].dataType, F.col(f"`{c}`")
        if have != target[c]:
            plain = isinstance(have, T.AtomicType)
            value = value.cast(target[c]) if plain else F.to_json(value)
        out.append(value.alias(c))
    return df.select(*out)


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return isinstance(t, T.MapType) or isinstance(t, T.ArrayType) and _has_map(t.elementType)


def _orderable_form(value: Column, t: T.DataType) -> Column:
    """A value that can be grouped by: maps become their entries, sorted by key."""
    if not _has_map(t):
        return value
    if isinstance(t, T.MapType):
        pairs = F.array_sort(F.map_keys(value))
        made = F.transform(pairs, lambda k: F.struct(k.alias("key"), _orderable_form(F.element_at(value, k), t.valueType).alias("value")))
        return F.when(value.isNotNull(), made)
    if isinstance(t, T.ArrayType):
        return F.transform(value, lambda x: _orderable_form(x, t.elementType))
    parts = [_orderable_form(value.getField(f.name), f.dataType).alias(f.name) for f in t.fields]
    return F.when(value.isNotNull(), F.struct(*parts))
