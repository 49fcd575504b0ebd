"""Types of untyped data by a mergeable lattice, in one pass.

Every value has a mask of the types it fits; the types that fit a whole column are the
bitwise AND of its masks.  AND is associative, commutative and has a neutral element (a
null fits all), so a column's types are an ordinary partial aggregate: tasks send a row per
column, whatever the data, and parts that were inferred apart merge the same way.  The
same aggregate counts, for every type, the values that fit and keeps one that doesn't, so
a column that is a number but for a few entries is reported as such.

``csv_cells`` and ``json_cells`` bring lines into the shape ``(column_name, mask, value)``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.operators.quality import as_struct, ddl

#: Types from narrow to wide, a bit each; the narrowest that fits all values is the column's.
TYPES = ("boolean", "bigint", "double", "date", "timestamp_ntz", "string", "object", "array")
BIT = {t: 1 << k for k, t in enumerate(TYPES)}
EVERY = (1 << len(TYPES)) - 1
#: The type of a column that no type fits: some of its values are text, others objects or arrays.
MIXED = "variant"
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?$"


def _bits(fits: Mapping[str, Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(c, F.lit(BIT[t])).otherwise(F.lit(0)) for t, c in fits.items()])


def text_mask(text: Column, numbers: bool = True) -> Column:
    """The types a text fits; null fits all, the empty text only ``string``.

    ``numbers``: also numbers and booleans written as text, as in CSV."""
    fits = {
        "date": text.rlike(_DATE) & text.try_cast("date").isNotNull(),
        "timestamp_ntz": text.rlike(_TIME) & text.try_cast("timestamp_ntz").isNotNull(),
        "string": F.lit(True),
    }
    if numbers:
        fits["boolean"] = F.lower(text).isin("true", "false")
        fits["bigint"] = text.rlike(_WHOLE) & text.try_cast("bigint").isNotNull()
        fits["double"] = text.rlike(_NUMBER)
    return F.when(text.isNull(), F.lit(EVERY)).otherwise(_bits(fits))


def variant_mask(value: Column) -> Column:
    """The types a variant fits: a number fits text too, an object or array only itself."""
    kind = F.schema_of_variant(value)
    number = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    of = lambda *types: F.lit(sum(BIT[t] for t in types))
    return (
        F.when(F.coalesce(kind, F.lit("VOID")) == "VOID", F.lit(EVERY))
        .when(kind == "BOOLEAN", of("boolean", "string"))
        .when(kind == "BIGINT", of("bigint", "double", "string"))
        .when(number, of("double", "string"))
        .when(kind.startswith("OBJECT"), of("object"))
        .when(kind.startswith("ARRAY"), of("array"))
        .otherwise(text_mask(F.try_variant_get(value, "$", "string"), numbers=False))
    )


def csv_cells(lines: DataFrame, header: str, sep: str = ",", quote: str = '"', escape: str = "\\") -> DataFrame:
    """Lines or records (``value``) under ``header`` to ``(column_name, mask, value)``.

    Empty values are null; fields beyond the header go, missing ones are null; blank lines and the
    header itself are no rows.  Names of the header may repeat and then share a report."""
    names = [x.strip().strip(quote) for x in header.split(sep)]
    shape = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
    rows = lines.where((F.trim("value") != "") & (F.col("value") != F.lit(header)))
    parsed = rows.select(F.from_csv("value", ddl(shape), {"sep": sep, "quote": quote, "escape": escape, "mode": "PERMISSIVE"}).alias("r"))
    cells = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"r.c{k}").alias("value")) for k, n in enumerate(names)])
    each = parsed.select(F.inline(cells))
    return each.select("column_name", text_mask(F.col("value")).alias("mask"), "value")


def json_cells(lines: DataFrame, depth: int = 1) -> DataFrame:
    """JSON lines (``value``) to ``(column_name, mask, value)``, a row for every field of every object.

    Fields of nested objects follow as ``outer.inner``, ``depth`` levels in all.  Lines that
    are no objects have no cells (``quality.tag_json`` reports them)."""
    spark = lines.sparkSession
    level = lines.select(F.try_parse_json("value").alias("v"), F.lit("").alias("path"))
    out = None
    for _ in range(depth):
        level = level.where(F.schema_of_variant("v").startswith("OBJECT"))
        fields = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
            F.concat("path", "key").alias("column_name"), F.col("value").alias("v")
        )
        cells = fields.select("column_name", variant_mask(F.col("v")).alias("mask"), F.to_json("v").alias("value"))
        cells = cells.withColumn("value", F.when(F.col("value") != "null", F.col("value")))
        out = cells if out is None else out.unionByName(cells)
        level = fields.select("v", F.concat("column_name", F.lit(".")).alias("path"))
    return out


def lattice(cells: DataFrame) -> DataFrame:
    """``(column_name, mask, value)`` to one mergeable row per column: ``mask``, ``n`` (values that
    aren't null), ``nulls``, and per type ``fits`` (count) and ``misfit`` (the least value that doesn't fit)."""
    real = F.col("value").isNotNull()
    fit = lambda t: F.col("mask").bitwiseAND(F.lit(BIT[t])) != 0
    return cells.groupBy("column_name").agg(
        F.bit_and("mask").alias("mask"), F.count_if(real).alias("n"), F.count_if(~real).alias("nulls"),
        F.struct(*[F.count_if(real & fit(t)).alias(t) for t in TYPES]).alias("fits"),
        F.struct(*[F.min(F.when(real & ~fit(t), F.col("value"))).alias(t) for t in TYPES]).alias("misfit"),
    )


def merge(*parts: DataFrame) -> DataFrame:
    """Rows of ``lattice`` made apart (by day, by file) as one, without the data."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("column_name").agg(
        F.bit_and("mask").alias("mask"), F.sum("n").alias("n"), F.sum("nulls").alias("nulls"),
        F.struct(*[F.sum(f"fits.{t}").alias(t) for t in TYPES]).alias("fits"),
        F.struct(*[F.min(f"misfit.{t}").alias(t) for t in TYPES]).alias("misfit"),
    )


def types_of(found: DataFrame, share: float = 0.9) -> DataFrame:
    """Rows of ``lattice`` to ``(column_name, type, n, nulls, mostly, misfits, example)``.

    ``type``: the narrowest that fits every value (``void`` without any, ``variant`` if
    none does).  ``mostly``: a narrower one that ``share`` of the values fit, or null;
    ``misfits`` don't, for instance ``example``."""
    pick = lambda ok: F.coalesce(*[F.when(ok(t), F.lit(t)) for t in TYPES])
    fitting = pick(lambda t: F.col("mask").bitwiseAND(F.lit(BIT[t])) != 0)
    kind = F.when(F.col("n") == 0, F.lit("void")).otherwise(F.coalesce(fitting, F.lit(MIXED)))
    mostly = pick(lambda t: (F.col(f"fits.{t}") >= share * F.col("n")) & (F.col("n") > 0))
    typed = found.withColumns({"type": kind, "mostly": mostly}).withColumn("mostly", F.when(F.col("mostly") != F.col("type"), F.col("mostly")))
    of = lambda name: F.coalesce(*[F.when(F.col("mostly") == t, F.col(f"{name}.{t}")) for t in TYPES])
    return typed.select("column_name", "type", "n", "nulls", "mostly", (F.col("n") - of("fits")).alias("misfits"), of("misfit").alias("example"))


def infer_types(cells: DataFrame, share: float = 0.9) -> DataFrame:
    """``types_of`` the ``lattice`` of cells: the types of an untyped source in one pass."""
    return types_of(lattice(cells), share)


def inferred_schema(types: DataFrame, order: list[str] | None = None) -> T.StructType:
    """Rows of ``types_of`` as a schema, a field per column, for ``quality.schema_drift``.

    Objects, arrays and mixed columns are ``variant``, columns without values ``string``;
    ``order`` gives the fields' places, else they go by name."""
    plain = {"object": "variant", "array": "variant", "void": "string"}
    found = {r["column_name"]: plain.get(r["type"], r["type"]) for r in types.select("column_name", "type").collect()}
    names = [n for n in (order or sorted(found)) if n in found]
    return as_struct(", ".join("`" + n.replace("`", "``") + f"` {found[n]}" for n in names)) if names else T.StructType()
