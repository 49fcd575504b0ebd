"""Quarantine of malformed CSV / JSON lines, schema drift and reconciliation.

Input is always a DataFrame of text lines (``value`` column), e.g. from
``spark.read.text`` or a stream.  Parsing is ``from_csv`` / ``from_json`` in
PERMISSIVE mode with a corrupt-record column: a line is bad iff Spark flags it
(CSV also: an odd number of quote characters, which Spark accepts in the last
field), and the reason is a label computed on top.  ``DROPMALFORMED`` is never used
(its row count changes with column pruning) and nothing is dropped silently:
``good + bad = non-blank input lines``, a null line (a deleted record of a bus) being bad.

Input is one record per line.  A quoted CSV field may hold separators and, doubled or
escaped, quotes; it can't span lines: such a record's lines are quarantined as
``open_quote``, as is any line with an odd number of quotes (``5" pipe`` unquoted
included, since it can't be told from a field that was cut off).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
EXTRA = "_extra"
FAILED = "_failed"

# Fixed reason labels.
NULL_LINE = "null_line"
OPEN_QUOTE = "open_quote"
TOO_MANY = "too_many_fields"
TOO_FEW = "too_few_fields"
BAD_TYPE = "bad_type"
NOT_JSON = "not_json"
NOT_OBJECT = "not_object"
NOT_STRICT = "not_strict_json"


def as_struct(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    st = T._parse_datatype_string(schema)
    if not isinstance(st, T.StructType):
        raise ValueError(f"not a struct schema: {schema}")
    return st


def ddl(st: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in st.fields)


@dataclass
class Parsed:
    good: DataFrame
    bad: DataFrame

    def __iter__(self):
        return iter((self.good, self.bad))


def _non_blank(lines: DataFrame, header: str | None) -> DataFrame:
    keep = F.trim(F.col("value")) != F.lit("")
    if header is not None:
        keep = keep & (F.col("value") != F.lit(header))
    return lines.where(F.col("value").isNull() | keep)


def _with_source(lines: DataFrame, source: str | Column | None) -> DataFrame:
    if "source" in lines.columns and source is None:
        return lines
    src = F.lit(source) if isinstance(source, str) else (source if source is not None else F.lit(None).cast("string"))
    return lines.withColumn("source", src)


def tag_csv(
    lines: DataFrame,
    schema: T.StructType | str,
    header: str | None = None,
    sep: str = ",",
    quote: str = '"',
    escape: str = "\\",
    source: str | Column | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parse delimited lines once: the schema's columns (null on bad lines), ``source``,
    ``value`` and ``reason`` (null on good lines).

    Reasons: null_line, open_quote, too_many_fields, too_few_fields, bad_type (checked in
    that order).  Blank lines and lines equal to ``header`` are dropped (header by
    content, not by position).  An empty value is null, not an error.  ``sep`` may
    have several characters; a quote inside a quoted field may be escaped or doubled.
    """
    st = as_struct(schema)
    if CORRUPT in st.fieldNames():
        raise ValueError(f"{CORRUPT} is reserved")
    n = len(st.fields)
    opts = {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "sep": sep, "quote": quote, "escape": escape,
        **(options or {}),
    }
    full = T.StructType(st.fields + [T.StructField(CORRUPT, T.StringType())])
    rows = _with_source(_non_blank(lines, header), source)
    record = F.from_csv("value", ddl(full), opts)
    if quote != escape:
        # Doubled quotes are read by a parser whose escape is the quote.
        doubled = F.contains(F.col("value"), F.lit(quote * 2)) & ~F.contains(F.col("value"), F.lit(escape + quote))
        record = F.when(doubled, F.from_csv("value", ddl(full), {**opts, "escape": quote})).otherwise(record)
    parsed = rows.select("source", "value", record.alias("r"))
    field = F.col("r").getField

    # Escaped quote characters are data, not delimiters: drop them before counting.
    v = F.replace(F.col("value"), F.lit(escape + quote), F.lit(""))
    quotes = F.length(v) - F.length(F.replace(v, F.lit(quote), F.lit("")))
    # Quoted segments may hold delimiters; drop them before counting fields.
    q = _regex_quote(quote)
    unquoted = F.regexp_replace(v, f"{q}[^{q}]*{q}", "")
    fields = (F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit("")))) / len(sep) + 1
    # Spark accepts an unterminated quote in the last field; an odd quote count is
    # always a defect, so it is quarantined too.
    is_null = F.col("value").isNull()
    flagged = is_null | field(CORRUPT).isNotNull() | (quotes % 2 == 1)
    # CASE evaluates the field count (a regex) only for flagged lines.
    reason = (
        F.when(~flagged, F.lit(None).cast("string"))
        .when(is_null, F.lit(NULL_LINE))
        .when(quotes % 2 == 1, F.lit(OPEN_QUOTE))
        .when(fields > n, F.lit(TOO_MANY))
        .when(fields < n, F.lit(TOO_FEW))
        .otherwise(F.lit(BAD_TYPE))
    )
    return parsed.select(
        *[F.when(~flagged, field(f.name)).alias(f.name) for f in st.fields],
        "source",
        "value",
        reason.alias("reason"),
    )


def split(tagged: DataFrame, schema: T.StructType | str, extra: bool = False) -> Parsed:
    """(good, bad) from a tagged parse.  Each side re-reads the tagged plan; persist
    or checkpoint ``tagged`` first when both are written from a costly source."""
    st = as_struct(schema)
    cols = [F.col(f"`{f.name}`") for f in st.fields] + [F.col("source")] + ([F.col(EXTRA)] if extra else [])
    good = tagged.where(F.col("reason").isNull()).select(*cols)
    bad = tagged.where(F.col("reason").isNotNull()).select("source", "value", "reason")
    return Parsed(good, bad)


def parse_csv(
    lines: DataFrame,
    schema: T.StructType | str,
    header: str | None = None,
    sep: str = ",",
    quote: str = '"',
    escape: str = "\\",
    source: str | Column | None = None,
    options: Mapping[str, str] | None = None,
) -> Parsed:
    """Parse delimited lines into (good, bad); see :func:`tag_csv`.

    good: the schema's columns plus ``source``.  bad: ``source, value, reason``.
    """
    return split(tag_csv(lines, schema, header, sep, quote, escape, source, options), schema)


def _regex_quote(ch: str) -> str:
    return "\\" + ch if ch in '\\^$.|?*+()[]{}"' else ch


def tag_json(
    lines: DataFrame,
    schema: T.StructType | str,
    keep_extra: bool = True,
    source: str | Column | None = None,
    options: Mapping[str, str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Parse JSON lines once: the schema's columns (null on bad lines), ``source``,
    ``value``, ``reason`` (null on good lines) and, with ``keep_extra``, ``_extra``:
    a map of the top-level fields the schema does not name (nested values kept as
    JSON text), so unexpected fields are kept instead of lost.

    A missing field is null and the line stays good.  Reasons: null_line, not_json (does not
    parse), not_object (valid JSON but no object), bad_type.  Spark's reader accepts
    an object followed by trailing text, and keeps the last of two equal keys;
    ``strict=True`` also quarantines such lines (reason ``not_strict_json``), at the
    cost of a second, validating parse of every line.
    """
    st = as_struct(schema)
    full = T.StructType(st.fields + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    rows = _with_source(_non_blank(lines, None), source)
    parsed = rows.select("source", "value", F.from_json("value", full, opts).alias("r"))
    field = F.col("r").getField
    is_null = F.col("value").isNull()
    lenient_ok = field(CORRUPT).isNull() & ~is_null
    flagged = ~lenient_ok
    if strict:
        # Duplicate keys: the variant parser rejects them.  Trailing text: the line
        # wrapped in brackets must be a valid JSON array of exactly one element.
        one_value = F.json_array_length(F.concat(F.lit("["), F.col("value"), F.lit("]"))) == 1
        flagged = flagged | F.try_parse_json("value").isNull() | ~F.coalesce(one_value, F.lit(False))

    reason = (
        F.when(~flagged, F.lit(None).cast("string"))
        .when(is_null, F.lit(NULL_LINE))
        .when(lenient_ok, F.lit(NOT_STRICT))
        .when(F.try_parse_json("value").isNull(), F.lit(NOT_JSON))
        .when(~F.ltrim(F.col("value")).startswith("{"), F.lit(NOT_OBJECT))
        .otherwise(F.lit(BAD_TYPE))
    )
    out = [F.when(~flagged, field(f.name)).alias(f.name) for f in st.fields]
    out += ["source", "value", reason.alias("reason")]
    if keep_extra:
        known = F.array(*[F.lit(f.name) for f in st.fields])
        everything = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
        # Second parse (into a map) only for good lines.
        extra = F.when(~flagged, F.map_filter(everything, lambda k, _v: ~F.array_contains(known, k)))
        out.append(extra.alias(EXTRA))
    return parsed.select(*out)


def parse_json(
    lines: DataFrame,
    schema: T.StructType | str,
    keep_extra: bool = True,
    source: str | Column | None = None,
    options: Mapping[str, str] | None = None,
    strict: bool = False,
) -> Parsed:
    """Parse JSON lines into (good, bad); see :func:`tag_json`.

    good: the schema's columns, ``source`` and (``keep_extra``) ``_extra``.
    bad: ``source, value, reason``.
    """
    tagged = tag_json(lines, schema, keep_extra, source, options, strict)
    return split(tagged, schema, extra=keep_extra)


def summarize_bad(bad: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Bad lines per source and reason: source, reason, n, share.

    ``share`` is relative to ``totals`` (``source, lines``: all non-blank lines per
    source) when given, else to the bad lines of that source.
    """
    per = bad.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))
    if totals is None:
        totals = bad.groupBy("source").agg(F.count(F.lit(1)).alias("lines"))
    # totals has one row per source: small, but let AQE pick the join.
    return per.join(totals, "source", "left").select(
        "source", "reason", "n", (F.col("n") / F.col("lines")).alias("share")
    )


def summarize_tagged(tagged: DataFrame) -> DataFrame:
    """source, reason, n, share from tagged lines (:func:`tag_csv` / :func:`tag_json`)
    in one pass: lines are counted per (source, reason) and the per-source total is a
    window over that small result, so nothing is parsed or read twice."""
    per = tagged.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))
    lines = F.sum("n").over(Window.partitionBy("source"))
    out = per.select("source", "reason", "n", (F.col("n") / lines).alias("share"))
    return out.where(F.col("reason").isNotNull())


def line_totals(lines: DataFrame, source: str | Column | None = None, header: str | None = None) -> DataFrame:
    """Non-blank lines per source, null ones included (the denominator for :func:`summarize_bad`)."""
    rows = _with_source(_non_blank(lines, header), source)
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("lines"))


# --- schema drift ------------------------------------------------------------------

SAME, MOVED, TYPE_CHANGED, RENAMED, MISSING, EXTRA_COL = "same", "moved", "type_changed", "renamed", "missing", "extra"

_DRIFT_SCHEMA = (
    "column_name string, observed_name string, status string, "
    "baseline_type string, observed_type string, baseline_pos int, observed_pos int, cast_failures long"
)


def _schema_of(x: DataFrame | T.StructType | str) -> T.StructType:
    if isinstance(x, DataFrame):
        return x.schema
    return as_struct(x)


def drift_rows(
    observed: DataFrame | T.StructType | str,
    baseline: DataFrame | T.StructType | str,
    aliases: Mapping[str, str] | None = None,
) -> list[tuple]:
    """The drift table as plain rows (schemas are metadata, compared on the driver).

    ``aliases`` maps an observed name to the baseline name it replaces.  Renames
    come only from that map; an unmatched pair stays ``missing`` + ``extra``.
    """
    obs, base = _schema_of(observed), _schema_of(baseline)
    aliases = dict(aliases or {})
    o_pos = {f.name: (i, f.dataType) for i, f in enumerate(obs.fields)}
    b_pos = {f.name: (i, f.dataType) for i, f in enumerate(base.fields)}
    renamed_to = {o: b for o, b in aliases.items() if o in o_pos and b in b_pos and b not in o_pos}
    used_obs = set()
    out = []
    for name, (bi, bt) in b_pos.items():
        oname = name if name in o_pos else next((o for o, b in renamed_to.items() if b == name), None)
        if oname is None:
            out.append((name, None, MISSING, bt.simpleString(), None, bi, None))
            continue
        used_obs.add(oname)
        oi, ot = o_pos[oname]
        if oname != name:
            status = RENAMED
        elif ot != bt:
            status = TYPE_CHANGED
        elif oi != bi:
            status = MOVED
        else:
            status = SAME
        out.append((name, oname, status, bt.simpleString(), ot.simpleString(), bi, oi))
    for oname, (oi, ot) in o_pos.items():
        if oname not in used_obs:
            out.append((None, oname, EXTRA_COL, None, ot.simpleString(), None, oi))
    return out


def schema_drift(
    spark: SparkSession,
    observed: DataFrame | T.StructType | str,
    baseline: DataFrame | T.StructType | str,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """column_name, observed_name, status, baseline_type, observed_type, baseline_pos,
    observed_pos, cast_failures; status in same / moved / type_changed / renamed /
    missing / extra.

    When ``observed`` is a DataFrame, every matched column whose type differs from the
    baseline also gets ``cast_failures``: how many non-null values would not convert
    to the baseline type (``try_cast``), all counted in one aggregate over the data.
    Otherwise, and for columns without a type change, it is null.
    """
    rows = drift_rows(observed, baseline, aliases)
    base_types = {f.name: f.dataType for f in _schema_of(baseline).fields}
    checks = {}
    if isinstance(observed, DataFrame):
        for r in rows:
            if r[0] is not None and r[1] is not None and r[3] != r[4]:
                src = F.col(f"`{r[1]}`")
                checks[r[0]] = F.count_if(src.isNotNull() & src.try_cast(base_types[r[0]]).isNull())
    structs = []
    for i, r in enumerate(rows):
        fails = F.col(f"__f{i}") if r[0] in checks else F.lit(None).cast("long")
        structs.append(
            F.struct(
                F.lit(r[0]).cast("string").alias("column_name"),
                F.lit(r[1]).cast("string").alias("observed_name"),
                F.lit(r[2]).alias("status"),
                F.lit(r[3]).cast("string").alias("baseline_type"),
                F.lit(r[4]).cast("string").alias("observed_type"),
                F.lit(r[5]).cast("int").alias("baseline_pos"),
                F.lit(r[6]).cast("int").alias("observed_pos"),
                fails.cast("long").alias("cast_failures"),
            )
        )
    if checks:
        names = {c: f"__f{i}" for i, r in enumerate(rows) for c in [r[0]] if c in checks}
        one = observed.agg(*[checks[c].alias(n) for c, n in names.items()])
    else:
        one = spark.range(1)
    if not structs:
        return spark.createDataFrame([], _DRIFT_SCHEMA)
    return one.select(F.inline(F.array(*structs)))


def reconcile(
    df: DataFrame,
    baseline: DataFrame | T.StructType | str,
    aliases: Mapping[str, str] | None = None,
    extra: str = "map",
) -> DataFrame:
    """Bring ``df`` to the baseline schema: rename aliased columns, ``try_cast`` to the
    baseline type, add missing columns as null.  A value that doesn't convert becomes
    null, never an error, and its raw text is kept in ``_failed`` (map of column to
    text, null where all converted).  Columns the baseline does not know go into
    ``_extra`` (map of strings) with ``extra="map"``, or are dropped with
    ``extra="drop"``."""
    if extra not in ("map", "drop"):
        raise ValueError("extra must be 'map' or 'drop'")
    base = _schema_of(baseline)
    rows = drift_rows(df, base, aliases)
    by_base = {r[0]: r for r in rows if r[0] is not None}
    out, lost = [], []
    for f in base.fields:
        r = by_base[f.name]
        if r[1] is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            src = F.col(f"`{r[1]}`")
            out.append((src if r[3] == r[4] else src.try_cast(f.dataType)).alias(f.name))
            if r[3] != r[4]:
                raw = src.cast("string") if isinstance(df.schema[r[1]].dataType, T.AtomicType) else F.to_json(F.struct(src))
                failed = src.isNotNull() & src.try_cast(f.dataType).isNull()
                lost.append(F.when(failed, F.struct(F.lit(f.name).alias("key"), raw.alias("value"))))
    nothing = F.lit(None).cast("map<string,string>")
    if lost:
        found = F.filter(F.array(*lost), lambda x: x.isNotNull())
        nothing = F.when(F.size(found) > 0, F.map_from_entries(found))
    out.append(nothing.alias(FAILED))
    extras = [r[1] for r in rows if r[2] == EXTRA_COL]
    if extra == "map":
        if extras:
            pairs = []
            for e in extras:
                pairs += [F.lit(e), F.col(f"`{e}`").cast("string")]
            out.append(F.create_map(*pairs).alias(EXTRA))
        else:
            out.append(F.create_map().cast("map<string,string>").alias(EXTRA))
    return df.select(*out)


def read_drifted_csv(
    spark: SparkSession,
    path: str,
    baseline: T.StructType | str,
    aliases: Mapping[str, str] | None = None,
    sep: str = ",",
    quote: str = '"',
    escape: str = "\\",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows in the baseline schema, quarantined lines, drift table) of CSV files whose own
    header, not the baseline, says which columns they have.

    The first line of the first file names the columns; every file must have that header.
    Values are read as text and converted by :func:`reconcile`, so a value that doesn't
    convert keeps its raw text in ``_failed`` and an unknown column its value in ``_extra``.
    """
    lines = spark.read.text(path)
    first = lines.head(1)
    if not first:
        raise ValueError(f"no header in {path}")
    names = spark.read.option("header", "true").option("sep", sep).option("quote", quote).csv(path).columns
    observed = T.StructType([T.StructField(n, T.StringType()) for n in names])
    good, bad = parse_csv(lines, observed, header=first[0]["value"], sep=sep, quote=quote, escape=escape, source=path)
    data = good.drop("source")
    return reconcile(data, baseline, aliases), bad, schema_drift(spark, data, baseline, aliases)
