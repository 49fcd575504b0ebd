"""Quarantine, drift, reconcile and Parquet audit.

Lines are made from a table of sensor readings by rules: each defect is one function of a
good line, applied to several rows, so a test says what a defect does and not only that
one line fails.
"""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tablelab.operators import quality as Q
from tablelab.sources import parquet_audit as PA

SENSOR = "station string, reading int, measured double, ok boolean"
HEADER = "station,reading,measured,ok"
READINGS = [(f"s{k % 4}", k, k / 8, k % 3 == 0) for k in range(40)]

CSV_DEFECTS = {
    "bad_type": lambda f: [f[0], f[1] + "x", f[2], f[3]],
    "too_few_fields": lambda f: f[:2],
    "too_many_fields": lambda f: [*f, "", "late"],
    "open_quote": lambda f: [f[0], f[1], f[2], '"' + f[3]],
    None: lambda f: f,
}


def csv_fields(row):
    return [row[0], str(row[1]), str(row[2]), str(row[3]).lower()]


def defective_csv():
    """(line, reason) for each reading; the defects take turns."""
    kinds = list(CSV_DEFECTS)
    return [(",".join(CSV_DEFECTS[kinds[k % len(kinds)]](csv_fields(r))), kinds[k % len(kinds)]) for k, r in enumerate(READINGS)]


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_every_csv_defect_gets_its_reason(spark):
    made = defective_csv()
    lines = [HEADER, *(x for x, _ in made), "   ", None, HEADER, ""]
    tagged = Q.tag_csv(lines_df(spark, lines), SENSOR, header=HEADER, source="sensors.csv")
    got = {r["value"]: r["reason"] for r in tagged.collect()}
    assert got == {**dict(made), None: "null_line"}
    good, bad = Q.split(tagged, SENSOR)
    assert good.count() + bad.count() == len(made) + 1
    assert {r["source"] for r in bad.collect()} == {"sensors.csv"}
    assert sorted(r["reading"] for r in good.collect()) == [k for k in range(40) if k % 5 == 4]


def test_empty_values_are_null(spark):
    good, bad = Q.parse_csv(lines_df(spark, ["s1,,,true", ",4,0.5,"]), SENSOR)
    assert bad.count() == 0
    assert sorted(map(str, ((r["station"], r["reading"], r["measured"], r["ok"]) for r in good.collect()))) == sorted(
        map(str, [("s1", None, None, True), (None, 4, 0.5, None)])
    )


def test_separators_of_several_characters(spark):
    lines = ["s1||7||0.5||true", "s1||seven||0.5||true", "s1||7", "s1||7||0.5||true||x", 's1||7||0.5||"tr||ue"']
    got = {r["value"]: r["reason"] for r in Q.tag_csv(lines_df(spark, lines), SENSOR, sep="||").collect()}
    assert [got[x] for x in lines] == [None, "bad_type", "too_few_fields", "too_many_fields", "bad_type"]


@pytest.mark.parametrize("raw, text", [('"a ""b"" c"', 'a "b" c'), ('"a \\"b\\" c"', 'a "b" c'), ('"x, y"', "x, y"), ('""', None)])
def test_quotes_within_fields(spark, raw, text):
    good, bad = Q.parse_csv(lines_df(spark, [f"{raw},1,2.0,true"]), SENSOR)
    assert bad.count() == 0 and good.first()["station"] == text


def test_odd_quotes_are_quarantined(spark):
    lines = ['s1,1,2.0,"true', '5" pipe,1,2.0,true', '"starts here,1']
    _, bad = Q.parse_csv(lines_df(spark, lines), SENSOR)
    assert {r["reason"] for r in bad.collect()} == {"open_quote"} and bad.count() == 3


def test_names_with_dots(spark):
    schema = "`a.b` int, `c d` string"
    good, _ = Q.parse_csv(lines_df(spark, ["1,x"]), schema)
    assert good.first()["a.b"] == 1
    good, bad = Q.parse_json(lines_df(spark, ['{"a.b": 2, "c d": "y"}', None]), schema)
    assert good.first()["a.b"] == 2 and [r["reason"] for r in bad.collect()] == ["null_line"]


READING_JSON = "station string, reading int, tags array<string>"


def json_line(k, **more):
    import json

    return json.dumps({"station": f"s{k}", "reading": k, "tags": ["t"] * (k % 3), **more})


JSON_DEFECTS = {
    "not_object": lambda k: f"[{k}]",
    "bad_type": lambda k: json_line(k, reading=[k]),
    "not_json": lambda k: json_line(k)[: -3 - k % 4],
    None: json_line,
}


def test_every_json_defect_gets_its_reason(spark):
    kinds = list(JSON_DEFECTS)
    made = [(JSON_DEFECTS[kinds[k % 4]](k), kinds[k % 4]) for k in range(24)]
    tagged = Q.tag_json(lines_df(spark, [x for x, _ in made] + [" ", None]), READING_JSON, source="sensors.json")
    assert {r["value"]: r["reason"] for r in tagged.collect()} == {**dict(made), None: "null_line"}


def test_json_unknown_and_missing_fields(spark):
    lines = ['{"reading": 3}', json_line(1, unit="C", place={"lat": 1.5, "lon": [2]})]
    good, bad = Q.parse_json(lines_df(spark, lines), READING_JSON)
    assert bad.count() == 0
    rows = {r["reading"]: r for r in good.collect()}
    assert rows[3]["station"] is None and rows[3]["_extra"] == {}
    assert rows[1]["_extra"] == {"unit": "C", "place": '{"lat":1.5,"lon":[2]}'}


def test_json_strict_mode(spark):
    lines = [json_line(1) + " tail", '{"reading": 1, "reading": 2}', json_line(3)]
    good, bad = Q.parse_json(lines_df(spark, lines), READING_JSON)
    assert good.count() == 3 and bad.count() == 0  # the lenient reading
    good, bad = Q.parse_json(lines_df(spark, lines), READING_JSON, strict=True)
    assert [r["reading"] for r in good.collect()] == [3]
    assert sorted(r["reason"] for r in bad.collect()) == ["not_strict_json"] * 2


def test_summaries_agree(spark):
    lines = lines_df(spark, [HEADER, *(x for x, _ in defective_csv())])
    tagged = Q.tag_csv(lines, SENSOR, header=HEADER, source="a")
    _, bad = Q.split(tagged, SENSOR)
    two_pass = Q.summarize_bad(bad, Q.line_totals(lines, source="a", header=HEADER)).collect()
    one_pass = Q.summarize_tagged(tagged).collect()
    assert sorted(map(tuple, two_pass)) == sorted(map(tuple, one_pass))
    assert {(r["reason"], r["n"], r["share"]) for r in one_pass} == {(x, 8, 0.2) for x in CSV_DEFECTS if x}


def test_schema_drift_statuses(spark):
    observed = "measured string, place string, reading int, station_id string, ok boolean"
    rows = {(r["column_name"], r["observed_name"]): r["status"] for r in Q.schema_drift(spark, observed, SENSOR, {"station_id": "station"}).collect()}
    assert rows == {("station", "station_id"): "renamed", ("reading", "reading"): "moved", ("measured", "measured"): "type_changed",
                    ("ok", "ok"): "moved", (None, "place"): "extra"}
    plain = sorted(r["status"] for r in Q.schema_drift(spark, observed, SENSOR).collect())
    assert plain == ["extra", "extra", "missing", "moved", "moved", "type_changed"]


def test_reconcile_keeps_what_it_cannot_convert(spark):
    df = spark.createDataFrame([("4", "0.25", "hill", None), ("four", "1e3", None, True), (None, "?", "dale", False)],
                               "reading string, measured string, place string, ok boolean")
    out = Q.reconcile(df, SENSOR)
    assert out.columns == ["station", "reading", "measured", "ok", "_failed", "_extra"]
    rows = {r["ok"]: r for r in out.collect()}
    assert (rows[None]["reading"], rows[None]["measured"], rows[None]["_failed"]) == (4, 0.25, None)
    assert rows[True]["_failed"] == {"reading": "four"} and rows[True]["measured"] == 1000.0
    assert rows[False]["_failed"] == {"measured": "?"} and rows[False]["_extra"] == {"place": "dale"}
    assert Q.reconcile(df, SENSOR, extra="drop").columns == ["station", "reading", "measured", "ok", "_failed"]


def test_reconcile_rejects_bad_mode(spark):
    with pytest.raises(ValueError):
        Q.reconcile(spark.createDataFrame([(1,)], "a long"), "a long", extra="keep")


def test_drifted_csv_file_by_its_own_header(spark):
    root = tempfile.mkdtemp(prefix="drift-", dir="/tmp")
    body = ["where,measured,station,ok", "hill,0.5,s1,true", "dale,oops,s2,false", "hill,0.75", "moor,2.5,s3,"]
    with open(os.path.join(root, "feed.csv"), "w") as f:
        f.write("\n".join(body) + "\n")
    rows, bad, drift = Q.read_drifted_csv(spark, root, SENSOR)
    got = {r["station"]: r for r in rows.collect()}
    assert {k: (r["measured"], r["ok"], r["_extra"]["where"]) for k, r in got.items()} == {
        "s1": (0.5, True, "hill"), "s2": (None, False, "dale"), "s3": (2.5, None, "moor")}
    assert got["s2"]["_failed"] == {"measured": "oops"} and got["s1"]["reading"] is None
    assert [(r["value"], r["reason"]) for r in bad.collect()] == [("hill,0.75", "too_few_fields")]
    status = {r["column_name"] or r["observed_name"]: r["status"] for r in drift.collect()}
    assert status == {"station": "moved", "reading": "missing", "measured": "type_changed", "ok": "type_changed", "where": "extra"}
    assert {r["column_name"]: r["cast_failures"] for r in drift.collect()}["measured"] == 1


def damaged_folder(spark, name, damage):
    """Four healthy files of 100 ids and a copy of one with its bytes damaged."""
    root = tempfile.mkdtemp(prefix=f"{name}-", dir="/tmp")
    spark.range(100).repartition(4).write.parquet(f"{root}/good")
    whole = next(f for f in os.listdir(f"{root}/good") if f.endswith(".parquet"))
    with open(f"{root}/good/{whole}", "rb") as f:
        data = bytearray(f.read())
    with open(os.path.join(root, "damaged.parquet"), "wb") as f:
        f.write(damage(data))
    return root


def cut_in_half(data):
    return data[: len(data) // 2]


def wipe_pages(data):
    data[4:40] = b"\xff" * 36  # page headers; the footer stays whole
    return data


def no_magic(data):
    return b"ELSE" + data[4:]


@pytest.mark.parametrize("damage, pages, why", [(cut_in_half, False, "trailing magic"), (no_magic, False, "leading magic"), (wipe_pages, True, "pages")])
def test_audit_finds_damage_and_the_rest_is_read(spark, damage, pages, why):
    root = damaged_folder(spark, "audit", damage)
    audit = {os.path.basename(r["path"]): r for r in PA.audit_parquet(spark, root, pages=pages).collect()}
    assert audit["damaged.parquet"]["ok"] is False and why in audit["damaged.parquet"]["reason"]
    assert sum(r["num_rows"] for r in audit.values() if r["ok"]) == 100
    rows, skipped = PA.read_healthy(spark, root, "id long")
    assert sorted(r["id"] for r in rows.collect()) == list(range(100))
    assert [os.path.basename(r["path"]) for r in skipped.collect()] == ["damaged.parquet"]


def test_folder_names_are_no_patterns(spark):
    root = tempfile.mkdtemp(prefix="odd-", dir="/tmp") + "/a[1]"
    spark.range(10).write.parquet(root)
    rows, skipped = PA.read_healthy(spark, root, "id long")
    assert rows.count() == 10 and skipped.count() == 0


def test_plain_read_of_a_damaged_file_fails(spark):
    root = tempfile.mkdtemp(prefix="corrupt-", dir="/tmp")
    PA.write_corrupt_parquet(spark, root)
    with pytest.raises(Exception):
        spark.read.schema("id long").parquet(root).count()


def test_reasons_are_whole(monkeypatch):
    def fail(path):
        raise OSError("first line\n" + "x" * 2000)

    monkeypatch.setattr(PA, "_open", fail)
    assert PA.check_footer("file:/x", 1)[3] == "OSError: first line\n" + "x" * 2000


def test_null_and_blank_rows_of_any_source(spark):
    lines = spark.createDataFrame([("a", None), ("a", " "), ("b", "s1,1,2.0,true")], "source string, value string")
    got = sorted((r["source"], r["reason"]) for r in Q.tag_csv(lines, SENSOR).collect() if r["reason"])
    assert got == [("a", "null_line")]
    assert {r["source"]: r["lines"] for r in Q.line_totals(lines).collect()} == {"a": 1, "b": 1}
    assert Q.tag_csv(lines, SENSOR).where(F.col("reason").isNull()).count() == 1
