"""Zone maps: what footers state, what pages hold, and how zones overlap."""

import random
import struct

import pyarrow as pa
import pyarrow.parquet as pq

from tablelab.sources import zone_map as Z


def write(path, table, **kw):
    pq.write_table(table, path, **kw)
    return path


def test_wrong_statements_are_found_by_file_and_column(spark, tmp_path):
    table = pa.table({"k": pa.array(range(100, 200), pa.int64()), "t": [None if k % 7 == 0 else f"é{k}" for k in range(100)], "f": [float("nan"), 2.5] * 50})
    for name in ("good", "greatest", "nulls", "broken"):
        write(tmp_path / f"{name}.parquet", table, row_group_size=50, use_dictionary=False, compression="none")
    data = (tmp_path / "greatest.parquet").read_bytes()
    at = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
    # 199 is the greatest k of the second row group; the footer now says 150.
    wrong = data[:at] + data[at:].replace(struct.pack("<q", 199), struct.pack("<q", 150))
    (tmp_path / "greatest.parquet").write_bytes(wrong)
    (tmp_path / "broken.parquet").write_bytes(data[:200])
    got = {(r["path"].rsplit("/", 1)[-1], r["row_group"], r["column_name"]): r for r in Z.check_zones(spark, str(tmp_path)).collect()}
    assert {k for k, r in got.items() if r["wrong"]} == {("greatest.parquet", 1, "k"), ("broken.parquet", None, None)}
    assert got["greatest.parquet", 1, "k"]["wrong"] == "values from 150 to 199, not 150 to 150"
    k = got["good.parquet", 0, "k"]
    assert (k["rows"], k["nulls"], k["low"], k["high"], k["min_value"]) == (50, 0, 100.0, 149.0, "100")
    t = got["good.parquet", 1, "t"]
    assert (t["nulls"], t["low"], t["min_value"]) == (sum(x % 7 == 0 for x in range(50, 100)), None, "é50")
    stated = {(r["path"].rsplit("/", 1)[-1], r["row_group"], r["column_name"]): r["max_value"] for r in Z.zone_map(spark, str(tmp_path)).collect()}
    assert stated["greatest.parquet", 1, "k"] == "150"


def test_no_statistics_and_empty_files(spark, tmp_path):
    write(tmp_path / "none.parquet", pa.table({"k": [1, 2], "s": [{"x": 1}, {"x": 2}]}), write_statistics=False)
    write(tmp_path / "empty.parquet", pa.table({"k": pa.array([], pa.int64())}))
    rows = Z.check_zones(spark, str(tmp_path)).collect()
    assert {(r["column_name"], r["low"], r["wrong"]) for r in rows if r["rows"]} == {("k", None, None), ("s.x", None, None)}
    assert Z.zone_overlap(Z.zone_map(spark, str(tmp_path))).count() == 0


def test_overlap_against_all_zones(spark):
    rng = random.Random(2)
    zones = [("a", float(low), float(low + rng.randint(0, 6)), rng.randint(1, 9)) for low in (rng.randint(0, 40) for _ in range(60))] + [("b", float(k), k + 0.5, 10) for k in range(20)]
    df = spark.createDataFrame(zones, "column_name string, low double, high double, rows long")
    got = {r["column_name"]: r for r in Z.zone_overlap(df).collect()}
    for c in "ab":
        own = [z for z in zones if z[0] == c]
        depth = max(sum(z[1] <= p <= z[2] for z in own) for p in {z[1] for z in own})
        meets = sum(z[3] * sum(o[1] <= z[2] and o[2] >= z[1] for o in own) for z in own) / sum(z[3] for z in own)
        assert (got[c]["zones"], got[c]["depth"]) == (len(own), depth) and abs(got[c]["mean_depth"] - meets) < 1e-9
    assert got["b"]["depth"] == 1
