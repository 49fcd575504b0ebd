"""Keyed changes read only the buckets that differ."""

import os

import pytest
from pyspark.sql import functions as F

from tablelab.operators import keyed as K
from tablelab.session import scratch_dir

SCHEMA = "id long, `by` string, v double"


def versions(spark, before, after, buckets=16):
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (before, after)]
    return [K.write_version(df, ["id", "by"], scratch_dir(spark, "keyed-test"), buckets) for df in frames]


def test_changes_with_both_images_and_unread_buckets(spark):
    before = [(k, "abc"[k % 3], k / 4) for k in range(500)] + [(None, None, 1.0), (7, None, None)]
    after = [r for r in before if r[0] != 11]
    after = [(k, b, None if k == 20 else v) for k, b, v in after if not (k is None)] + [(None, None, 2.0), (900, "z", 0.5)]
    a, b = versions(spark, before, after)
    differ = K.differing_buckets(spark, a, b)
    assert 0 < len(differ) <= 4
    # Files of the other buckets are wiped: they aren't opened.
    for path in (a, b):
        root = path.removeprefix("file:") + "/rows"
        for folder in os.listdir(root):
            if folder.startswith(K.BUCKET) and int(folder.split("=")[1]) not in differ:
                for f in os.listdir(f"{root}/{folder}"):
                    if not f.startswith("."):
                        open(f"{root}/{folder}/{f}", "wb").close()
    got = {(r["id"], r["by"]): (r["change"], r["before"] and r["before"]["v"], r["after"] and r["after"]["v"]) for r in K.keyed_changes(spark, a, b, ["id", "by"], SCHEMA).collect()}
    assert got == {(11, "c"): ("removed", 11 / 4, None), (20, "c"): ("changed", 5.0, None), (None, None): ("changed", 1.0, 2.0), (900, "z"): ("added", None, 0.5)}


def test_equal_versions_and_repeated_keys(spark):
    rows = [(k, "a", 1.0) for k in range(50)]
    a, b = versions(spark, rows, rows[::-1])
    assert K.differing_buckets(spark, a, b) == [] and K.keyed_changes(spark, a, b, ["id", "by"], SCHEMA).count() == 0
    a, b = versions(spark, rows, rows + [(3, "a", 2.0)])
    with pytest.raises(Exception, match="met twice"):
        K.keyed_changes(spark, a, b, ["id", "by"], SCHEMA).collect()
    a, b = versions(spark, [], rows[:2])
    assert K.keyed_changes(spark, a, b, ["id", "by"], SCHEMA).where(F.col("change") == "added").count() == 2
