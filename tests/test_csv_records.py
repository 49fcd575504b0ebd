"""CSV records that span lines, whole at any split size."""

import random

import pytest

from tablelab.operators import quality as Q
from tablelab.sources import csv_records as C

KEY = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def split_bytes(spark):
    before = {k: spark.conf.get(k) for k in (KEY, "spark.sql.files.openCostInBytes")}

    def use(n):
        spark.conf.set(KEY, str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def read(spark, path):
    return sorted(r["value"] for r in C.read_csv_records(spark, str(path)).collect())


def record(rng, k):
    """(text, whether it is whole)"""
    kind = rng.randrange(7)
    note = rng.choice(["", "two\nlines", "three\n\nlines of\n text, with commas", 'said ""yes""\nand left', "a, b", "\\\"q\\\" and\nmore", "x" * 150 + "\n" + "y" * 150])
    if kind == 0:
        return f'{k},"open,1', False
    if kind < 4:
        return f'{k},"{note or "text"}",{k % 3}', True
    return f"{k},plain,{k % 3}", True


@pytest.mark.parametrize("size", [900, 1 << 20])
def test_records_are_whole_at_any_split_size(spark, split_bytes, tmp_path, size):
    rng = random.Random(5)
    made = []
    for f in range(2):
        records = [record(rng, 1000 * f + k) for k in range(60)] + [(f"{f},end,0", True)]
        made += records
        (tmp_path / f"f{f}.csv").write_bytes("\n".join(r for r, _ in records).encode() + (b"\n" if f else b""))
    split_bytes(size)
    assert read(spark, tmp_path) == sorted(r for r, _ in made)
    tagged = Q.tag_csv(C.read_csv_records(spark, str(tmp_path)), "id long, note string, n int").collect()
    assert sum(r["reason"] is None for r in tagged) == sum(ok for _, ok in made)
    assert {r["reason"] for r in tagged} == {None, "open_quote"}


def test_an_open_quote_costs_its_line_at_the_end_too(spark, split_bytes, tmp_path):
    lines = ["1,a,b", '2,"open,b', *[f"{k},plain,b" for k in range(3, 60)]]
    (tmp_path / "f.csv").write_text("\n".join(lines))
    for size in (100, 1 << 20):
        split_bytes(size)
        assert read(spark, tmp_path) == sorted(lines)


def test_one_record_over_many_splits_and_carriage_returns(spark, split_bytes, tmp_path):
    long = '7,"' + "\n".join(f"line {k}" for k in range(60)) + '",z'
    lines = ["1,a,b", long, "8,c,d", '9,"e\r\nf",g']
    (tmp_path / "f.csv").write_bytes("\r\n".join(lines).encode())
    split_bytes(100)
    assert read(spark, tmp_path) == sorted(lines)


def test_any_text_gives_the_same_records_at_any_split_size(spark, split_bytes, tmp_path):
    rng = random.Random(11)
    for f in range(3):
        text = "".join(rng.choices(['"', ",", "a", "\n", '","', 'b\n1,"', '"\n'], k=260))
        (tmp_path / f"f{f}.csv").write_text(text)
    split_bytes(1 << 20)
    want = read(spark, tmp_path)
    for size in (29, 83):
        split_bytes(size)
        assert read(spark, tmp_path) == want
    lines = sorted(x for f in tmp_path.iterdir() for x in f.read_text().removesuffix("\n").split("\n"))
    assert sorted(x for r in want for x in r.split("\n")) == lines  # nothing is lost or made up


def test_separators_of_several_characters_and_empty_folders(spark, tmp_path):
    (tmp_path / "f.csv").write_text("1||'x\n||y'||2\n2||z||3")
    got = sorted(r["value"] for r in C.read_csv_records(spark, str(tmp_path), sep="||", quote="'").collect())
    assert got == ["1||'x\n||y'||2", "2||z||3"]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    assert read(spark, tmp_path / "none") == []
