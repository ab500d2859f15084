"""One file of quoted line breaks in many byte ranges, against Python's csv module."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from starmart.sources.quoted import layout, text_lines
from starmart.sources.readers import read_csv


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 1,000 bytes, whatever the file size."""
    names = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write(path, rows, end="\r\n"):
    with open(path, "w", encoding="utf-8", newline="") as file:
        file.write("﻿")
        writer = csv.writer(file, quoting=csv.QUOTE_ALL, lineterminator=end)
        writer.writerows(rows)


def made_rows(seed, n=60):
    rng = random.Random(seed)
    pieces = ["line\nbreak", "\r\n", 'a "quote"', '""', '"', ",", "é", "plain", "\n\n\n", "x" * 300, " "]
    return [[str(i), "".join(rng.choices(pieces, k=rng.randint(1, 12))) + "z", str(rng.randint(0, 9))] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_breaks_at_every_border(spark, small_ranges, tmp_path, end):
    path = tmp_path / "one.csv"
    rows = made_rows(1) + [["big", "\n" * 2500 + "mid\"dle" + "\n" * 2500 + "z", "5"], ["last", "n\no", "7"]]
    write(path, [["id", "text", "n"], *rows], end)
    lines = text_lines(spark, str(path))
    found = layout(lines)
    assert len(found.starts) > 8 and sum(inside for inside, _ in found.starts.values()) > 4
    # Values inside quotes keep their own line breaks; the reader of the check does so too.
    got = read_csv(spark, str(path), {"n": "int"}, multi_line=True)
    assert got.dtypes == [("id", "string"), ("text", "string"), ("n", "int")]
    assert sorted(tuple(r) for r in got.collect()) == sorted((a, b, int(c)) for a, b, c in rows)
    assert got.rdd.getNumPartitions() > 8


def test_shifted_borders(spark, small_ranges, tmp_path):
    """The same records behind headers of growing length, so that borders fall everywhere."""
    rows = made_rows(2, 30)
    for shift in range(0, 40, 3):
        path = tmp_path / f"s{shift}.csv"
        write(path, [["id", "text", "n" * (shift + 1)], *rows], "\n")
        got = read_csv(spark, str(path), multi_line=True)
        assert sorted(tuple(r) for r in got.collect()) == sorted(map(tuple, rows))


def test_many_files_blank_lines_and_equal_rows(spark, small_ranges, tmp_path):
    for i in range(3):
        write(tmp_path / f"{i}.csv", [["id", "text", "n"], ["id", "text", "n"], ["1", "a\nb", "2"]], "\n")
        with open(tmp_path / f"{i}.csv", "a", encoding="utf-8") as file:
            file.write('\n  \n\n2,plain,bad\n3,"",')
    got = read_csv(spark, str(tmp_path), {"n": "int"}, multi_line=True)
    wanted = [("id", "text", None), ("1", "a\nb", 2), ("2", "plain", None), ("3", None, None)] * 3
    plain = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema("id string, text string, n int").csv(str(tmp_path))
    found = sorted(map(tuple, got.collect()), key=repr)
    assert found == sorted(map(tuple, plain.where(F.length(F.trim("id")) > 0).collect()), key=repr)
    assert len(found) == len(wanted)


def test_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"open\n')
    with pytest.raises(ValueError, match="never closes"):
        read_csv(spark, str(tmp_path / "a.csv"), multi_line=True)
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text("id,text\n1,a\n")
    (folder / "b.csv").write_text("id,other\n1,a\n")
    with pytest.raises(ValueError, match="other header"):
        read_csv(spark, str(folder), multi_line=True)


def test_no_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert read_csv(spark, str(tmp_path / "empty.csv"), {"id": "int"}, multi_line=True).collect() == []
    (tmp_path / "header.csv").write_text("id,text\n")
    got = read_csv(spark, str(tmp_path / "header.csv"), {"id": "int"}, multi_line=True)
    assert got.dtypes == [("id", "int"), ("text", "string")] and got.collect() == []
