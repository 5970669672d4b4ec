"""Quoted CSV in parts next to Python's and Spark's readers."""

import csv
import io
import random

import pytest

from replyscope.sources.quoted import read_quoted
from replyscope.sources.raw import read_raw

VALUES = ["plain", "", "two words", 'say "hi"', "line\nbreak", 'a\n"quoted"\nb', "x,y", ",", '"', "\n\n", "end\n", 'in the "middle", and', "\r\nwindows", "é漢"]


def write(path, rows, newline="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=newline).writerows(rows)
    path.write_bytes(out.getvalue().encode())


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("size", ["64b", "1k", "128m"])
def test_parts_of_any_size_give_equal_rows(spark, tmp_path, newline, size):
    rng = random.Random(3)
    rows = [[str(i), rng.choice(VALUES), rng.choice(VALUES)] for i in range(150)]
    rows.insert(70, ["long", "many\n" * 300, "z"])  # a value over many parts
    write(tmp_path / "a.csv", [["id", "te xt", "last"], *rows[:90]], newline)
    write(tmp_path / "b.csv", [["id", "te xt", "last"], *rows[90:]], newline)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = read_quoted(spark, str(tmp_path))
        assert size == "128m" or spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
        got = sorted((r["id"], r["te xt"] or "", r["last"] or "") for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert got == sorted(map(tuple, rows))


def test_equal_to_the_whole_file_reader(spark, tmp_path):
    rng = random.Random(5)
    write(tmp_path / "a.csv", [["id", "text"], *[[str(i), rng.choice(VALUES) + "."] for i in range(80)]])
    whole = spark.read.options(header=True, multiLine=True, escape='"', quote='"').csv(str(tmp_path / "a.csv"))
    assert sorted(map(tuple, read_quoted(spark, str(tmp_path / "a.csv")).collect())) == sorted(map(tuple, whole.collect()))


def test_stray_quotes_and_broken_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,brand\n1,a 5" pipe,x\n2,it is "fine" so,y\n\n3,only two\n4,one,two,three\n5,"a\nb",z\n')
    rows = {r["id"]: (r["text"], r["brand"], r["odd"]) for r in read_quoted(spark, str(tmp_path / "a.csv"), "odd").collect()}
    assert rows["1"] == ('a 5" pipe', "x", None) and rows["2"] == ('it is "fine" so', "y", None) and rows["5"] == ("a\nb", "z", None)
    assert rows["3"][2] == "3,only two" and rows["4"][2] == "4,one,two,three" and len(rows) == 5
    raw = read_raw(spark, str(tmp_path / "a.csv"), broken="odd")
    assert raw.filter("odd IS NOT NULL").count() == 2 and "text_clean" in raw.columns
    (tmp_path / "empty.csv").write_text("id,text,brand\n")
    assert read_quoted(spark, str(tmp_path / "empty.csv")).count() == 0
