"""Quoted CSV read in parts: values may contain line breaks, files may be of any size.

Where a record starts depends on whether a quoted value is open, and that on all text
before. But a line only does one of four things to this state: leave it, turn it
around, or set it to open or closed, whatever it was. So every part of a file is
summed up in one row, the few rows give the state at the start of every part, and the
lines of a part find theirs by a window over the part. Lines that are records of their
own stay where they are; only those of a record with line breaks are brought together
before Spark's CSV parser reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from replyscope.session import cut_lineage

CLOSES = r'^(?:[^"]++|"")*+"\s*+(?=,|$)'  # the rest of an open value and its end
WHOLE_VALUE = r'(^|,)\s*+"(?:[^"]++|"")*+"\s*+(?=,|$)'
OPENS = r'(?:^|,)\s*+"(?:[^"]++|"")*+$'
BROKEN = "_broken"


def _after_closed(line: Column) -> Column:
    """1 if a quoted value is open behind a line that begins outside of one."""
    return F.regexp_replace(line, WHOLE_VALUE, "$1").rlike(OPENS).cast("int")


def _after_open(line: Column) -> Column:
    rest = F.regexp_replace(line, CLOSES, "")
    return F.when(line.rlike(CLOSES), _after_closed(rest)).otherwise(F.lit(1))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, at, line, shut, open): the lines of every part of every file, and
    the state behind a line for either state before it."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )
    plain = F.regexp_replace("line", r"\r$", "")
    quoted = F.col("line").contains('"')
    return lines.select("*", F.when(quoted, _after_closed(plain)).otherwise(F.lit(0)).alias("shut"), F.when(quoted, _after_open(plain)).otherwise(F.lit(1)).alias("open"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record): the text of every record of the files at `path`, without the
    header, the first record of each file. Blank records are left out."""
    lines = cut_lineage(_lines(spark, path), "lines")
    part = Window.partitionBy("file", "start").orderBy("at")
    sets = F.col("shut") == F.col("open")
    turned = lines.withColumn("turns", F.sum((F.col("shut") > F.col("open")).cast("int")).over(part))
    fixed = F.last(F.when(sets, F.struct(F.col("shut").alias("state"), F.col("turns"))), ignorenulls=True).over(part)
    known = turned.withColumn("fixed", fixed)
    # behind a line: the last state that was set, turned around as often as lines did so since; before any was set, relative to the part's start
    behind = known.select(
        "file", "start", "at", "line",
        F.when(F.col("fixed").isNotNull(), (F.col("fixed.state") + F.col("turns") - F.col("fixed.turns")) % 2).alias("state"),
        (F.col("turns") % 2).alias("turned"),
    )
    behind = cut_lineage(behind, "states")
    last = behind.groupBy("file", "start").agg(F.max_by(F.struct("state", "turned"), "at").alias("last")).select("file", "start", "last.*")
    begin, now, before = [], 0, None
    for row in last.orderBy("file", "start").collect():  # a row per part
        if row["file"] != before:
            now, before = 0, row["file"]
        begin.append((row["file"], row["start"], now))
        now = row["state"] if row["state"] is not None else now ^ row["turned"]
    parts = spark.createDataFrame(begin, "file string, start long, begin int")
    stated = behind.join(F.broadcast(parts), ["file", "start"]).withColumn("after", F.coalesce("state", (F.col("begin") + F.col("turned")) % 2))
    stated = stated.withColumn("opened", F.coalesce(F.lag("after").over(part), F.col("begin")))
    starts = stated.withColumn("starts", (F.col("opened") == 0).cast("long"))
    starts = cut_lineage(starts.withColumn("number", F.sum("starts").over(part)).select("file", "start", "at", "line", "opened", "after", "number"), "starts")
    total, numbered, before = 0, [], None
    for row in starts.groupBy("file", "start").agg(F.max("number").alias("n")).orderBy("file", "start").collect():  # a row per part
        if row["file"] != before:
            total, before = 0, row["file"]
        numbered.append((row["file"], row["start"], total))
        total += row["n"]
    offsets = spark.createDataFrame(numbered, "file string, start long, earlier long")
    placed = starts.join(F.broadcast(offsets), ["file", "start"]).withColumn("record", F.col("earlier") + F.col("number"))
    placed = placed.filter("record > 1")  # the first is the header
    alone = (F.col("opened") == 0) & (F.col("after") == 0)
    single = placed.filter(alone).select("file", F.col("line").alias("record"))
    ordered = F.array_sort(F.collect_list(F.struct("start", "at", "line")))  # the lines of one record
    joined = placed.filter(~alone).groupBy("file", "record").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))
    both = single.unionByName(joined.select("file", F.col("text").alias("record")))
    return both.select("file", F.regexp_replace("record", r"\r$", "").alias("record")).filter(F.trim("record") != "")


def read_quoted(spark: SparkSession, path: str, broken: str | None = None) -> DataFrame:
    """The files' columns as text, as their header names them. Quotes inside a value
    are doubled; a quote that doesn't begin a value is an ordinary character. Records
    with too many or too few values are filled up or cut like Spark's reader does;
    with `broken`, a column of that name holds their text, and null for the others."""
    names = spark.read.option("header", True).csv(path).columns
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    parsed = records(spark, path).select(F.from_csv("record", _ddl(names), options).alias("r"))
    kept = [F.col("r").getField(n).alias(n) for n in names]
    return parsed.select(*kept, *([F.col("r").getField(BROKEN).alias(broken)] if broken else []))


def _ddl(names: list[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, BROKEN])
