"""Sources and sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyscope.constants import DEFAULT_BRAND, SYNTHETIC_TEXTS
from replyscope.sources.quoted import read_quoted
from replyscope.functions.text import clean_text, normalize_inbound, parse_created_at


def ensure_columns(df: DataFrame, columns, default="") -> DataFrame:
    """Adds every missing column with a constant."""
    return df.withColumns({c: F.lit(default) for c in columns if c not in df.columns})


def normalize_raw(df: DataFrame, brand_default: str = DEFAULT_BRAND, order: list[str] | None = None) -> DataFrame:
    """Typed raw table with text_clean and row_ord, whatever columns exist.

    Files have no order in Spark, so row_ord is (time, id) unless order columns
    are given."""
    present = dict(df.dtypes)
    inbound = normalize_inbound(F.col("inbound"), present["inbound"]) if "inbound" in present else F.lit(True)
    created = parse_created_at(F.col("created_at")) if "created_at" in present else F.lit("2017-01-01").cast("timestamp")

    def text(name, default=""):
        return F.coalesce(F.col(name).cast("string"), F.lit(default)) if name in present else F.lit(default)

    known = {
        "tweet_id": text("tweet_id"),
        "author_id": text("author_id"),
        "inbound": inbound,
        "created_at": created,
        "text": text("text"),
        "response_tweet_id": text("response_tweet_id"),
        "in_response_to_tweet_id": text("in_response_to_tweet_id"),
        "brand": text("brand", brand_default),
    }
    extra = [c for c in df.columns if c not in known and c not in ("row_ord", "text_clean")]
    ordering = F.struct(*[F.col(c) for c in order]) if order else F.struct(created, text("tweet_id"))
    return df.select(
        *[column.alias(name) for name, column in known.items()],
        *extra,
        clean_text(text("text")).alias("text_clean"),
        ordering.alias("row_ord"),
    )


def read_raw(
    spark: SparkSession, path: str, brand_default: str = DEFAULT_BRAND, order: list[str] | None = None, multi_line: bool = True, broken: str | None = None
) -> DataFrame:
    """CSV with a header line. All columns are read as text, since ids must
    stay text; only the header is inspected to know which columns exist. Values may
    hold line breaks, and files are read in parts all the same (see `quoted`); with
    multi_line=False, for files known to have none, Spark's own reader needs no
    pass to find the records. `broken` names a column for the text of records that
    have too many or too few values."""
    if multi_line:
        return normalize_raw(read_quoted(spark, path, broken), brand_default, order)
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *([broken] if broken else [])]])
    options = {"header": True, "escape": '"', "quote": '"'} | ({"columnNameOfCorruptRecord": broken} if broken else {})
    return normalize_raw(spark.read.options(**options).schema(schema).csv(path), brand_default, order)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a fixed schema; blank lines are no records."""
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_threads(train: DataFrame, test: DataFrame, folder: str, csv: bool = True, mode: str = "errorifexists") -> None:
    """Both parts as typed parquet, and as CSV for exchange."""
    for name, part in (("train_threads", train), ("test_threads", test)):
        target = os.path.join(folder, name)
        part.write.mode(mode).parquet(target)
        if csv:
            # Read back, so that the threads are not computed twice.
            stored = part.sparkSession.read.parquet(target)
            stored.write.mode(mode).option("header", True).option("escape", '"').csv(target + "_csv")


def write_metrics(metrics: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The one-row metrics document as JSON."""
    metrics.coalesce(1).write.mode(mode).json(path)


def synth_messages(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """Synthetic raw rows. Each value is a hash of row number and seed, so the
    table does not depend on how it is partitioned."""
    rows = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    i = F.col("id")

    def draw(name: str, bound: int):
        return F.pmod(F.xxhash64(i, F.lit(seed), F.lit(name)), F.lit(bound)).cast("int")

    kinds = F.array(*[F.struct(F.lit(t).alias("text"), F.lit(b).alias("inbound")) for t, b in SYNTHETIC_TEXTS])
    drawn = rows.select(i, F.element_at(kinds, draw("text", len(SYNTHETIC_TEXTS)) + 1).alias("k"))
    hours = F.unix_seconds(F.lit("2017-01-01").cast("timestamp")) + i * 3600
    return drawn.select(
        (i + 1_000_000).cast("string").alias("tweet_id"),
        F.when(F.col("k.inbound"), (draw("author", 21) + 2000).cast("string")).otherwise(F.lit(DEFAULT_BRAND)).alias("author_id"),
        F.col("k.inbound").alias("inbound"),
        F.timestamp_seconds(hours).alias("created_at"),
        F.concat(F.col("k.text"), F.when(draw("tag", 10) == 0, F.lit(" #test")).otherwise(F.lit(""))).alias("text"),
        F.lit("").alias("response_tweet_id"),
        F.when(draw("link", 2) == 0, F.lit("")).otherwise((F.greatest(i - 1, F.lit(0)) + 1_000_000).cast("string")).alias("in_response_to_tweet_id"),
        F.lit(DEFAULT_BRAND).alias("brand"),
    )
