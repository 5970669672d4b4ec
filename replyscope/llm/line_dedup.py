"""Boilerplate lines by their frequency within a site.

For every host the pages that contain a line are divided by the pages of the
host; lines above a ratio are boilerplate and are dropped from the host's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import WORD, own_names, stored

RATIO = 0.1
MIN_PAGES = 5  # a line has to be on so many pages of the host
BROADCAST_LINES = 100_000  # up to so many boilerplate lines are sent to every task
SALTS = 64


def line_key(line: Column) -> Column:
    """128-bit identity of a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def host_of(url: str) -> Column:
    """The host of an address, in lower case; null for what is no address. Pages that
    carry one are grouped by it: drop_boilerplate(pages.withColumn("host", host_of("url")), host="host", text="html")."""
    return F.lower(F.try_parse_url(F.col(url), F.lit("HOST")))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host: str = "source", text: str = "text") -> DataFrame:
    """(host, lines): the keys of the lines with a word that occur on more than
    `ratio` of the host's pages and on `min_pages` at least. A page counts once for
    a line, however often it has it. Null hosts are one host. The list of a host is
    bounded: its pages' mean number of lines divided by the ratio."""
    lines = F.filter(F.split(F.col(text), "\n", -1), lambda x: x.rlike(WORD))
    keys = F.array_distinct(F.transform(lines, line_key))
    on_page = pages.select(F.col(host).alias("host"), F.explode(keys).alias("line"))
    counts = on_page.groupBy("host", "line").agg(F.count(F.lit(1)).alias("with_line")).filter(F.col("with_line") >= min_pages)
    total = stored(pages.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("pages")), "hosts")
    counts = stored(counts, "line_counts")
    often = counts.join(total.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
    often = often.filter(F.col("with_line") > ratio * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("line").alias("lines"))


@own_names("n_lines", "n_removed")
def drop_boilerplate(
    pages: DataFrame,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    host: str = "source",
    text: str = "text",
    broadcast_lines: int = BROADCAST_LINES,
) -> DataFrame:
    """`pages` with boilerplate lines dropped from `text`, and n_lines and
    n_removed (long). A null text stays null (0 lines); a text whose lines are all
    dropped becomes empty. Lines without a word are kept and never counted as
    boilerplate. Repeated rows are pages of their own; rows are never dropped and
    every other column is kept, except columns named n_lines and n_removed, which
    are replaced.

    The boilerplate table is counted before it is sent to every task; a larger one
    is joined on the host, with the host's pages dealt over salts."""
    bad = stored(boilerplate(pages, ratio, min_pages, host, text), "boilerplate")
    size = bad.agg(F.sum(F.size("lines"))).first()[0] or 0
    bad = bad.select(F.col("host").alias("_host"), F.col("lines").alias("_lines"))
    if size <= broadcast_lines:
        joined = pages.join(F.broadcast(bad), F.col(host).eqNullSafe(F.col("_host")), "left")
    else:
        salted = bad.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = pages.withColumn("_deal", F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, F.col(host).eqNullSafe(F.col("_host")) & (F.col("_deal") == F.col("_salt")), "left").drop("_salt", "_deal")
    lines = F.split(F.col(text), "\n", -1)
    is_bad = lambda x: x.rlike(WORD) & F.array_contains(F.col("_lines"), line_key(x))
    kept = F.when(F.col("_lines").isNull(), lines).otherwise(F.filter(lines, lambda x: ~is_bad(x)))
    out = joined.withColumn("_kept", kept).withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
    out = out.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.col("n_lines")).cast("long"))
    out = out.withColumn("n_removed", F.when(F.col(text).isNull(), 0).otherwise(F.col("n_lines") - F.size("_kept")).cast("long"))
    columns = [c for c in pages.columns if c not in ("n_lines", "n_removed")]
    new = [F.array_join("_kept", "\n").alias(c) if c == text else F.col(c) for c in columns]
    return out.select(*new, "n_lines", "n_removed")
