"""Agreement between human and judge ratings.

Every statistic is computed from the counts of (human, judge) pairs per
dimension. Ratings on a scale of five give a few dozen rows; fractions are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.constants import DIMENSIONS


def join_ratings(human: DataFrame, judge: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Inner join on the id; rating columns end in _human and _judge. Columns
    that already have their ending are taken as they are."""

    def suffixed(df: DataFrame, suffix: str) -> DataFrame:
        named = [F.col(d if d in df.columns else d + suffix).alias(d + suffix) for d in DIMENSIONS]
        return df.select(key, *named)

    return suffixed(human, "_human").join(suffixed(judge, "_judge"), key)


def pair_counts(joined: DataFrame, dims=DIMENSIONS) -> DataFrame:
    """Long counts (dim, h, j, n)."""
    pairs = F.array(
        *[
            F.struct(F.lit(d).alias("dim"), F.col(f"{d}_human").cast("double").alias("h"), F.col(f"{d}_judge").cast("double").alias("j"))
            for d in dims
        ]
    )
    return joined.select(F.inline(pairs)).groupBy("dim", "h", "j").agg(F.count(F.lit(1)).alias("n"))


def qwk(counts: DataFrame) -> DataFrame:
    """Quadratic weighted kappa per dimension over the labels present; the
    distance is between positions in the sorted label list. Null where the
    expected disagreement is zero."""
    label = F.explode(F.array("h", "j")).alias("label")
    ranked = (
        counts.select("dim", label).distinct().withColumn("pos", F.dense_rank().over(Window.partitionBy("dim").orderBy("label")))
    )
    h_pos = ranked.select("dim", F.col("label").alias("h"), F.col("pos").alias("hp"))
    j_pos = ranked.select("dim", F.col("label").alias("j"), F.col("pos").alias("jp"))
    placed = counts.join(h_pos, ["dim", "h"]).join(j_pos, ["dim", "j"])
    # Sum over all label pairs of marginal * marginal * distance^2, by moments.
    hp, jp, n = F.col("hp"), F.col("jp"), F.col("n")
    sums = placed.groupBy("dim").agg(
        F.sum(n).alias("n"),
        F.sum(n * (hp - jp) * (hp - jp)).alias("observed"),
        F.sum(n * hp).alias("h1"),
        F.sum(n * jp).alias("j1"),
        F.sum(n * hp * hp).alias("h2"),
        F.sum(n * jp * jp).alias("j2"),
    )
    expected = (F.col("h2") + F.col("j2")) - 2 * F.col("h1") * F.col("j1") / F.col("n")
    return sums.select("dim", "n", (1 - F.col("observed") / F.nullif(expected, F.lit(0.0))).alias("qwk"))


def spearman(counts: DataFrame) -> DataFrame:
    """Rank correlation with average ranks; null for a constant rater."""

    def ranks(col: str) -> DataFrame:
        values = counts.groupBy("dim", col).agg(F.sum("n").alias("m"))
        upto = F.sum("m").over(Window.partitionBy("dim").orderBy(col))
        return values.select("dim", col, (upto - (F.col("m") - 1) / 2.0).alias(col + "_rank"))

    ranked = counts.join(ranks("h"), ["dim", "h"]).join(ranks("j"), ["dim", "j"])
    x, y, n = F.col("h_rank"), F.col("j_rank"), F.col("n")
    sums = ranked.groupBy("dim").agg(
        F.sum(n).alias("n"), F.sum(n * x).alias("x"), F.sum(n * y).alias("y"),
        F.sum(n * x * x).alias("xx"), F.sum(n * y * y).alias("yy"), F.sum(n * x * y).alias("xy"),
    )
    cov = F.col("xy") - F.col("x") * F.col("y") / F.col("n")
    vx = F.col("xx") - F.col("x") * F.col("x") / F.col("n")
    vy = F.col("yy") - F.col("y") * F.col("y") / F.col("n")
    constant = (vx <= 0) | (vy <= 0)
    return sums.select("dim", F.when(~constant, cov / F.sqrt(vx * vy)).alias("spearman"))


def within_one(counts: DataFrame) -> DataFrame:
    near = F.sum(F.when(F.abs(F.col("h") - F.col("j")) <= 1, F.col("n")).otherwise(0))
    return counts.groupBy("dim").agg((near / F.sum("n")).alias("within_one"))


def agreement(human: DataFrame, judge: DataFrame, key: str = "tweet_id") -> DataFrame:
    """(dim, n, qwk, spearman, within_one), one row per dimension."""
    counts = pair_counts(join_ratings(human, judge, key))
    return qwk(counts).join(spearman(counts), "dim").join(within_one(counts), "dim")


def judge_averages(judged: DataFrame, scores: str = "scores") -> DataFrame:
    """Mean per dimension; no row for an empty input."""
    means = judged.agg(*[F.avg(F.col(scores)[d]).alias(d) for d in DIMENSIONS])
    return means.filter(F.col(DIMENSIONS[0]).isNotNull())
