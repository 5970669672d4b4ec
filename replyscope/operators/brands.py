"""Selecting and counting rows by brand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.operators.sampling import hash_sample_n


def filter_brand(df: DataFrame, brand: str, min_rows: int | None = 500) -> DataFrame:
    """Rows of the brand; with a guard, all rows if the brand has too few."""
    inside = df.filter(F.col("brand") == brand)
    if min_rows is None:
        return inside
    return inside if inside.count() >= min_rows else df


def brand_stats(df: DataFrame) -> DataFrame:
    columns = [F.count(F.lit(1)).alias("total")]
    if "inbound" in df.columns:
        columns.append(F.count_if("inbound").alias("inbound_rows"))
    return df.groupBy("brand").agg(*columns)


def value_counts_topk(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col).limit(k)


def inbound_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(F.col("inbound").cast("double")).alias("inbound_rate"))


def brand_subset(raw: DataFrame, brand: str | None, n: int, seed: int = 42, key: str = "tweet_id") -> DataFrame:
    """Outbound rows of a brand plus the rows they answer, cut to a sample of n.

    Without a brand the sample is over everything. A brand with no outbound row
    gives a plain sample, one whose targets are all unknown is filled up with
    other rows."""
    if not brand:
        return hash_sample_n(raw, key, n, seed).withColumn("brand", F.lit("mixed"))
    outbound = raw.filter(F.col("author_id") == brand)
    if outbound.isEmpty():
        return hash_sample_n(raw, key, n, seed).withColumn("brand", F.lit(brand))
    targets = (
        outbound.select(F.col("in_response_to_tweet_id").alias(key))
        .filter(~F.col(key).isin("", "nan"))
        .distinct()
    )
    answered = raw.join(targets, key, "left_semi").select(*raw.columns)
    if answered.isEmpty():
        count = outbound.count()
        others = raw.filter(~F.col("author_id").eqNullSafe(brand))
        chosen = outbound.unionByName(hash_sample_n(others, key, n - count, seed)) if count < n else outbound
        return chosen.withColumn("brand", F.lit(brand))
    # The same tweet can be in both parts; the part makes the sample key unique.
    parts = outbound.withColumn("_part", F.lit("o")).unionByName(answered.withColumn("_part", F.lit("a")))
    parts = parts.withColumn("_key", F.concat_ws("-", key, "_part"))
    return hash_sample_n(parts, "_key", n, seed).drop("_key", "_part").withColumn("brand", F.lit(brand))
