"""Time-based train/test splits as filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.operators.ordering import split_at, time_key
from replyscope.operators.sampling import exact_split


def sort_threads(threads: DataFrame, key: str = "tweet_id") -> DataFrame:
    """By time, missing times last."""
    return threads.orderBy(F.col("created_at").asc_nulls_last(), key)


def time_split_ratio(threads: DataFrame, ratio: float, key: str = "tweet_id") -> tuple[DataFrame, DataFrame]:
    """The first int(n * ratio) rows by time are the train part."""
    n = threads.count()
    return split_at(threads, time_key(F.col("created_at"), F.col(key)), int(n * ratio))


def time_split_cutoff(
    threads: DataFrame,
    cutoff: str,
    test_ratio: float,
    min_test: int = 200,
    null_dates: str = "drop",
    key: str = "tweet_id",
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """train < cutoff <= test. With fewer than min_test test rows the tail of
    the time order is the test part; without any date the split is random.
    Rows without a date are in neither part unless null_dates is 'test'."""
    moment = F.lit(cutoff).cast("timestamp")
    when = F.col("created_at")
    total, dated, late = threads.agg(
        F.count(F.lit(1)), F.count(when), F.count_if(when >= moment)
    ).first()
    if dated == 0:
        test_n = -int(-total * test_ratio // 1)  # rounded up
        return exact_split(threads, key, test_n, seed)
    if late < min_test:
        return split_at(threads, time_key(when, F.col(key)), int(total * (1 - test_ratio)))
    test = when >= moment
    if null_dates == "test":
        test = test | when.isNull()
    return threads.filter(when < moment), threads.filter(test)


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"), F.count(F.lit(1)).alias("n")
    )
