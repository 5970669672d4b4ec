"""Reply threads by joins over tweet ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.constants import DEFAULT_BRAND


def _spread_missing(key: Column, row_id: Column) -> Column:
    """Most tweets answer nothing. Their empty join key would send all of them
    to one task, so it is replaced by keys that match nothing, spread by row."""
    filler = F.concat(F.lit("\u0000none-"), F.pmod(F.xxhash64(row_id), F.lit(4096)).cast("string"))
    return F.coalesce(F.nullif(F.nullif(F.trim(key), F.lit("")), F.lit("nan")), filler)


def build_threads(raw: DataFrame, order_col: str = "row_ord") -> DataFrame:
    """One row per inbound tweet with its reply and parent text.

    The reply is the text of the first listed response id, or of the first
    outbound row that answers the tweet. Repeated ids resolve to the last row in
    order_col. Lookups are aggregated to one row per id before they are joined,
    so a tweet with millions of answers stays one row on the build side; a
    parent with millions of answers is a skewed probe side, which adaptive
    execution splits."""
    text_by_id = raw.groupBy("tweet_id").agg(F.max_by("text_clean", order_col).alias("found"))
    first_answer = (
        raw.filter(~F.col("inbound") & (F.col("in_response_to_tweet_id") != ""))
        .groupBy(F.col("in_response_to_tweet_id").alias("tweet_id"))
        .agg(F.min_by("text_clean", order_col).alias("answer"))
    )
    listed = F.element_at(F.split(F.coalesce(F.col("response_tweet_id"), F.lit("")), ","), 1)
    brand = F.col("brand") if "brand" in raw.columns else F.lit(DEFAULT_BRAND)
    inbound = raw.filter("inbound").select(
        "tweet_id",
        "author_id",
        "created_at",
        brand.alias("brand"),
        F.col("text_clean").alias("inbound_text"),
        F.col("text").alias("inbound_raw"),
        _spread_missing(listed, F.col("tweet_id")).alias("_listed"),
        _spread_missing(F.col("in_response_to_tweet_id"), F.col("tweet_id")).alias("_parent"),
    )
    joined = (
        inbound.join(first_answer, "tweet_id", "left")
        .join(text_by_id.select(F.col("tweet_id").alias("_listed"), F.col("found").alias("_reply")), "_listed", "left")
        .join(text_by_id.select(F.col("tweet_id").alias("_parent"), F.col("found").alias("_prev")), "_parent", "left")
    )
    reply = F.coalesce(F.nullif(F.col("_reply"), F.lit("")), F.col("answer"), F.lit(""))
    prev = F.coalesce(F.col("_prev"), F.lit(""))
    return joined.select(
        "tweet_id",
        "author_id",
        "created_at",
        "brand",
        "inbound_text",
        "inbound_raw",
        reply.alias("brand_reply"),
        prev.alias("prev_turn"),
        (F.lit(1) + (reply != "").cast("int") + (prev != "").cast("int")).alias("thread_len"),
        F.lit(True).alias("inbound"),
    )


def nonempty_docs(threads: DataFrame, fallback_to_inbound: bool = True) -> DataFrame:
    """Retrieval documents (doc_id, text): the reply, else the message; blank
    texts are dropped. A blank reply is not replaced by the message."""
    from replyscope.functions.text import strip_text

    text = F.nullif(F.col("brand_reply"), F.lit(""))
    if fallback_to_inbound:
        text = F.coalesce(text, F.col("inbound_text"))
    return threads.select(F.col("tweet_id").cast("string").alias("doc_id"), strip_text(text).alias("text")).filter(
        F.col("text") != ""
    )


def raw_as_docs(raw: DataFrame) -> DataFrame:
    """Every cleaned row is a document, for inputs without threads."""
    from replyscope.functions.text import strip_text

    return raw.select(F.col("tweet_id").alias("doc_id"), strip_text(F.col("text_clean")).alias("text")).filter(
        F.col("text") != ""
    )


def reply_coverage(threads: DataFrame) -> DataFrame:
    return threads.agg(
        F.count(F.lit(1)).alias("threads"), F.count_if(F.col("brand_reply") != "").alias("with_reply")
    )
