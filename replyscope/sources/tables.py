"""The given tables, and the message view over the conversations table.

The texts of the conversations table are invented and contain hardly any word
of the lexicon, so the view puts a support phrase in front of every turn. Every
row of the table becomes one message."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.functions.text import clean_text

PHRASES = (
    "Where is the parcel, my order shows no tracking movement",
    "I was charged twice, please refund the second payment",
    "My password reset mail never came and the account is locked",
    "The app keeps crashing since the last update",
    "I want to cancel and return the blue chair",
    "This is the worst service, I want a manager",
    "What is your policy and do you ship to Norway?",
    "Thank you, all good now",
    "Good morning @helpdesk_9 see https://example.org/a?b=1 for the photo",
    "My account was hacked and an unauthorized login happened",
    "The issue is back again, still not solved",
    "Can I talk to a human please",
    "The invoice for order 12345678901 is wrong",
    "A lawsuit will follow if the police ask",
    "How to exchange a broken lamp? The delivery time is unclear",
    "My delayed package arrived open",
    "Please let an agent please call, second time asking",
    "Where is my order? It was a double charged payment",
    "Two-factor 2FA code does not arrive, I need to verify identity",
    "The screen has a defect and a bug, it won't turn on",
    "Fraud! Someone used my billing data",
    "Your hours are unclear, when will the shop open",
    "Ok",
    "Refund my order or I escalate this complaint to a lawyer",
)
EPOCH_2017_10_01 = 1_506_816_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw table of messages: tweet ids, reply links, brand, time and text."""
    row_id = F.col("conv_id") * 1000 + F.col("turn")
    inbound = F.col("role") == "user"
    brand = F.concat(F.lit("brand"), (F.col("conv_id") % 5).cast("string"))
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), ((F.col("conv_id") * 7 + F.col("turn") * 3) % 24 + 1).cast("int"))
    text = F.concat(phrase, F.lit(" "), F.coalesce("text", F.lit("")))
    next_id = (row_id + 1).cast("string")
    link = (F.col("conv_id") + F.col("turn")) % 3
    return table(spark, sf_dir, "conversations").select(
        row_id.cast("string").alias("tweet_id"),
        F.when(inbound, F.concat(F.lit("u"), F.col("conv_id").cast("string"))).otherwise(brand).alias("author_id"),
        inbound.alias("inbound"),
        F.timestamp_seconds(F.lit(EPOCH_2017_10_01) + F.col("conv_id") * 2220 + F.col("turn") * 180).alias("created_at"),
        text.alias("text"),
        F.when(link == 0, next_id)
        .when(link == 1, F.lit(""))
        .otherwise(F.concat(next_id, F.lit(","), (row_id + 2).cast("string")))
        .alias("response_tweet_id"),
        F.when(F.col("turn") > 0, (row_id - 1).cast("string")).otherwise(F.lit("")).alias("in_response_to_tweet_id"),
        brand.alias("brand"),
        clean_text(text).alias("text_clean"),
        row_id.alias("row_ord"),
    )
