"""Shared Spark inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.functions.labels import heuristic_label
from replyscope.operators.threads import build_threads
from replyscope.sources.tables import messages, table

__all__ = ["aligned_labels", "documents", "messages", "r6", "stamp", "table", "threads"]


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads of the message view, with the numeric id as row_ord."""
    return build_threads(messages(spark, sf_dir)).withColumn("row_ord", F.col("tweet_id").cast("long"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def stamp(col: str):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def r6(col):
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


def aligned_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label of the message as truth, label of its reply as prediction; draft
    escalation as truth, keyword escalation as prediction."""
    from replyscope.functions.labels import scaffold_labels
    from replyscope.functions.routing import route_keyword_only

    t = threads(spark, sf_dir)
    truth = heuristic_label(F.col("inbound_text"))
    pred = heuristic_label(F.col("brand_reply"))
    return t.select(
        "tweet_id",
        "row_ord",
        truth.alias("gold_intent"),
        pred.alias("pred_intent"),
        scaffold_labels(F.col("inbound_text"), F.col("thread_len"))["escalate"].alias("gold_escalate"),
        route_keyword_only(F.col("inbound_text"), F.lit(""))["escalate"].alias("pred_escalate"),
    )
