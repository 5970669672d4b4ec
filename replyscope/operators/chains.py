"""Depth of reply chains over many hops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.operators.threads import _spread_missing
from replyscope.session import cut_lineage


def reply_chain_depth(raw: DataFrame) -> DataFrame:
    """(tweet_id, depth): messages from the start of the chain up to this one.

    Every row knows an ancestor and the distance to it; joining the table with
    itself doubles the distance, so a chain of n messages takes log2(n) joins.
    Rows that have reached the start leave the join. Ids count once, with the
    smallest parent. A chain of n messages is followed in log2(n) rounds, so what
    is still open after that many runs in a circle, or into one, and has no depth."""
    edges = raw.groupBy("tweet_id").agg(F.min("in_response_to_tweet_id").alias("up"))
    known = edges.select("tweet_id", F.lit(True).alias("is_known"))
    up = _spread_missing(F.col("up"), F.col("tweet_id"))
    parents = edges.withColumn("up", up).join(known.withColumnRenamed("tweet_id", "up"), "up", "left")
    # A parent outside the table ends the chain.
    jumps = parents.select("tweet_id", F.when(F.col("is_known"), F.col("up")).alias("up"))
    state = cut_lineage(jumps.withColumn("hops", F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long")))
    done = state.filter("up is null").select("tweet_id", (F.col("hops") + 1).alias("depth"))
    parts = [done]
    open_rows = state.filter("up is not null")
    reached, rows = 1, state.count()
    while reached <= rows and not open_rows.isEmpty():
        reached *= 2
        ahead = state.select(F.col("tweet_id").alias("up"), F.col("up").alias("next"), F.col("hops").alias("more"))
        moved = open_rows.join(ahead, "up").select("tweet_id", F.col("next").alias("up"), (F.col("hops") + F.col("more")).alias("hops"))
        moved = cut_lineage(moved)
        parts.append(moved.filter("up is null").select("tweet_id", (F.col("hops") + 1).alias("depth")))
        open_rows = moved.filter("up is not null")
        # Finished rows stay available as targets.
        state = cut_lineage(state.filter("up is null").unionByName(moved))
    depth = parts[0]
    parts.append(open_rows.select("tweet_id", F.lit(None).cast("long").alias("depth")))
    for part in parts[1:]:
        depth = depth.unionByName(part)
    return depth
