"""Rubric scores: the rule-based judge and the parser of model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyscope.constants import DIMENSIONS
from replyscope.functions.text import has_any_lowered, long_numbers


def judge_heuristic(reply: Column, corpus: Column) -> Column:
    """Four scores from 1 to 5. A reply is ungrounded when it has long numbers
    and none of them occurs in the retrieved texts."""
    text = F.lower(F.coalesce(reply, F.lit("")))
    corpus = F.lower(F.coalesce(corpus, F.lit("")))
    numbers = long_numbers(text)
    invented = (F.size(numbers) > 0) & ~F.exists(numbers, lambda n: F.contains(corpus, n))
    dm = F.contains(text, F.lit("dm"))
    return F.struct(
        F.when(invented, 1).when(has_any_lowered(text, ["please dm", "dm your"]), 4).otherwise(3).alias("groundedness"),
        F.when(dm & has_any_lowered(text, ["order", "details"]), 4).otherwise(2).alias("helpfulness"),
        F.when(has_any_lowered(text, ["sorry", "thanks"]) & (F.length(text) < 300), 4).otherwise(3).alias("brand_voice"),
        F.lit(5).alias("safety"),
        F.lit("heuristic").alias("rationale"),
        F.lit("heuristic").alias("evidence"),
    )


def extract_json_scores(response: Column, fallback: Column) -> Column:
    """Scores from the outermost braces of a model answer. A missing dimension
    counts as 3, numbers are truncated, anything unreadable gives the fallback."""
    body = F.regexp_extract(F.coalesce(response, F.lit("")), r"(?s)\{.*\}", 0)
    parsed = F.try_parse_json(F.nullif(body, F.lit("")))
    readable = parsed.isNotNull()
    scores = []
    for name in DIMENSIONS:
        item = F.try_variant_get(parsed, f"$.{name}", "variant")
        kind = F.schema_of_variant(item)
        text = F.trim(F.try_variant_get(parsed, f"$.{name}", "string"))
        # Text must be a whole number to be readable; real numbers are cut.
        usable = F.when(item.isNull(), True).when(
            kind == "STRING", text.rlike(r"^[+-]?[0-9]+$")
        ).otherwise(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"))
        value = (
            F.when(item.isNull(), 3)
            .when(kind == "STRING", text.try_cast("int"))
            .when(kind == "BOOLEAN", (text == "true").cast("int"))
            .otherwise(F.try_variant_get(parsed, f"$.{name}", "double").cast("int"))
        )
        readable = readable & F.coalesce(usable, F.lit(False))
        scores.append(value.alias(name))
    answer = F.struct(
        *scores,
        F.try_variant_get(parsed, "$.rationale", "string").alias("rationale"),
        F.try_variant_get(parsed, "$.evidence", "string").alias("evidence"),
    )
    return F.when(readable, answer).otherwise(fallback)
