"""Answering a batch of messages: classify, retrieve, draft, route."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope import constants as C
from replyscope.functions.judging import extract_json_scores, judge_heuristic
from replyscope.functions.labels import heuristic_label
from replyscope.functions.replies import template_reply, ungrounded_numbers
from replyscope.functions.routing import route, route_keyword_only
from replyscope.functions.text import build_query_text, pick_field, pick_length
from replyscope.operators.agreement import judge_averages
from replyscope.operators.classifier import score_intent
from replyscope.operators.index import Index
from replyscope.operators.retrieval import HOT_TEXTS, attach_hits, keyed_queries

RESULT = (
    "intent", "intent_confidence", "retrieved", "draft_reply", "draft_model",
    "escalate", "escalate_reason", "escalate_category",
)


def answer_batch(
    messages: DataFrame, index: Index, model: PipelineModel | None = None, alpha: float = 0.7, k: int = 3, hot_texts: int = HOT_TEXTS,
    reply: str | None = None, hits: DataFrame | None = None,
) -> DataFrame:
    """Input columns are kept, result columns are added or replaced. Retrieval
    runs once per distinct text and is joined back on it. Where a column of
    written replies is named, a non-empty one is the draft instead of the
    template, and `grounded` tells that all its long numbers were retrieved.
    `hits` (tweet_id, retrieved) replaces the retrieval here by hits found before,
    by vectors or reranked (see hybrid_vectors, rerank_fuse and collect_hits)."""
    have = messages.columns
    fields = messages.withColumns(
        {
            "_text": pick_field(["inbound_text", "text", "tweet_text"], have, ""),
            "_prev": pick_field(["prev_turn", "prev"], have, ""),
            "_len": pick_length("thread_len", have),
        }
    )
    scored = score_intent(fields.drop("intent", "intent_confidence"), model, "_text", fallback_confidence=0.45)
    keyed = keyed_queries(scored.withColumn("_query", build_query_text(F.col("_text"), F.col("_prev"))), "_query")
    if hits is None:
        found = attach_hits(keyed, index, alpha, k, hot_texts)
    else:
        found = keyed.drop("q_key", "q_text", "retrieved").join(hits.select("tweet_id", "retrieved"), "tweet_id", "left")
        found = found.withColumn("retrieved", F.coalesce("retrieved", F.array().cast(hits.schema["retrieved"].dataType)))
    decided = found.withColumn(
        "_decision", route(F.col("_text"), F.col("intent"), F.col("intent_confidence"), F.col("_len"), F.col("_prev"))
    )
    draft, source, grounded = template_reply(F.col("intent")), F.lit("heuristic"), []
    if reply:
        written = F.nullif(F.col(reply), F.lit(""))
        draft, source = F.coalesce(written, draft), F.when(written.isNotNull(), F.lit("given")).otherwise(source)
        grounded = [(~ungrounded_numbers(draft, _hit_texts())).alias("grounded")]
    return decided.select(
        *[c for c in have if c not in (*RESULT, *(["grounded"] if reply else []))],
        "intent",
        "intent_confidence",
        "retrieved",
        draft.alias("draft_reply"),
        source.alias("draft_model"),
        *grounded,
        "_decision.escalate",
        "_decision.escalate_reason",
        "_decision.escalate_category",
    )


def _replace(df: DataFrame, values: dict) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in values], *[v.alias(n) for n, v in values.items()])


def constant_prediction(df: DataFrame, intent: str = C.FALLBACK_INTENT) -> DataFrame:
    """Trivial baseline: the same answer for every row."""
    from replyscope.schemas import RETRIEVED

    return _replace(
        df,
        {
            "intent": F.lit(intent),
            "intent_confidence": F.lit(1.0),
            "escalate": F.lit(False),
            "escalate_reason": F.lit("trivial always auto"),
            "escalate_category": F.lit("auto"),
            "draft_reply": F.lit(C.CONSTANT_REPLY),
            "draft_model": F.lit("trivial"),
            "retrieved": F.array().cast(RETRIEVED),
        },
    )


def keyword_prediction(df: DataFrame) -> DataFrame:
    """Simple baseline: keyword label, keyword router, template reply."""
    from replyscope.schemas import RETRIEVED

    text = F.coalesce(F.col("inbound_text"), F.lit(""))
    labelled = df.withColumn("_intent", heuristic_label(text))
    decided = labelled.withColumn("_d", route_keyword_only(text, F.col("_intent")))
    replaced = _replace(
        decided,
        {
            "intent": F.col("_intent"),
            "intent_confidence": F.lit(0.6),
            "escalate": F.col("_d.escalate"),
            "escalate_reason": F.col("_d.escalate_reason"),
            "escalate_category": F.col("_d.escalate_category"),
            "draft_reply": template_reply(F.col("_intent")),
            "draft_model": F.lit("heuristic"),
            "retrieved": F.array().cast(RETRIEVED),
        },
    )
    return replaced.drop("_intent", "_d")


def _hit_texts() -> Column:
    return F.coalesce(F.array_join(F.transform("retrieved", lambda h: h["text"]), " "), F.lit(""))


def judge_batch(pred: DataFrame, response: str | None = None) -> tuple[DataFrame, DataFrame]:
    """((tweet_id, intent, scores, draft_reply), averages per dimension) of
    predictions. Scores come from the column of model answers, if one is named,
    and from the rules where an answer is missing or unreadable."""
    rules = judge_heuristic(F.col("draft_reply"), _hit_texts())
    scores = extract_json_scores(F.col(response), rules) if response else rules
    judged = pred.select("tweet_id", "intent", scores.alias("scores"), "draft_reply")
    return judged, judge_averages(judged)
