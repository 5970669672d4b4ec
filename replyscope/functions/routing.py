"""Escalation rules as one ordered case expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyscope import constants as C
from replyscope.functions.text import has_any, has_word


def _decision(escalate: bool, reason: Column, category: str) -> Column:
    return F.struct(
        F.lit(escalate).alias("escalate"),
        reason.alias("escalate_reason"),
        F.lit(category).alias("escalate_category"),
    )


def route(text: Column, intent: Column, confidence: Column, thread_len: Column, prev: Column) -> Column:
    """Struct (escalate, escalate_reason, escalate_category); first rule wins."""
    both = F.concat(F.coalesce(text, F.lit("")), F.lit(" "), F.coalesce(prev, F.lit("")))
    low = F.format_string(C.REASON_LOW_CONFIDENCE, confidence)
    long = F.format_string(C.REASON_LONG.replace("%d", "%s"), thread_len.cast("string"))
    return (
        F.when(has_word(both, C.HUMAN_WORDS), _decision(True, F.lit(C.REASON_HUMAN), "policy"))
        .when(intent == C.COMPLAINT, _decision(True, F.lit(C.REASON_COMPLAINT), "high_risk"))
        .when(confidence < C.MIN_CONFIDENCE, _decision(True, low, "low_confidence"))
        .when(has_word(both, C.LEGAL_WORDS), _decision(True, F.lit(C.REASON_LEGAL), "policy"))
        .when(
            (intent == "account_access") & has_word(both, C.SENSITIVE_WORDS),
            _decision(True, F.lit(C.REASON_SENSITIVE), "sensitive"),
        )
        .when(thread_len > C.LONG_THREAD, _decision(True, long, "repeat"))
        .when(has_word(both, C.REPEAT_WORDS), _decision(True, F.lit(C.REASON_REPEAT), "repeat"))
        .otherwise(_decision(False, F.lit(C.REASON_AUTO), "auto"))
    )


def route_keyword_only(text: Column, intent: Column) -> Column:
    """Baseline router: any escalation keyword in text or intent name."""
    both = F.concat(F.coalesce(text, F.lit("")), F.lit(" "), F.coalesce(intent, F.lit("")))
    return F.when(
        has_word(both, C.ESCALATE_WORDS), _decision(True, F.lit("Keyword match"), "policy")
    ).otherwise(_decision(False, F.lit("No keyword"), "auto"))


def refine_intent(
    text: Column, prev: Column, model_intent: Column | None, model_confidence: Column | None, heuristic: Column
) -> Column:
    """Struct (intent, confidence): complaint words first, then the model, with
    the keyword label where the model is unsure."""

    def pair(intent: Column, confidence) -> Column:
        return F.struct(intent.alias("intent"), confidence.cast("double").alias("confidence"))

    full = F.concat_ws(" ", F.coalesce(text, F.lit("")), F.nullif(prev, F.lit("")))
    complaint = F.when(has_any(full, C.REFINE_COMPLAINT_WORDS), pair(F.lit(C.COMPLAINT), F.lit(0.85)))
    if model_intent is None:
        return complaint.otherwise(pair(heuristic, F.lit(0.5)))
    return complaint.when(
        (model_confidence < 0.5) & (heuristic != C.FALLBACK_INTENT), pair(heuristic, F.lit(0.55))
    ).otherwise(pair(model_intent, model_confidence))


def language_override(language: Column, refined: Column, decision: Column) -> dict[str, Column]:
    """Rows in another language become 'other' and are escalated by policy."""
    foreign = ~language.isin("en", "unknown", "err")
    reason = F.format_string(C.REASON_LANGUAGE, language)
    return {
        "intent": F.when(foreign, F.lit(C.FALLBACK_INTENT)).otherwise(refined["intent"]),
        "intent_confidence_gold": F.when(foreign, F.lit(0.4)).otherwise(refined["confidence"]),
        "escalate": F.when(foreign, F.lit(True)).otherwise(decision["escalate"]),
        "escalate_reason": F.when(foreign, reason).otherwise(decision["escalate_reason"]),
        "escalate_category": F.when(foreign, F.lit("policy")).otherwise(decision["escalate_category"]),
    }
