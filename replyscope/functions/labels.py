"""Keyword labels as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyscope.constants import COMPLAINT, FALLBACK_INTENT, LEXICON
from replyscope.functions.text import has_any_lowered


def _hits(lowered: Column, keywords: list[str]) -> Column:
    total = F.lit(0)
    for keyword in keywords:
        total = total + F.contains(lowered, F.lit(keyword)).cast("int")
    return total


def lexicon_hits(col: Column, lexicon: dict[str, list[str]] = LEXICON) -> dict[str, Column]:
    """Per intent, how many of its keywords occur in the text."""
    lowered = F.lower(F.coalesce(col, F.lit("")))
    return {intent: _hits(lowered, keywords) for intent, keywords in lexicon.items()}


def heuristic_label(
    col: Column, lexicon: dict[str, list[str]] = LEXICON, override: str | None = COMPLAINT
) -> Column:
    """Intent with most keyword hits. Ties go to the earlier intent, no hit
    gives the fallback, and any keyword of the override intent decides alone.

    Hits and position are packed into one integer, and a hit of the override
    intent outweighs any number of other hits, so every keyword is looked up
    once. The text is bound to a lambda variable: a filter on the label may be
    pushed down to where the text is computed, and without the binding that
    computation would be repeated for every keyword."""
    names = list(lexicon)
    base = len(names) + 1
    by_code = F.array(*[F.lit(name) for name in reversed(names)], F.lit(FALLBACK_INTENT))

    def label(lowered: Column) -> Column:
        packed = [
            _hits(lowered, keywords) * (base * 1_000 if intent == override else base) + (base - 2 - i)
            for i, (intent, keywords) in enumerate(lexicon.items())
        ]
        best = F.greatest(*packed, F.lit(base - 1))
        return F.element_at(by_code, (F.pmod(best, F.lit(base)) + 1).cast("int"))

    return F.element_at(F.transform(F.array(F.lower(F.coalesce(col, F.lit("")))), label), 1)


def scaffold_labels(text: Column, thread_len: Column) -> dict[str, Column]:
    """Draft labels of a new golden row. A long thread escalates but keeps the
    category auto."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    intent = heuristic_label(text)
    hacked = has_any_lowered(lowered, ["hacked"])
    escalate = (intent == COMPLAINT) | hacked | (thread_len > 4)
    return {
        "intent": intent,
        "intent_rationale": F.concat(F.lit("heuristic: keyword match "), intent),
        "escalate": escalate,
        "escalate_reason": F.when(escalate, F.lit("heuristic: complaint/sensitive/long thread")).otherwise(
            F.lit("heuristic: confident auto")
        ),
        "escalate_category": F.when(intent == COMPLAINT, F.lit("high_risk"))
        .when(hacked, F.lit("sensitive"))
        .otherwise(F.lit("auto")),
        "needs_human_review": F.lit(True),
    }
