"""Schemas, as DDL text, of the records that enter and leave the engine."""

RETRIEVED = (
    "array<struct<doc_id: string, text: string, score: double, bm25: double, dense: double, ce: double>>"
)
SCORES = (
    "struct<groundedness: int, helpfulness: int, brand_voice: int, safety: int, rationale: string, evidence: string>"
)

# Raw CSV columns, all read as text and coerced afterwards.
RAW_COLUMNS = (
    "tweet_id",
    "author_id",
    "inbound",
    "created_at",
    "text",
    "response_tweet_id",
    "in_response_to_tweet_id",
)

GOLDEN = (
    "tweet_id STRING, brand STRING, inbound_text STRING, prev_turn STRING, thread_len INT, "
    "brand_reply STRING, created_at STRING, intent STRING, intent_rationale STRING, "
    "intent_confidence_gold DOUBLE, escalate BOOLEAN, escalate_reason STRING, "
    "escalate_category STRING, language STRING, needs_human_review BOOLEAN, human_labelled BOOLEAN"
)
PREDICTION = f"{GOLDEN}, intent_confidence DOUBLE, retrieved {RETRIEVED}, draft_reply STRING, draft_model STRING"
JUDGE = f"tweet_id STRING, intent STRING, scores {SCORES}, draft_reply STRING"
HUMAN = (
    "tweet_id STRING, groundedness_human INT, helpfulness_human INT, brand_voice_human INT, "
    "safety_human INT, rater STRING"
)
