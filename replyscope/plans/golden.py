"""Building and refining the labelled evaluation set."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.constants import INTENTS
from replyscope.functions.labels import heuristic_label, scaffold_labels
from replyscope.functions.routing import language_override, refine_intent, route
from replyscope.operators.brands import filter_brand
from replyscope.operators.classifier import score_intent
from replyscope.operators.dedup import dedup_keep_first
from replyscope.operators.language import detect_language
from replyscope.operators.sampling import cap_majority, fill_to_n, hash_shuffle, stratified_sample, topup_per_class
from replyscope.operators.threads import build_threads
from replyscope.session import cut_lineage

COMMON = ("tweet_id", "brand", "inbound_text", "prev_turn", "thread_len", "brand_reply")


def make_golden(raw: DataFrame, n: int = 200, brand: str | None = None, min_brand_rows: int = 500, seed: int = 42) -> DataFrame:
    """Sample of threads with draft labels: brand filter, threads, removal of
    near duplicates, stratified sample, keyword labels, shuffle. With fewer
    threads than n all of them are taken as they are."""
    rows = filter_brand(raw, brand, min_brand_rows) if brand else raw
    threads = cut_lineage(build_threads(rows))
    if threads.count() >= n:
        unique = dedup_keep_first(threads, "tweet_id", "inbound_text", ["created_at"], thresh=0.95)
        threads = stratified_sample(cut_lineage(unique), n, seed=seed)
    labels = scaffold_labels(F.col("inbound_text"), F.col("thread_len"))
    golden = threads.select(*COMMON, F.col("created_at").cast("string").alias("created_at"), *[v.alias(c) for c, v in labels.items()])
    return hash_shuffle(golden, "tweet_id", seed)


def _relabel(rows: DataFrame, model: PipelineModel | None, languages: DataFrame) -> DataFrame:
    """Refined intent and route of golden rows, with the language rule."""
    text = F.coalesce(F.col("inbound_text"), F.lit(""))
    prev = F.coalesce(F.col("prev_turn"), F.lit(""))
    old = ("intent", "intent_rationale", "intent_confidence_gold", "escalate", "escalate_reason", "escalate_category", "language", "needs_human_review", "human_labelled")
    base = rows.drop(*old).join(languages, "tweet_id")
    if model is None:
        refined = base.withColumn("_r", refine_intent(text, prev, None, None, heuristic_label(text)))
    else:
        scored = score_intent(base, model)
        refined = scored.withColumn(
            "_r", refine_intent(text, prev, F.col("intent"), F.col("intent_confidence"), heuristic_label(text))
        ).drop("intent", "intent_confidence")
    decided = refined.withColumn(
        "_d", route(text, F.col("_r.intent"), F.col("_r.confidence"), F.coalesce(F.col("thread_len"), F.lit(1)), prev)
    )
    values = language_override(F.col("language"), F.col("_r"), F.col("_d"))
    labelled = decided.select(*[c for c in base.columns if c != "language"], "language", *[v.alias(c) for c, v in values.items()])
    return labelled.withColumns({"needs_human_review": F.lit(False), "human_labelled": F.lit(True)})


def refine_golden(
    golden: DataFrame,
    threads: DataFrame,
    profiles: DataFrame,
    model: PipelineModel | None = None,
    n: int = 200,
    min_per_class: int = 15,
    capped: tuple[str, ...] = ("order_shipping", "other"),
    cap: int = 35,
    seed: int = 42,
) -> DataFrame:
    """Relabels the golden rows, lifts rare classes, trims frequent ones or
    fills up to n rows, and shuffles."""

    def rationale(extra):
        return F.concat(F.lit("human-reviewed: "), F.col("intent"), extra)

    spoken = detect_language(golden, profiles, "tweet_id", "inbound_text")
    first = _relabel(golden, model, spoken)
    conf = F.format_string(" (conf %.2f, lang %s)", F.col("intent_confidence_gold"), F.col("language"))
    first = cut_lineage(first.withColumn("intent_rationale", rationale(conf)).withColumn("created_at", F.col("created_at").cast("string")))

    pool = score_intent(threads, model, fallback_confidence=0.5)
    pool = pool.withColumnsRenamed({"intent": "pred_intent", "intent_confidence": "pred_conf"})
    languages = detect_language(threads, profiles, "tweet_id", "inbound_text")
    pool = cut_lineage(pool.join(languages, "tweet_id"))
    english = pool.filter("language = 'en'")
    added = topup_per_class(first, english, list(INTENTS), min_per_class, seed=seed)
    decision = route(F.col("inbound_text"), F.col("pred_intent"), F.col("pred_conf"), F.col("thread_len"), F.col("prev_turn"))
    added = added.withColumn("_d", decision).select(
        *COMMON, F.col("created_at").cast("string").alias("created_at"), F.col("pred_intent").alias("intent"),
        F.concat(F.lit("human-reviewed: "), F.col("pred_intent"), F.format_string(" (added for balance, conf %.2f)", F.col("pred_conf"))).alias("intent_rationale"),
        "_d.escalate", "_d.escalate_reason", "_d.escalate_category", "language",
        F.lit(False).alias("needs_human_review"), F.lit(True).alias("human_labelled"),
    )
    refined = cut_lineage(first.unionByName(added, allowMissingColumns=True))
    count = refined.count()
    if count > n:
        refined = cap_majority(refined, n, list(capped), cap, seed=seed)
    elif count < n:
        extra = fill_to_n(refined, pool, n, F.col("language") == "en")
        extra = _relabel(extra.drop("language").select(*COMMON, "created_at"), model, languages)
        extra = extra.withColumn("intent_rationale", rationale(F.lit(""))).withColumn("created_at", F.col("created_at").cast("string"))
        refined = refined.unionByName(extra.drop("intent_confidence_gold"), allowMissingColumns=True)
    return hash_shuffle(refined, "tweet_id", 123)


def agreement_sample(golden: DataFrame, n: int = 50, seed: int = 123) -> DataFrame:
    """The first rows of the shuffled set, for rating by a person."""
    return hash_shuffle(golden, "tweet_id", seed).limit(n)
