"""Queries over metrics, rater agreement and distributions."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from replyscope import constants as C
from replyscope.functions import judging, replies, text as X
from replyscope.functions.labels import heuristic_label, scaffold_labels
from replyscope.plans.answer import judge_batch as judge
from replyscope.operators import agreement as A, chains, metrics as M, threads as T
from replyscope.registry import sql as S
from replyscope.registry.inputs import aligned_labels, documents, messages, r6, table, threads
from replyscope.registry.text import judge_sql
from replyscope.schemas import RETRIEVED
from replyscope.session import scratch_path
from replyscope.sources.raw import write_metrics as save_metrics

def _rounded(df, *keep):
    return df.select(*[F.col(c) if c in keep or t in ("string", "bigint") else r6(c).alias(c) for c, t in df.dtypes])

def label_distribution(spark, d):
    t = threads(spark, d).withColumn("intent", heuristic_label(F.col("inbound_text")))
    t = t.withColumn("escalate", scaffold_labels(F.col("inbound_text"), F.col("thread_len"))["escalate"])
    return _rounded(M.label_distribution(t))

def intent_confusion(spark, d):
    return M.intent_confusion(aligned_labels(spark, d))

def intent_metrics(spark, d):
    return _rounded(M.intent_metrics(aligned_labels(spark, d)))

def class_report(spark, d):
    return _rounded(M.class_report(aligned_labels(spark, d)))

def quality_report(spark, d):
    """Document quality labels against a text rule."""
    marked = table(spark, d, "labels").join(documents(spark, d), "doc_id")
    rows = marked.select(
        F.col("quality").cast("string").alias("gold_intent"),
        (F.col("n_chars") < 2000).cast("int").cast("string").alias("pred_intent"),
    )
    return _rounded(M.class_report(rows))

def escalate_metrics(spark, d):
    return _rounded(M.escalate_metrics(aligned_labels(spark, d)))

def headline(spark, d):
    a = aligned_labels(spark, d)
    return M.headline(M.intent_metrics(a), M.escalate_metrics(a)).select(r6("headline").alias("headline"))

def _with_scores(df):
    """A retrieved list of zero to three hits with scores from the row id."""
    numbers = F.when(F.col("row_ord") % 4 > 0, F.sequence(F.lit(1), (F.col("row_ord") % 4).cast("int"))).otherwise(F.array().cast("array<int>"))

    def hit(i):
        score = ((F.col("row_ord") * 7 + i) % 100) / 100.0
        none = F.lit(None).cast("double")
        return F.struct(
            i.cast("string").alias("doc_id"), F.lit("t").alias("text"), score.alias("score"), none.alias("bm25"), none.alias("dense"), none.alias("ce")
        )

    return df.withColumn("retrieved", F.transform(numbers, hit).cast(RETRIEVED))

def retrieval_proxy(spark, d):
    return _rounded(M.retrieval_proxy(_with_scores(threads(spark, d))))

def _documents_to_measure(spark, d):
    a = aligned_labels(spark, d)
    gold = a.select("tweet_id", "row_ord", F.col("gold_intent").alias("intent"), F.col("gold_escalate").alias("escalate"))
    pred = a.select("tweet_id", "row_ord", F.col("pred_intent").alias("intent"), F.col("pred_escalate").alias("escalate"))
    return gold, _with_scores(pred)

def evaluate_all(spark, d):
    m = M.evaluate_all(*_documents_to_measure(spark, d))
    return m.select(
        r6("intent.accuracy").alias("intent_accuracy"), r6("intent.macro_f1").alias("macro_f1"), F.col("intent.n").alias("n"),
        r6("escalate.f1").alias("escalate_f1"), r6("retrieval.avg_score").alias("avg_score"), r6("headline").alias("headline"),
    )

def evaluate_named(spark, d):
    """Labels under their other names on one side, half of the usual ones empty."""
    gold, pred = _documents_to_measure(spark, d)
    gold = gold.withColumn("label", F.col("intent")).withColumn("intent", F.when(F.col("row_ord") % 2 == 0, F.col("intent")).otherwise(F.lit("")))
    m = M.evaluate_all(gold, pred.withColumnRenamed("escalate", "escalate_label"))
    return m.select(r6("intent.macro_f1").alias("macro_f1"), r6("escalate.f1").alias("escalate_f1"), F.col("retrieval.n").alias("with_hits"))

def judge_batch(spark, d):
    """Judge over drafted threads: scores per message next to the averages."""
    reply = F.when(F.col("row_ord") % 5 == 0, F.col("brand_reply")).otherwise(replies.template_reply(heuristic_label(F.col("inbound_text"))))
    none = F.lit(None).cast("double")
    hit = F.struct(F.lit("p").alias("doc_id"), F.col("prev_turn").alias("text"), none.alias("score"), none.alias("bm25"), none.alias("dense"), none.alias("ce"))
    pred = threads(spark, d).withColumns({"draft_reply": reply, "intent": heuristic_label(F.col("inbound_text")), "retrieved": F.array(hit).cast(RETRIEVED)})
    answer_text = F.when(F.col("row_ord") % 3 == 0, F.lit('So: {"groundedness": 2, "helpfulness": 1, "brand_voice": 5, "safety": 4}')).otherwise(F.lit("no scores"))
    judged, means = judge(pred.withColumn("answer", answer_text), "answer")
    rows = judged.select("tweet_id", "intent", F.md5("draft_reply").alias("draft"), *[F.col("scores")[x].cast("double").alias(x) for x in C.DIMENSIONS])
    return rows.unionByName(_rounded(means).select(F.lit("mean").alias("tweet_id"), F.lit("").alias("intent"), F.lit("").alias("draft"), *C.DIMENSIONS))

def write_metrics(spark, d):
    path = scratch_path(spark, "metrics")
    save_metrics(M.evaluate_all(*_documents_to_measure(spark, d)), path)
    back = spark.read.schema("intent STRUCT<macro_f1: DOUBLE, n: BIGINT>, headline DOUBLE").json(path)
    return back.select(r6("intent.macro_f1").alias("macro_f1"), F.col("intent.n").alias("n"), r6("headline").alias("headline"))

# --- ratings -----------------------------------------------------------------------
def _human(spark, d):
    """Ratings made from the row id, for two of three threads."""
    t = threads(spark, d).filter(F.col("row_ord") % 3 != 0)
    return t.select(
        "tweet_id",
        (F.col("row_ord") % 3 + 3).cast("int").alias("groundedness"),
        (F.col("row_ord") % 4 + 1).cast("int").alias("helpfulness"),
        F.when(F.col("row_ord") % 2 == 0, 2).otherwise(4).alias("brand_voice"),
        F.lit(5).alias("safety"),
    )

def _judged(spark, d):
    t = threads(spark, d)
    reply = F.when(F.col("row_ord") % 5 == 0, F.col("brand_reply")).otherwise(replies.template_reply(heuristic_label(F.col("inbound_text"))))
    return t.select("tweet_id", judging.judge_heuristic(reply, F.col("prev_turn")).alias("scores"))

def _judge_flat(spark, d):
    return _judged(spark, d).select("tweet_id", *[F.col("scores")[x].alias(x) for x in C.DIMENSIONS])

def join_ratings(spark, d):
    joined = A.join_ratings(_human(spark, d), _judge_flat(spark, d))
    return joined.select("tweet_id", *[F.col(c).cast("long").alias(c) for c in joined.columns if c != "tweet_id"])

def _counts(spark, d):
    return A.pair_counts(A.join_ratings(_human(spark, d), _judge_flat(spark, d)))

def qwk(spark, d):
    return _rounded(A.qwk(_counts(spark, d)))

def spearman(spark, d):
    return _rounded(A.spearman(_counts(spark, d)))

def within_one(spark, d):
    return _rounded(A.within_one(_counts(spark, d)))

def agreement(spark, d):
    return _rounded(A.agreement(_human(spark, d), _judge_flat(spark, d)))

def judge_averages(spark, d):
    return _rounded(A.judge_averages(_judged(spark, d)))

def reply_coverage(spark, d):
    return T.reply_coverage(threads(spark, d))

# --- measures named by the evaluation report -------------------------------------------
def threshold_sweep(spark, d):
    t = threads(spark, d).withColumn("intent_confidence", F.round((F.col("row_ord") % 89) / 89.0, 6))
    return _rounded(M.threshold_sweep(t, [0.4, 0.5, 0.55, 0.6, 0.7]))

def escalate_auroc(spark, d):
    a = aligned_labels(spark, d).withColumn("score", F.round((F.col("row_ord") % 89) / 89.0, 6))
    return _rounded(M.escalate_auroc(a, "score"))

def bootstrap_ci(spark, d):
    """Every thread draws its own weight in every resample."""
    return _rounded(M.bootstrap_ci(aligned_labels(spark, d), key="tweet_id"))

def reply_chain_depth(spark, d):
    return chains.reply_chain_depth(messages(spark, d)).select("tweet_id", F.col("depth").cast("long").alias("depth"))

PAIRS = f"""pairs AS MATERIALIZED (
  SELECT tweet_id, row_ord, {S.label('inbound_text')} AS truth, {S.label('brand_reply')} AS pred,
         {S.label('inbound_text')} = 'complaint_escalation' OR contains(lower(inbound_text), 'hacked') OR thread_len > 4 AS t,
         {S.word_test("(inbound_text || ' ')", C.ESCALATE_WORDS)} AS p
  FROM threads
)"""
SCORES = """classes AS (SELECT truth AS label FROM pairs UNION SELECT pred FROM pairs), scores AS (
  SELECT label, (SELECT count(*) FROM pairs WHERE truth = label) AS support,
         coalesce((SELECT count(*) FROM pairs WHERE truth = label AND pred = label) / nullif((SELECT count(*) FROM pairs WHERE pred = label), 0), 0) AS precision,
         coalesce((SELECT count(*) FROM pairs WHERE truth = label AND pred = label) / nullif((SELECT count(*) FROM pairs WHERE truth = label), 0), 0) AS recall
  FROM classes
), f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM scores)"""
REPORT = """SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f
  UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), n FROM (SELECT avg((truth = pred)::INT) AS a, count(*) AS n FROM pairs)
  UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
  UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
    round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f"""
ESC = """esc AS (SELECT count(*) FILTER (WHERE t AND p) AS tp, count(*) FILTER (WHERE NOT t AND p) AS fp,
  count(*) FILTER (WHERE t AND NOT p) AS fn, count(*) FILTER (WHERE NOT t AND NOT p) AS tn FROM pairs)"""
ESC_F1 = "(SELECT coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) FROM esc)"
MACRO = "(SELECT avg(f1) FROM f)"
HITS = """hits AS (SELECT row_ord, list_transform(range(1, row_ord % 4 + 1), lambda i: ((row_ord * 7 + i) % 100) / 100.0) AS s FROM threads),
proxy AS (SELECT coalesce(round(avg(list_sum(s) / len(s)), 6), 0) AS avg_score, count(*) AS n FROM hits WHERE len(s) > 0)"""
_REPLY = f"CASE WHEN row_ord % 5 = 0 THEN brand_reply ELSE {S.template(S.label('inbound_text'))} END"
_JUDGE = judge_sql("reply", "prev_turn")
RATINGS = f"""drafted AS MATERIALIZED (SELECT tweet_id, row_ord, prev_turn, {_REPLY} AS reply FROM threads),
judged AS MATERIALIZED (SELECT tweet_id, row_ord, {', '.join(f'{v} AS {k}' for k, v in _JUDGE.items())} FROM drafted),
rated AS (SELECT tweet_id, row_ord % 3 + 3 AS groundedness_human, row_ord % 4 + 1 AS helpfulness_human,
  CAST(CASE WHEN row_ord % 2 = 0 THEN 2 ELSE 4 END AS BIGINT) AS brand_voice_human, CAST(5 AS BIGINT) AS safety_human,
  groundedness AS groundedness_judge, helpfulness AS helpfulness_judge, brand_voice AS brand_voice_judge, safety AS safety_judge
  FROM judged WHERE row_ord % 3 <> 0),
flat AS ({' UNION ALL '.join(f"SELECT '{x}' AS dim, {x}_human AS h, {x}_judge AS j FROM rated" for x in C.DIMENSIONS)}),
ranked AS (SELECT f.dim, f.h, f.j, hp.p AS hp, jp.p AS jp FROM flat f
  JOIN (SELECT dim, v, dense_rank() OVER (PARTITION BY dim ORDER BY v) AS p FROM (SELECT dim, h AS v FROM flat UNION SELECT dim, j FROM flat)) hp ON hp.dim = f.dim AND hp.v = f.h
  JOIN (SELECT dim, v, dense_rank() OVER (PARTITION BY dim ORDER BY v) AS p FROM (SELECT dim, h AS v FROM flat UNION SELECT dim, j FROM flat)) jp ON jp.dim = f.dim AND jp.v = f.j),
marg AS (SELECT a.dim, sum(a.n * b.n * (a.hp - b.jp) ** 2) AS e FROM
  (SELECT dim, hp, count(*) AS n FROM ranked GROUP BY 1, 2) a JOIN (SELECT dim, jp, count(*) AS n FROM ranked GROUP BY 1, 2) b USING (dim) GROUP BY 1),
kappa AS (SELECT r.dim, count(*) AS n, round(1 - sum((hp - jp) ** 2) / nullif(any_value(m.e) / count(*), 0), 6) AS qwk FROM ranked r JOIN marg m USING (dim) GROUP BY r.dim),
avgrank AS (SELECT dim, rank() OVER (PARTITION BY dim ORDER BY h) + (count(*) OVER (PARTITION BY dim, h) - 1) / 2.0 AS x,
  rank() OVER (PARTITION BY dim ORDER BY j) + (count(*) OVER (PARTITION BY dim, j) - 1) / 2.0 AS y FROM flat),
rho AS (SELECT dim, CASE WHEN var_pop(x) > 0 AND var_pop(y) > 0 THEN round(corr(x, y), 6) END AS spearman FROM avgrank GROUP BY dim),
near AS (SELECT dim, round(avg((abs(h - j) <= 1)::INT), 6) AS within_one FROM flat GROUP BY dim)"""

ENTRIES = {
    "label_distribution": (
        label_distribution,
        S.with_threads("SELECT truth AS intent, count(*) AS n, count(*) FILTER (WHERE t) AS escalated, round(count(*) / (SELECT count(*) FROM pairs), 6) AS share FROM pairs GROUP BY truth", PAIRS),
    ),
    "intent_confusion": (intent_confusion, S.with_threads("SELECT truth, pred, count(*) AS n FROM pairs GROUP BY ALL", PAIRS)),
    "intent_metrics": (
        intent_metrics,
        S.with_threads(
            f"SELECT round((SELECT avg((truth = pred)::INT) FROM pairs), 6) AS accuracy, round({MACRO}, 6) AS macro_f1, round((SELECT sum(f1 * support) / sum(support) FROM f), 6) AS weighted_f1, (SELECT count(*) FROM pairs) AS n",
            PAIRS,
            SCORES,
        ),
    ),
    "class_report": (class_report, S.with_threads(REPORT, PAIRS, SCORES)),
    "quality_report": (
        quality_report,
        "WITH pairs AS (SELECT CAST(quality AS VARCHAR) AS truth, CAST((n_chars < 2000)::INT AS VARCHAR) AS pred FROM labels JOIN documents USING (doc_id)), " + SCORES + " " + REPORT,
    ),
    "escalate_metrics": (
        escalate_metrics,
        S.with_threads(
            "SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, "
            f"round({ESC_F1}, 6) AS f1, tp + tn + fp + fn AS n, tn, fp, fn, tp FROM esc",
            PAIRS,
            ESC,
        ),
    ),
    "headline": (headline, S.with_threads(f"SELECT round(({MACRO} + {ESC_F1}) / 2, 6) AS headline", PAIRS, SCORES, ESC)),
    "retrieval_proxy": (retrieval_proxy, S.with_threads("SELECT avg_score, n FROM proxy", HITS)),
    "evaluate_all": (
        evaluate_all,
        S.with_threads(
            f"SELECT round((SELECT avg((truth = pred)::INT) FROM pairs), 6) AS intent_accuracy, round({MACRO}, 6) AS macro_f1, (SELECT count(*) FROM pairs) AS n, round({ESC_F1}, 6) AS escalate_f1, "
            f"(SELECT avg_score FROM proxy) AS avg_score, round(({MACRO} + {ESC_F1}) / 2, 6) AS headline",
            PAIRS, SCORES, ESC, HITS,
        ),
    ),
    "evaluate_named": (
        evaluate_named,
        S.with_threads(f"SELECT round({MACRO}, 6) AS macro_f1, round({ESC_F1}, 6) AS escalate_f1, (SELECT n FROM proxy) AS with_hits", PAIRS, SCORES, ESC, HITS),
    ),
    "judge_batch": (
        judge_batch,
        S.with_threads(
            "SELECT tweet_id, intent, draft, " + ", ".join(C.DIMENSIONS) + " FROM graded UNION ALL SELECT 'mean', '', '', " + ", ".join(f"round(avg({x}), 6)" for x in C.DIMENSIONS) + " FROM graded",
            RATINGS,
            "graded AS (SELECT d.tweet_id, " + S.label("t.inbound_text") + " AS intent, md5(d.reply) AS draft, "
            + ", ".join(f"CASE WHEN d.row_ord % 3 = 0 THEN {v} ELSE j.{x} END::DOUBLE AS {x}" for x, v in zip(C.DIMENSIONS, (2, 1, 5, 4)))
            + " FROM drafted d JOIN judged j USING (tweet_id) JOIN threads t USING (tweet_id))",
        ),
    ),
    "write_metrics": (
        write_metrics,
        S.with_threads(f"SELECT round({MACRO}, 6) AS macro_f1, (SELECT count(*) FROM pairs) AS n, round(({MACRO} + {ESC_F1}) / 2, 6) AS headline", PAIRS, SCORES, ESC),
    ),
    "join_ratings": (join_ratings, S.with_threads("SELECT * FROM rated", RATINGS)),
    "qwk": (qwk, S.with_threads("SELECT * FROM kappa", RATINGS)),
    "spearman": (spearman, S.with_threads("SELECT * FROM rho", RATINGS)),
    "within_one": (within_one, S.with_threads("SELECT * FROM near", RATINGS)),
    "agreement": (agreement, S.with_threads("SELECT * FROM kappa JOIN rho USING (dim) JOIN near USING (dim)", RATINGS)),
    "judge_averages": (
        judge_averages,
        S.with_threads("SELECT " + ", ".join(f"round(avg({x}), 6) AS {x}" for x in C.DIMENSIONS) + " FROM judged", RATINGS),
    ),
    "reply_coverage": (reply_coverage, S.with_threads("SELECT count(*) AS threads, count(*) FILTER (WHERE brand_reply <> '') AS with_reply FROM threads")),
    "threshold_sweep": (
        threshold_sweep,
        S.with_threads(
            "SELECT (SELECT count(*) FROM threads) AS n, x::DOUBLE AS threshold, (SELECT count(*) FROM threads WHERE round((row_ord % 89) / 89.0::DOUBLE, 6) < x) AS below, "
            "round((SELECT count(*) FROM threads WHERE round((row_ord % 89) / 89.0::DOUBLE, 6) < x) / (SELECT count(*) FROM threads), 6) AS share FROM (SELECT unnest([0.4, 0.5, 0.55, 0.6, 0.7]::DOUBLE[]) AS x)"
        ),
    ),
    "escalate_auroc": (
        escalate_auroc,
        S.with_threads(
            "SELECT round(sum(CASE WHEN a.s > b.s THEN 1 WHEN a.s = b.s THEN 0.5 ELSE 0 END) / count(*), 6) AS auroc, (SELECT count(*) FROM sc) AS n FROM sc a JOIN sc b ON a.t AND NOT b.t",
            PAIRS,
            "sc AS (SELECT t, round((row_ord % 89) / 89.0::DOUBLE, 6) AS s FROM pairs)",
        ),
    ),
    "bootstrap_ci": (
        bootstrap_ci,
        S.with_threads(
            "SELECT round(avg(m), 6) AS mean, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high, count(*) AS resamples FROM per_draw",
            PAIRS,
            """draws AS (SELECT b, truth, pred, (CAST('0x' || substr(md5('11:' || b || ':' || tweet_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u FROM pairs, range(2000) g(b)),
            weights AS (SELECT b, truth, pred, sum(len(list_filter(
              [exp(-1), 2 * exp(-1), 2.5 * exp(-1), (2.5 + 1/6) * exp(-1), (2.5 + 1/6 + 1/24) * exp(-1), (2.5 + 1/6 + 1/24 + 1/120) * exp(-1), (2.5 + 1/6 + 1/24 + 1/120 + 1/720) * exp(-1),
               (2.5 + 1/6 + 1/24 + 1/120 + 1/720 + 1/5040) * exp(-1), (2.5 + 1/6 + 1/24 + 1/120 + 1/720 + 1/5040 + 1/40320) * exp(-1)], lambda z: u > z))) AS n FROM draws GROUP BY ALL),
            per_class AS (SELECT b, label, sum(hit) / sum(n) AS f1 FROM (
              SELECT b, truth AS label, n, CASE WHEN truth = pred THEN n ELSE 0 END AS hit FROM weights WHERE n > 0
              UNION ALL SELECT b, pred, n, CASE WHEN truth = pred THEN n ELSE 0 END FROM weights WHERE n > 0) GROUP BY ALL),
            per_draw AS (SELECT b, avg(f1) AS m FROM per_class GROUP BY b)""",
        ),
    ),
    "reply_chain_depth": (
        reply_chain_depth,
        S.with_msg(
            "SELECT tweet_id, max(depth) AS depth FROM walk GROUP BY tweet_id",
            """walk AS (SELECT tweet_id, in_response_to_tweet_id AS up, CAST(1 AS BIGINT) AS depth FROM msg
               UNION ALL SELECT w.tweet_id, m.in_response_to_tweet_id, w.depth + 1 FROM walk w JOIN msg m ON m.tweet_id = w.up)""",
            recursive=True,
        ),
    ),
}
