"""Classification, escalation and retrieval metrics.

Everything is derived from one grouped confusion count, which has at most
(number of classes)^2 rows; the windows without partition below run on that
small table only."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.constants import FALLBACK_INTENT
from replyscope.operators.ordering import dense_positions, running_total, top_per_group
from replyscope.session import cut_lineage


def align_predictions(golden: DataFrame, pred: DataFrame, order_col: str = "row_ord", key: str = "tweet_id") -> DataFrame:
    """Inner join by id of the last row per id on each side; columns are
    gold_<name> and pred_<name>. Without ids on both sides, or without any
    common id, the i-th row of one side in the order of order_col is paired with
    the i-th of the other, as far as the shorter side goes; `position` counts
    from 0."""
    by_id = key in golden.columns and key in pred.columns
    if by_id and not golden.join(pred, key, "left_semi").isEmpty():
        on = key
        golden, pred = (top_per_group(d, [key], [F.desc(order_col)], 1, "_last").drop("_last") for d in (golden, pred))
    else:
        on = "position"
        golden, pred = (dense_positions(d, [F.col(order_col), F.md5(F.to_json(F.struct(*d.columns)))], on) for d in (golden, pred))
    sides = []
    for prefix, side in (("gold_", golden), ("pred_", pred)):
        sides.append(side.select(F.col(on), *[F.col(c).alias(prefix + c) for c in side.columns if c != on]))
    return sides[0].join(sides[1], on)


def common_ids(a: DataFrame, b: DataFrame, key: str = "tweet_id") -> DataFrame:
    return a.select(key).intersect(b.select(key))


def intent_confusion(aligned: DataFrame, truth: str = "gold_intent", pred: str = "pred_intent") -> DataFrame:
    """Counts by (truth, pred); an empty label means the fallback class."""
    return aligned.groupBy(
        *[F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(FALLBACK_INTENT)).alias(a) for c, a in ((truth, "truth"), (pred, "pred"))]
    ).agg(F.count(F.lit(1)).alias("n"))


def _safe(top, bottom):
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.nullif(bottom, F.lit(0)))


def class_scores(confusion: DataFrame) -> DataFrame:
    """Per class precision, recall, F1 and support over the union of true and
    predicted classes; a zero denominator gives 0."""
    sides = confusion.select(
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
                F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
            )
        ).alias("s"),
        # A correct row appears on both sides, hence the half below.
        F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).alias("hit"),
    )
    totals = sides.groupBy(F.col("s.label").alias("label")).agg(
        F.sum("s.support").alias("support"),
        F.sum("s.predicted").alias("predicted"),
        (F.sum("hit") / 2).alias("hits"),
    )
    return totals.select(
        "label",
        "support",
        "hits",
        _safe(F.col("hits"), F.col("predicted")).alias("precision"),
        _safe(F.col("hits"), F.col("support")).alias("recall"),
        _safe(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
    )


def intent_metrics(aligned: DataFrame, truth: str = "gold_intent", pred: str = "pred_intent") -> DataFrame:
    return _intent_metrics(intent_confusion(aligned, truth, pred))


def _intent_metrics(confusion: DataFrame) -> DataFrame:
    scores = class_scores(confusion)
    return scores.agg(
        _safe(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        _safe(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
        F.sum("support").alias("n"),
    )


def class_report(aligned: DataFrame, truth: str = "gold_intent", pred: str = "pred_intent") -> DataFrame:
    """Per class rows, then accuracy, macro and weighted averages."""
    scores = class_scores(intent_confusion(aligned, truth, pred))
    total = F.sum("support")

    def weighted(name):
        return _safe(F.sum(F.col(name) * F.col("support")), total).alias(name)

    hit_rate = _safe(F.sum("hits"), total)
    summary = scores.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("label"),
                hit_rate.alias("precision"),
                hit_rate.alias("recall"),
                hit_rate.alias("f1"),
                total.alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("label"),
                F.avg("precision").alias("precision"),
                F.avg("recall").alias("recall"),
                F.avg("f1").alias("f1"),
                total.alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("label"),
                weighted("precision"),
                weighted("recall"),
                weighted("f1"),
                total.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return scores.select("label", "precision", "recall", "f1", "support").unionByName(summary)


def escalate_metrics(aligned: DataFrame, truth: str = "gold_escalate", pred: str = "pred_escalate") -> DataFrame:
    t, p = F.coalesce(F.col(truth), F.lit(False)), F.coalesce(F.col(pred), F.lit(False))
    counts = aligned.agg(
        F.count_if(~t & ~p).alias("tn"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(t & p).alias("tp")
    )
    return _escalate_metrics(counts)


def _escalate_metrics(counts: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        _safe(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        _safe(tp, tp + fp).alias("precision"),
        _safe(tp, tp + fn).alias("recall"),
        _safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tn + fp + fn + tp).alias("n"),
        tn, fp, fn, tp,
    )


def retrieval_proxy(pred: DataFrame, retrieved: str = "retrieved") -> DataFrame:
    """Mean over messages with any hit of their mean hit score."""
    hits = F.col(retrieved)
    total = F.aggregate(hits, F.lit(0.0), lambda acc, x: acc + F.coalesce(x["score"], F.lit(0.0)))
    some = pred.filter(F.size(F.coalesce(hits, F.array())) > 0)
    return some.agg(
        F.coalesce(F.avg(total / F.size(hits)), F.lit(0.0)).alias("avg_score"), F.count(F.lit(1)).alias("n")
    )


def headline(intent: DataFrame, escalate: DataFrame) -> DataFrame:
    values = intent.select(F.col("macro_f1").alias("v")).unionByName(escalate.select(F.col("f1").alias("v")))
    return values.agg(F.avg("v").alias("headline"))


def evaluate_all(golden: DataFrame, pred: DataFrame, order_col: str = "row_ord") -> DataFrame:
    """One row with the nested metrics document. Labels may also be named `label`
    and `escalate_label`: the first non-empty alternative of a row counts.

    The aligned rows are grouped once, by true and predicted label and escalation,
    with the sums of hit scores; every metric comes from that small table."""
    golden, pred = (_named_labels(side) for side in (golden, pred))
    aligned = align_predictions(golden, pred, order_col)
    hits = F.coalesce(F.col("pred_retrieved"), F.array())
    mean = F.aggregate(hits, F.lit(0.0), lambda acc, x: acc + F.coalesce(x["score"], F.lit(0.0))) / F.nullif(F.size(hits), F.lit(0))
    label = [F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(FALLBACK_INTENT)).alias(c) for c in ("gold_intent", "pred_intent")]
    flag = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("gold_escalate", "pred_escalate")]
    cells = aligned.groupBy(*label, *flag).agg(F.count(F.lit(1)).alias("n"), F.sum(mean).alias("scores"), F.count(mean).alias("scored"))
    cells = cut_lineage(cells)
    n = F.col("n")
    confusion = cells.groupBy(F.col("gold_intent").alias("truth"), F.col("pred_intent").alias("pred")).agg(F.sum("n").alias("n"))
    intent = _intent_metrics(confusion).select(F.struct("accuracy", "macro_f1", "weighted_f1", "n").alias("intent"))
    t, p = F.col("gold_escalate"), F.col("pred_escalate")
    total = lambda test: F.coalesce(F.sum(F.when(test, n)), F.lit(0))
    counts = cells.agg(total(~t & ~p).alias("tn"), total(~t & p).alias("fp"), total(t & ~p).alias("fn"), total(t & p).alias("tp"))
    escalate = _escalate_metrics(counts).select(F.struct("accuracy", "precision", "recall", "f1", "n").alias("escalate"))
    scored = F.sum("scored")
    retrieval = cells.agg(_safe(F.sum("scores"), scored).alias("avg_score"), F.coalesce(scored, F.lit(0)).alias("n"))
    retrieval = retrieval.select(F.struct(F.coalesce("avg_score", F.lit(0.0)).alias("avg_score"), "n").alias("retrieval"))
    one = F.lit(1)
    document = (
        intent.withColumn("_one", one)
        .join(escalate.withColumn("_one", one), "_one")
        .join(retrieval.withColumn("_one", one), "_one")
        .drop("_one")
    )
    return document.withColumn("headline", (F.col("intent.macro_f1") + F.col("escalate.f1")) / 2)


def _named_labels(side: DataFrame) -> DataFrame:
    for name, other in (("intent", "label"), ("escalate", "escalate_label")):
        if other in side.columns:
            own = F.col(name) if name in side.columns else F.lit(None)
            empty = F.nullif(own.cast("string"), F.lit(""))
            value = F.coalesce(empty, F.col(other).cast("string"))
            side = side.withColumn(name, value if name == "intent" else value.try_cast("boolean"))
    return side


def label_distribution(df: DataFrame, label: str = "intent", escalate: str = "escalate") -> DataFrame:
    """Rows, escalated rows and share of all rows per label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.count_if(escalate).alias("escalated"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def threshold_sweep(pred: DataFrame, thresholds: list[float], confidence: str = "intent_confidence") -> DataFrame:
    """Rows below each confidence threshold, counted in one pass."""
    counts = pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.array(
            *[
                F.struct(F.lit(float(t)).alias("threshold"), F.count_if(F.col(confidence) < t).alias("below"))
                for t in thresholds
            ]
        ).alias("rows"),
    )
    return counts.select("n", F.inline("rows")).withColumn("share", _safe(F.col("below"), F.col("n")))


def escalate_auroc(aligned: DataFrame, score: str, truth: str = "gold_escalate") -> DataFrame:
    """Area under the ROC curve by rank sums over distinct score values. Rows
    without a score cannot be ranked and are left out; n counts the others."""
    s, positive = F.col(score).cast("double"), F.coalesce(F.col(truth), F.lit(False))
    counts = aligned.filter(s.isNotNull()).groupBy(s.alias("s")).agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    ranked = running_total(counts, [F.col("s")], "neg", "upto")
    wins = F.sum(F.col("pos") * (F.col("upto") - F.col("neg") / 2))
    return ranked.agg(
        (wins / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auroc"), F.sum(F.col("pos") + F.col("neg")).alias("n")
    )


def _row_draws(aligned: DataFrame, resamples: int, seed: int, key: str) -> DataFrame:
    """(b, truth, pred, n): the weights of a confusion cell's rows in a resample, each
    drawn for the row itself from a hash of seed, resample and key."""
    uniform = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("b").cast("string"), F.lit(":"), F.col("key"))), 1, 8), 16, 10)
    steps, term, total = [], math.exp(-1), 0.0
    for k in range(1, 10):  # cumulative Poisson(1) probabilities, turned into a count
        total += term
        steps.append(total)
        term /= k
    weight = sum(((F.col("u") > s).cast("long") for s in steps), F.lit(0).cast("long"))
    labels = [F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(FALLBACK_INTENT)).alias(a) for c, a in (("gold_intent", "truth"), ("pred_intent", "pred"))]
    each = aligned.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), *labels).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))))
    drawn = each.withColumn("u", (uniform.cast("double") + 0.5) / 4294967296.0)
    return drawn.groupBy("b", "truth", "pred").agg(F.sum(weight).alias("n")).filter("n > 0")


def bootstrap_ci(aligned: DataFrame, resamples: int = 2_000, seed: int = 11, key: str | None = None) -> DataFrame:
    """Interval of macro-F1 over bootstrap resamples.

    With a key every row draws its own weight, Poisson(1), in every resample; rows of
    equal key are drawn together. Without one, the weight of a confusion cell of n rows
    is drawn, which is Poisson(n): one draw per resample and cell, seeded by both."""
    if key is not None:
        return _interval(_row_draws(aligned, resamples, seed, key))
    cells = intent_confusion(aligned)
    named = cells.withColumn("cell", F.crc32(F.to_json(F.struct("truth", "pred")).cast("binary")))
    each = named.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))))

    def draw(batches):
        for batch in batches:
            frame = batch.to_pandas()
            frame["n"] = [np.random.default_rng((seed, b, c)).poisson(n) for b, c, n in zip(frame["b"], frame["cell"], frame["n"])]
            yield pa.RecordBatch.from_pandas(frame[["b", "truth", "pred", "n"]], preserve_index=False)

    drawn = each.select("b", "truth", "pred", "cell", "n").mapInArrow(draw, "b int, truth string, pred string, n long").filter("n > 0")
    return _interval(drawn)


def _interval(drawn: DataFrame) -> DataFrame:
    """(mean, low, high, resamples) of macro-F1 from drawn weights (b, truth, pred, n)."""
    sides = drawn.select(
        "b",
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("label"), F.col("n").alias("n")),
                F.struct(F.col("pred").alias("label"), F.col("n").alias("n")),
            )
        ).alias("s"),
        F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).alias("hit"),
    )
    per_class = sides.groupBy("b", F.col("s.label").alias("label")).agg((F.sum("hit") / F.sum("s.n")).alias("f1"))
    per_draw = per_class.groupBy("b").agg(F.avg("f1").alias("macro_f1"))
    q = F.percentile("macro_f1", F.array(F.lit(0.025), F.lit(0.975)))
    return per_draw.agg(F.avg("macro_f1").alias("mean"), q[0].alias("low"), q[1].alias("high"), F.count(F.lit(1)).alias("resamples"))
