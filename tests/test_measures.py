"""Metrics and rater agreement against plain Python and published values."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from replyscope.operators import agreement as A, metrics as M


def plain_report(pairs):
    labels = sorted({x for p in pairs for x in p})
    f1 = {}
    for c in labels:
        hit = sum(t == p == c for t, p in pairs)
        said, real = sum(p == c for _, p in pairs), sum(t == c for t, _ in pairs)
        f1[c] = 2 * hit / (said + real) if said + real else 0.0
    support = {c: sum(t == c for t, _ in pairs) for c in labels}
    return sum(f1.values()) / len(labels), sum(f1[c] * support[c] for c in labels) / len(pairs), sum(t == p for t, p in pairs) / len(pairs)


def test_intent_metrics(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("only_true", "a"), ("a", "only_pred"), ("", None)]
    df = spark.createDataFrame(pairs, "gold_intent string, pred_intent string")
    macro, weighted, accuracy = plain_report([(t or "other", p or "other") for t, p in pairs])
    row = M.intent_metrics(df).first()
    assert (row.macro_f1, row.weighted_f1, row.accuracy, row.n) == (pytest.approx(macro), pytest.approx(weighted), pytest.approx(accuracy), 6)
    report = {r.label: r for r in M.class_report(df).collect()}
    assert report["only_true"].recall == 0 and report["only_pred"].precision == 0
    assert report["macro avg"].f1 == pytest.approx(macro) and report["accuracy"].support == 6


def test_escalation_without_positives(spark):
    df = spark.createDataFrame([(False, False), (None, False)], "gold_escalate boolean, pred_escalate boolean")
    row = M.escalate_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.tn) == (1.0, 0.0, 0.0, 0.0, 2)


def test_published_matrix(spark):
    """A matrix [[93, 39], [28, 40]] has precision 0.506, recall 0.588, F1 0.544."""
    cells = [(False, False)] * 93 + [(False, True)] * 39 + [(True, False)] * 28 + [(True, True)] * 40
    row = M.escalate_metrics(spark.createDataFrame(cells, "gold_escalate boolean, pred_escalate boolean")).first()
    assert [round(x, 3) for x in (row.accuracy, row.precision, row.recall, row.f1)] == [0.665, 0.506, 0.588, 0.544]


def test_retrieval_proxy_of_nothing(spark):
    df = spark.createDataFrame([("1", [])], "tweet_id string, retrieved array<struct<doc_id:string,score:double>>")
    assert tuple(M.retrieval_proxy(df).first()) == (0.0, 0)


def plain_kappa(pairs):
    labels = sorted({x for p in pairs for x in p})
    at = {x: i for i, x in enumerate(labels)}
    n = len(pairs)
    observed = sum((at[h] - at[j]) ** 2 for h, j in pairs)
    expected = sum((at[h] - at[j]) ** 2 for h, j in itertools.product([h for h, _ in pairs], [j for _, j in pairs])) / n
    return 1 - observed / expected if expected else None


def plain_spearman(pairs):
    def ranks(v):
        return [sum(y < x for y in v) + (sum(y == x for y in v) + 1) / 2 for x in v]

    x, y = ranks([h for h, _ in pairs]), ranks([j for _, j in pairs])
    mx, my = sum(x) / len(x), sum(y) / len(y)
    cov = sum((a - mx) * (b - my) for a, b in zip(x, y))
    var = math.sqrt(sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y))
    return cov / var if var else None


def test_agreement(spark):
    columns = "tweet_id string, groundedness int, helpfulness int, brand_voice int, safety int"
    human = [(str(i), 1 + i % 5, 2 if i % 3 else 4, 3, 5) for i in range(40)]
    judge = [(str(i), 1 + (i * 7) % 5, 4 if i % 2 else 2, 3 + i % 2, 5) for i in range(5, 50)]
    got = {r.dim: r for r in A.agreement(spark.createDataFrame(human, columns), spark.createDataFrame(judge, columns)).collect()}
    by_id = {r[0]: r for r in judge}
    for at, dim in enumerate(("groundedness", "helpfulness", "brand_voice", "safety"), 1):
        pairs = [(h[at], by_id[h[0]][at]) for h in human if h[0] in by_id]
        kappa, rho = plain_kappa(pairs), plain_spearman(pairs)
        assert got[dim].n == len(pairs) == 35
        assert got[dim].qwk == (pytest.approx(kappa) if kappa is not None else None)
        assert got[dim].spearman == (pytest.approx(rho) if rho is not None else None)
        assert got[dim].within_one == pytest.approx(sum(abs(h - j) <= 1 for h, j in pairs) / len(pairs))


def test_suffixed_columns(spark):
    human = spark.createDataFrame([("1", 3, 4, 3, 5)], "tweet_id string, groundedness_human int, helpfulness_human int, brand_voice_human int, safety_human int")
    judge = spark.createDataFrame([("1", 4, 4, 4, 5)], "tweet_id string, groundedness int, helpfulness int, brand_voice int, safety int")
    row = A.join_ratings(human, judge).first()
    assert (row.groundedness_human, row.groundedness_judge) == (3, 4)


def test_auroc(spark):
    rows = [(i % 3 == 0, (i * 37 % 50) / 50) for i in range(90)]
    df = spark.createDataFrame(rows, "gold_escalate boolean, s double")
    wins = [1.0 if a > b else 0.5 if a == b else 0.0 for t, a in rows if t for u, b in rows if not u]
    assert M.escalate_auroc(df, "s").first().auroc == pytest.approx(sum(wins) / len(wins))


def test_bootstrap_contains_the_estimate(spark):
    rows = [(str(i), "a" if i % 2 else "b", "a" if i % 3 else "b") for i in range(120)]
    df = spark.createDataFrame(rows, "tweet_id string, gold_intent string, pred_intent string")
    row = M.bootstrap_ci(df, 300, 4).first()
    assert row.low < M.intent_metrics(df).first().macro_f1 < row.high and row.resamples == 300


def test_label_functions_accept_streams(spark, tmp_path):
    """The row-wise rules are plain expressions, so they also run on a stream."""
    from replyscope.functions.labels import heuristic_label
    from replyscope.functions.text import clean_text

    spark.createDataFrame([("1", "my order @x",)], "id string, text string").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, text string").json(str(tmp_path / "in"))
    query = (
        stream.select("id", heuristic_label(clean_text(F.col("text"))).alias("intent"))
        .writeStream.format("memory").queryName("labelled").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(60)
    assert [tuple(r) for r in spark.table("labelled").collect()] == [("1", "order_shipping")]
