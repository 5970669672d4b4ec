"""Fitted and drawn results next to plain Python on a small fixture."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from replyscope.constants import INTENTS
from replyscope.operators import classifier, index as I, metrics as M, retrieval

WORDS = ["parcel", "refund", "login", "broken", "charge", "delay", "agent", "angry", "colour", "window"]


def fixture(n=120):
    rng = random.Random(6)
    return [(str(i), " ".join([WORDS[i % 4], *rng.choices(WORDS, k=rng.randint(2, 6))]), INTENTS[i % 4 if i % 5 else 0]) for i in range(n)]


def features(texts, vocabulary=None, idf=None):
    grams = [Counter(t.split() + [f"{a} {b}" for a, b in zip(t.split(), t.split()[1:])]) for t in texts]
    vocabulary = vocabulary or sorted({g for c in grams for g in c})
    idf = idf if idf is not None else np.array([math.log((1 + len(texts)) / (1 + sum(g in c for c in grams))) + 1 for g in vocabulary])
    x = np.array([[c[g] for g in vocabulary] for c in grams], float) * idf
    return vocabulary, idf, x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def test_classifier_is_the_optimum_of_its_objective(spark):
    """Features, weights and penalty in numpy: the gradient at the fitted weights is
    (nearly) zero, and intents and confidences are the softmax of the scores."""
    rows = fixture()
    df = spark.createDataFrame(rows, "tweet_id string, inbound_text string, weak_intent string")
    model = classifier.train_intent(df)
    table = classifier.model_weights(spark, model).collect()
    vocabulary, idf, x = features([t for _, t, _ in rows])
    assert sorted({r["term"] for r in table if r["term"]}) == vocabulary
    assert {r["term"]: r["idf"] for r in table if r["term"]} == pytest.approx(dict(zip(vocabulary, idf)))
    weights, bias = np.zeros((len(INTENTS), len(vocabulary))), np.full(len(INTENTS), -np.inf)
    for r in table:
        if r["term"]:
            weights[INTENTS.index(r["intent"]), vocabulary.index(r["term"])] = r["weight"]
        else:
            bias[INTENTS.index(r["intent"])] = r["weight"]
    scores = x @ weights.T + np.where(np.isfinite(bias), bias, -1e9)
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    scored = {r["tweet_id"]: (r["intent"], r["intent_confidence"]) for r in classifier.score_intent(df, model).collect()}
    for (key, _, _), row in zip(rows, p):
        assert scored[key][0] == INTENTS[int(row.argmax())] and scored[key][1] == pytest.approx(row.max(), abs=1e-6)
    truth = np.array([[label == name for name in INTENTS] for _, _, label in rows], float)
    classes = Counter(label for _, _, label in rows)
    weight = np.array([len(rows) / len(classes) / classes[label] for _, _, label in rows])
    slope = ((p - truth) * weight[:, None]).T @ x / len(rows) + weights / len(rows)
    used = [INTENTS.index(c) for c in classes]
    assert np.abs(slope[used]).max() < 2e-3 < np.abs((truth - truth.mean(axis=0)).T @ x / len(rows)).max()


def test_holdout_report_counts_the_held_out_part(spark):
    rows = fixture(100)
    df = spark.createDataFrame(rows, "tweet_id string, inbound_text string, weak_intent string")
    report, overall = classifier.holdout_report(df)
    import hashlib

    test = set(sorted((r[0] for r in rows), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())[:20])
    model = classifier.train_intent(df.filter(~df["tweet_id"].isin(list(test))))
    guess = {r["tweet_id"]: r["intent"] for r in classifier.score_intent(df, model).collect()}
    pairs = [(label, guess[key]) for key, _, label in rows if key in test]
    got = {r["label"]: r for r in report.collect()}
    for name in {x for pair in pairs for x in pair}:
        hit, said, true = (sum(f(a, b) for a, b in pairs) for f in (lambda a, b: a == b == name, lambda a, b: b == name, lambda a, b: a == name))
        assert got[name]["support"] == true
        assert got[name]["precision"] == pytest.approx(hit / said if said else 0) and got[name]["recall"] == pytest.approx(hit / true if true else 0)
    assert overall.first()["accuracy"] == pytest.approx(sum(a == b for a, b in pairs) / 20)


def test_bootstrap_equals_its_draws(spark):
    import json
    import zlib

    rng = random.Random(2)
    rows = [(str(i), rng.choice("abc"), rng.choice("abcd")) for i in range(90)]
    cells = Counter((t, p) for _, t, p in rows)
    scores = []
    for b in range(200):
        n = {c: np.random.default_rng((5, b, zlib.crc32(json.dumps({"truth": c[0], "pred": c[1]}, separators=(",", ":")).encode()))).poisson(k) for c, k in cells.items()}
        n = {c: k for c, k in n.items() if k}
        f1 = [2 * n.get((x, x), 0) / sum(k * ((c[0] == x) + (c[1] == x)) for c, k in n.items()) for x in {x for c in n for x in c}]
        scores.append(sum(f1) / len(f1))
    row = M.bootstrap_ci(spark.createDataFrame(rows, "tweet_id string, gold_intent string, pred_intent string"), 200, 5).first()
    assert row["mean"] == pytest.approx(np.mean(scores)) and row["resamples"] == 200
    assert (row["low"], row["high"]) == (pytest.approx(np.quantile(scores, 0.025)), pytest.approx(np.quantile(scores, 0.975)))


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_short_lists_are_filled_by_gaps(spark, monkeypatch, bits):
    """A query that shares words with all but a few late documents."""
    monkeypatch.setattr(retrieval, "PLACES", bits)
    docs = [(f"d{i:03}", "common reply" if i not in (0, 41, 57, 58, 90) else f"other{i}") for i in range(100)]
    docs += [("d200", "rare words")]
    index = I.index_build(spark.createDataFrame(docs, "doc_id string, text string"))
    asked = spark.createDataFrame([(1, "rare words"), (2, "common"), (3, "nothing known"), (4, "rare common")], "query_id int, query_text string")
    got = {}
    for r in retrieval.ranked_docs(asked, index, 1.0, 8).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    names = [d for d, _ in docs]
    assert got[3] == names[:8]
    assert got[1] == ["d200", *[n for n in names if n != "d200"][:7]]
    assert all(len(v) == 8 and len(set(v)) == 8 for v in got.values())
    sunk = spark.createDataFrame([(1, "common")], "query_id int, query_text string")
    ranked = [r["doc_id"] for r in retrieval.ranked_docs(sunk, index, 1.0, 104).orderBy("rank").collect()]
    assert sorted(ranked) == sorted(names)
    late = ["d000", "d041", "d057", "d058", "d090", "d200"]
    assert ranked[:6] == late or ranked[-6:] == late  # negative weights rank the others below
    assert [r["doc_id"] for r in retrieval.bm25_scores(sunk, index, 3).orderBy("rank").collect()] == ranked[:3]
