"""Row draws of the bootstrap, and the round trip of a saved model."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from replyscope.operators import metrics as M
from replyscope.registry import search


def test_every_row_draws_its_own_weight(spark):
    rng = random.Random(6)
    rows = [(str(i), rng.choice("abc"), rng.choice("abcd")) for i in range(40)] + [(None, "a", "a")]
    limits = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)])
    scores = []
    for b in range(60):
        n = Counter()
        for key, truth, pred in rows:
            u = (int(hashlib.md5(f"5:{b}:{key or ''}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32
            n[truth, pred] += int((u > limits).sum())
        n = {c: k for c, k in n.items() if k}
        f1 = [2 * n.get((x, x), 0) / sum(k * ((c[0] == x) + (c[1] == x)) for c, k in n.items()) for x in {x for c in n for x in c}]
        scores.append(sum(f1) / len(f1))
    row = M.bootstrap_ci(spark.createDataFrame(rows, "tweet_id string, gold_intent string, pred_intent string"), 60, 5, "tweet_id").first()
    assert row["mean"] == pytest.approx(np.mean(scores)) and row["resamples"] == 60
    assert (row["low"], row["high"]) == (pytest.approx(np.quantile(scores, 0.025)), pytest.approx(np.quantile(scores, 0.975)))


def test_saved_model_is_compared_with_the_one_in_memory(spark, tmp_path, monkeypatch):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} of {t}") for c in range(30) for t in range(4)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = search.model_save(spark, str(tmp_path)).collect()
    assert len(got) == 60 and all(r.same for r in got)
    monkeypatch.setattr(search.classifier, "model_load", lambda path: None)
    assert not any(r.same for r in search.model_save(spark, str(tmp_path)).collect())


def test_saved_model_has_its_sql(spark, tmp_path):
    import duckdb

    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} of {t}") for c in range(30) for t in range(4)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    query, sql = search.ENTRIES["model_save"]
    want = sorted(con.execute(sql).fetchall())
    assert sorted(map(tuple, query(spark, str(tmp_path)).select("tweet_id", "same").collect())) == want and len(want) == 60
    intents, _ = search.ENTRIES["model_save_intents"]
    assert intents(spark, str(tmp_path)).columns == ["tweet_id", "intent", "intent_confidence", "same"]
