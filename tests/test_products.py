"""Many queries scored by products of blocks, against the pruned route."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from replyscope.operators import products, retrieval, tiles
from replyscope.operators.index import index_build

WORDS = "order parcel refund late blue chair broken lamp invoice account locked reset mail charged twice".split()


@pytest.fixture(scope="module")
def index(spark):
    rows = [(f"d{i:03}", " ".join(WORDS[(i * j + j) % len(WORDS)] for j in range(1, 3 + i % 9)) + f" only{i % 50}") for i in range(300)]
    return index_build(spark.createDataFrame(rows + [("copy", rows[0][1]), ("other", "nothing shared here")], "doc_id string, text string"))


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(i, " ".join(WORDS[(i + j * j) % len(WORDS)] for j in range(1 + i % 7)) + f" only{i}") for i in range(60)]
    rows += [(100, "unknown words"), (101, ""), (102, None), (103, "order,parcel"), (104, "here")]
    return spark.createDataFrame(rows, "query_id long, query_text string")


def _rows(df):
    fields = ["query_id", "rank", "doc_id", *[F.round(c, 6).alias(c) for c in ("score", "bm25", "dense", "low", "high")]]
    return sorted(map(tuple, df.select(*fields).collect()))


def test_products_give_the_result_of_the_pruned_route(index, queries, monkeypatch):
    monkeypatch.setattr(tiles, "MOST_CELLS", 0)
    monkeypatch.setattr(products, "LEAST", 40)
    by_products = _rows(retrieval.ranked_docs(queries, index, 0.7, 5))
    monkeypatch.setattr(products, "SHARED", float("inf"))
    assert by_products == _rows(retrieval.ranked_docs(queries, index, 0.7, 5))
    assert by_products


def _packed(rng, rows, terms, key, signed):
    """Rows of a block, some without terms; even terms are BM25 terms."""
    out = []
    for i in range(rows):
        held = np.flatnonzero(rng.random(terms) < rng.choice([0.0, 0.1, 0.5]) * np.linspace(1, 0.1, terms))
        weight = rng.choice([0.25, 0.5, 1.0, 2.0], len(held)) - (0.75 if signed else 0.0)
        b = held % 2 == 0
        out.append((i * 3, held[b] * 1000, weight[b], held[~b] * 1000, np.abs(weight[~b])))
    return pd.DataFrame(out, columns=[key, "b_terms", "b_weights", "c_terms", "c_weights"])


def _plainly(queries, texts, alpha, k):
    """Limits and best texts, pair by pair."""
    limits, best = {}, {}
    for q in queries.itertuples():
        terms = [dict(zip(q.b_terms, q.b_weights)), dict(zip(q.c_terms, q.c_weights))]
        rows = []
        for t in texts.itertuples():
            held = [dict(zip(t.b_terms, t.b_weights)), dict(zip(t.c_terms, t.c_weights))]
            b, dense = (sum(mine[x] * other[x] for x in mine if x in other) for mine, other in zip(terms, held))
            rows.append((t.text_key, b, dense, any(x in other for mine, other in zip(terms, held) for x in mine)))
        low, high = min(r[1] for r in rows), max(r[1] for r in rows)
        scored = [(-round(alpha * ((b - low) / (high - low) if high > low else 0.0) + (1 - alpha) * dense, 9), key) for key, b, dense, met in rows if met]
        limits[q.q_key], best[q.q_key] = (low, high), sorted(scored)[:k]
    return limits, best


@pytest.mark.parametrize("signed", [False, True])
@pytest.mark.parametrize("alpha", [0.0, 0.7, 1.0])
@pytest.mark.parametrize("tile, dense, expanded", [(1024, 1 / 300, 1 << 21), (7, 0.2, 5), (16, 2.0, 100), (16, 0.0, 100)])
def test_blocks_give_every_score(alpha, signed, tile, dense, expanded, monkeypatch):
    for name, value in (("TILE", tile), ("DENSE", dense), ("EXPANDED", expanded)):
        monkeypatch.setattr(products, name, value)
    rng = np.random.default_rng(3)
    queries, texts = _packed(rng, 30, 40, "q_key", signed), _packed(rng, 50, 40, "text_key", False)
    limits, best = _plainly(queries, texts, alpha, 4)
    found = products._block_limits(queries.drop(columns=["c_terms", "c_weights"]), texts.drop(columns=["c_terms", "c_weights"]))
    assert {r.q_key: (round(r.low, 9), round(r.high, 9)) for r in found.itertuples()} == {q: tuple(round(x, 9) for x in v) for q, v in limits.items()}
    queries[["low", "high"]] = [limits[q] for q in queries["q_key"]]
    rows = products._block_best(alpha, 4, signed)(queries, texts)
    rows["score"] = -rows["score"].round(9)
    grouped = {q: sorted(zip(part["score"].abs(), part["text_key"], strict=True), key=lambda x: (-x[0], x[1])) for q, part in rows.groupby("q_key")}
    assert grouped == {q: [(abs(s), key) for s, key in v] for q, v in best.items() if v}


def test_many_queries_join_no_query_with_every_text(index, queries, monkeypatch):
    monkeypatch.setattr(tiles, "MOST_CELLS", 0)
    monkeypatch.setattr(retrieval, "_read_sums", lambda *_: pytest.fail("postings joined with queries"))
    assert _rows(retrieval.ranked_docs(queries, index, 0.7, 3))


def test_blocks_are_written_once(spark, index, queries, monkeypatch):
    """Blocks meet each other without being copied for every block of the other side."""
    monkeypatch.setattr(tiles, "MOST_CELLS", 0)
    monkeypatch.setattr(products, "LEAST", 10)
    plans, dealt = [], products.Products._dealt
    monkeypatch.setattr(products.Products, "_dealt", lambda *a: plans.append(dealt(*a)) or plans[-1])
    ranked = _rows(retrieval.ranked_docs(queries, index, 0.7, 3))
    assert ranked and len(plans) == 2
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Exchange" not in plan
    monkeypatch.setattr(products, "LEAST", 1_000_000)
    assert _rows(retrieval.ranked_docs(queries, index, 0.7, 3)) == ranked
