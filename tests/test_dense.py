"""The metric index and the approximate route next to brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyscope.operators import dense


def frames(spark, queries, vectors):
    q = spark.createDataFrame([(f"q{i}", [float(x) for x in v]) for i, v in enumerate(queries)], "query_id string, vector array<double>")
    v = spark.createDataFrame([(i * 3 % len(vectors) if len(vectors) % 3 else i, [float(x) for x in v]) for i, v in enumerate(vectors)], "doc_id long, vector array<float>")
    return q.repartition(3), v.repartition(4)


def plain(q, v, k):
    rows = [(r["doc_id"], np.array(r["vector"], float)) for r in v.collect()]
    unit = lambda x: x / (np.linalg.norm(x) or 1.0)
    ids, matrix = np.array([i for i, _ in rows]), np.array([unit(x) for _, x in rows])
    out = {}
    for r in q.collect():
        scores = np.round((matrix @ unit(np.array(r["vector"])) + 1) / 2, 9)
        out[r["query_id"]] = [int(ids[i]) for i in np.lexsort((ids, -scores))[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["doc_id"])
    return out


def clustered(rng, n, centres=20, dim=16, spread=0.05):
    middle = rng.normal(size=(centres, dim))
    return np.array([middle[i % centres] + spread * rng.normal(size=dim) for i in range(n)])


@pytest.mark.parametrize("block, pivots, k", [(20_000, 256, 4), (50, 16, 4), (7, 3, 1), (30, 40, 60)])
def test_exact_for_every_block_and_pivot(spark, block, pivots, k):
    rng = np.random.default_rng(block)
    vectors = np.vstack([clustered(rng, 300), rng.normal(size=(100, 16)), np.zeros((3, 16)), np.repeat(rng.normal(size=(1, 16)), 60, axis=0)])
    queries = np.vstack([vectors[::17], rng.normal(size=(15, 16)), np.zeros((1, 16))])
    q, v = frames(spark, queries, vectors)
    assert answers(dense.dense_cosine(q, v, k, block, pivots)) == plain(q, v, k)


def test_rings_far_away_are_not_read(spark):
    rng = np.random.default_rng(1)
    q, v = frames(spark, clustered(np.random.default_rng(1), 80), clustered(rng, 4_000))
    index = dense.Rings(v, 100, 64)
    best = dense.dense_cosine(q, v, 5, 100, 64)
    floors = best.groupBy("query_id").agg((2 * F.min("dense") - 1).alias("floor"))
    asked = dense._plain(q, "query_id")
    first, rest = dense._chosen(asked, index, 5, False).count(), dense._chosen(asked.join(floors, "query_id"), index, 5, True).count()
    assert answers(best) == plain(q, v, 5)
    assert first + rest < 0.3 * 80 * len(index.rings)


def test_approximate_recall(spark, monkeypatch):
    asked, exact_route = [], dense.dense_cosine
    monkeypatch.setattr(dense, "dense_cosine", lambda q, *a: asked.append(q.count()) or exact_route(q, *a))
    rng = np.random.default_rng(7)
    q, v = frames(spark, clustered(rng, 200, 200, 16, 0.3), clustered(np.random.default_rng(7), 40_000, 200, 16, 0.3))
    want = plain(q, v, 5)
    rows = dense.dense_approximate(q, v, 5)
    got = answers(rows)
    assert sum(len(set(got.get(name, [])) & set(ids)) for name, ids in want.items()) >= 0.9 * 5 * len(want)
    assert asked == [200]  # the audit only
    assert all(0 <= r["dense"] <= 1 for r in rows.collect())


def test_approximate_falls_back_on_the_exact_answer(spark):
    rng = np.random.default_rng(3)
    q, v = frames(spark, rng.normal(size=(30, 64)), rng.normal(size=(500, 64)))
    assert answers(dense.dense_approximate(q, v, 5)) == plain(q, v, 5)  # nothing to gain from buckets
    assert dense.dense_approximate(q, v.limit(0), 5).count() == dense.dense_approximate(q.limit(0), v, 5).count() == 0
    assert dense.dense_cosine(q, v.limit(0), 5).count() == 0


def test_a_block_is_sent_to_few_parts_of_its_queries(spark):
    rows = spark.createDataFrame([(1,), (6_000,), (100_000,), (615_360,)], "n long").orderBy("n")
    assert [r[0] for r in rows.select(dense._parts(F.col("n"))).collect()] == [1, 3, 16, 31]
