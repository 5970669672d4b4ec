"""Blocks of postings: same rows as reading everything, fewer postings read."""

import random

from pyspark.sql import functions as F

from replyscope.operators import index as I, retrieval

SMALL = "/root/testdata/sf0.01"


def read_so_far(terms):
    open_ = F.filter("levels", lambda x: F.col("unread").isNull() | (x["level"] < F.col("unread")))
    read = F.aggregate(open_, F.lit(0).cast("long"), lambda total, x: total + x["n"])
    return terms.agg(F.sum(read), F.sum("n_texts")).first()


def test_blocks_describe_the_postings(spark):
    rng = random.Random(5)
    docs = [(f"d{i}", " ".join(rng.choice("a1 b2 c3 d4 e5 f6".split()) for _ in range(rng.randrange(1, 40)))) for i in range(200)]
    index = I.index_build(spark.createDataFrame(docs, "doc_id string, text string"))
    postings = {}
    for r in index.postings.collect():
        postings.setdefault((r.term_key, r.level), []).append(r.weight)
    told = {(t.term_key, x.level): (x.n, x.most) for t in index.terms.collect() for x in t.levels}
    assert told == {key: (len(w), max(w)) for key, w in postings.items()}
    for t in index.terms.collect():
        most = [x.most for x in t.levels]
        assert most == sorted(most, reverse=True) and sum(x.n for x in t.levels) == t.n_texts
        # Every weight of a block is above every weight of the next one.
        lists = [postings[(t.term_key, x.level)] for x in t.levels]
        assert all(min(a) > max(b) for a, b in zip(lists, lists[1:]))


def test_limits_of_unread_blocks(spark):
    levels = [(0, 2, 1.0), (1, 3, 0.8), (4, 5, 0.5)]
    rows = [(1, 10, 100, levels), (2, 10, 8, levels), (3, 10, 9, levels), (4, 10, 10, levels), (5, 10, 0, levels)]
    terms = spark.createDataFrame(rows, "id int, n_texts long, hot_texts long, levels array<struct<level:int,n:long,most:double>>")
    half = {r.id: (r.unread, r.rest) for r in retrieval.with_unread(terms, 0.5).collect()}
    assert half == {1: (None, 0.0), 2: (1, 0.8), 3: (1, 0.8), 4: (None, 0.0), 5: (0, 1.0)}
    whole = {r.id: (r.unread, r.rest) for r in retrieval.with_unread(terms, 1.0).collect()}
    assert whole[2] == (4, 0.5) and whole[3] == (4, 0.5)


def test_fewer_postings_and_the_same_rows(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("trim(text) != ''")
    index = I.index_build(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text"))
    asked = spark.read.parquet(f"{SMALL}/benchmark.parquet").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    passes = []
    answered = retrieval._answered

    def counted(terms, *rest):
        passes.append(tuple(read_so_far(retrieval.with_unread(terms))))
        return answered(terms, *rest)

    monkeypatch.setattr(retrieval, "_answered", counted)

    def ranked(hot_texts):
        passes.clear()
        found = retrieval.ranked_docs(asked, index, k=10, hot_texts=hot_texts)
        return sorted(tuple(r) for r in found.select("query_id", "rank", "doc_id", F.round("score", 6)).collect())

    everything = ranked(1_000_000)
    every = passes[0][0]
    assert passes == [(every, every)]
    assert ranked(60) == everything
    assert len(passes) == 2 and sum(read for read, _ in passes) < every / 2, (passes, every)
