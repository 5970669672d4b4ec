"""BM25 together with cosine of given vectors, exact without scoring all pairs.

Both rankings are cut at a depth. No document below both cuts can score more than
the two scores at the cuts together (Fagin's threshold algorithm), so a query is
answered once its k-th best candidate reaches that bound; the others go deeper."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.operators.dense import dense_cosine
from replyscope.operators.index import Index
from replyscope.operators.ordering import top_per_group
from replyscope.operators.retrieval import distinct_queries, keyed_queries, query_terms, ranked_distinct
from replyscope.session import cut_lineage

DEPTH = 64
DEEPER = 8


def _cosine(a, b):
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.coalesce(dot / F.nullif(length(a) * length(b), F.lit(0.0)), F.lit(0.0))


def _bm25_of(pairs: DataFrame, asked: DataFrame, limits: DataFrame, index: Index) -> DataFrame:
    """(q_key, doc_id, bm25) of given pairs, scaled by the limits of their query."""
    texts = cut_lineage(pairs.join(index.members.drop("pos"), "doc_id"))
    terms = query_terms(asked, index).filter("kind = 'b'").select("q_key", "term_key", "qw")
    hits = texts.select("q_key", "text_key").distinct().join(terms, "q_key").join(index.postings, ["term_key", "text_key"])
    scores = hits.groupBy("q_key", "text_key").agg(F.sum(F.col("qw") * F.col("weight")).alias("b"))
    width = F.col("high") - F.col("low")
    scaled = F.when(width > 0, (F.coalesce("b", F.lit(0.0)) - F.col("low")) / width).otherwise(F.lit(0.0))
    joined = texts.join(scores, ["q_key", "text_key"], "left").join(limits, "q_key")
    return joined.select("q_key", "doc_id", scaled.alias("bm25"))


def hybrid_vectors(queries: DataFrame, index: Index, vectors: DataFrame, alpha: float = 0.7, k: int = 3, depth: int = DEPTH) -> DataFrame:
    """(query_id, rank, doc_id, text, score, bm25, dense): the best k documents by
    alpha * scaled BM25 + (1 - alpha) * (cosine + 1) / 2. queries have (query_id,
    query_text, vector), vectors have one row (doc_id, vector) for every document
    of the index. Queries without text or vector have no hits."""
    vectors = vectors.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("vector").cast("array<double>").alias("vector"))
    asked = keyed_queries(queries.filter(F.col("vector").isNotNull()), "query_text").filter("q_text <> ''")
    asked = cut_lineage(asked.select("query_id", "q_key", "q_text", F.col("vector").cast("array<double>").alias("vector")))
    answers = None
    while True:
        words = ranked_distinct(distinct_queries(asked.select("q_key", "q_text")), index, 1.0, depth)
        words = cut_lineage(words.select("q_key", "doc_id", "bm25", "low", "high"))
        limits = cut_lineage(words.groupBy("q_key").agg(F.first("low").alias("low"), F.first("high").alias("high"), F.min("bm25").alias("last_b")))
        near = cut_lineage(dense_cosine(asked.select("query_id", "vector"), vectors, depth).select("query_id", "doc_id", "dense"))
        last = near.groupBy("query_id").agg(F.min("dense").alias("last_d"))
        keys = asked.select("query_id", "q_key")
        pairs = cut_lineage(words.join(keys, "q_key").select("query_id", "doc_id").union(near.select("query_id", "doc_id")).distinct())
        by_text = pairs.join(keys, "query_id").select("q_key", "doc_id").distinct()
        bm25 = _bm25_of(by_text, asked.select("q_key", "q_text").distinct(), limits, index)
        scored = pairs.join(asked.select("query_id", "q_key", F.col("vector").alias("q")), "query_id").join(vectors, "doc_id")
        scored = scored.withColumn("dense", (_cosine(F.col("q"), F.col("vector")) + 1) / 2).join(bm25, ["q_key", "doc_id"])
        scored = scored.select("query_id", "q_key", "doc_id", "bm25", "dense", (alpha * F.col("bm25") + (1 - alpha) * F.col("dense")).alias("score"))
        best = cut_lineage(top_per_group(scored, ["query_id"], [F.desc(F.round("score", 9)), F.col("doc_id")], k))
        bound = limits.join(keys, "q_key").join(last, "query_id").select("query_id", (alpha * F.col("last_b") + (1 - alpha) * F.col("last_d")).alias("bound"))
        kth = best.groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).join(bound, "query_id")
        sure = F.lit(depth >= index.n_docs) | ((F.col("n") >= k) & (F.col("kth") > F.col("bound") + 1e-8))
        done = cut_lineage(kth.filter(sure).select("query_id"))
        part = best.join(done, "query_id", "left_semi").drop("q_key")
        answers = part if answers is None else answers.unionByName(part)
        asked = cut_lineage(asked.join(done, "query_id", "left_anti"))
        if depth >= index.n_docs or asked.isEmpty():
            break
        depth *= DEEPER
    text = index.members.select("doc_id", "text_key").join(index.texts.select("text_key", "text"), "text_key").drop("text_key")
    return answers.join(text, "doc_id").select("query_id", "rank", "doc_id", "text", "score", "bm25", "dense")
