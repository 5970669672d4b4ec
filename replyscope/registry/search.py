"""Queries over features, retrieval, classification, duplicates and language."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyscope import constants as C
from replyscope.operators import classifier, dedup, dense, features, hybrid, index as I, language, retrieval
from replyscope.functions.replies import template_reply
from replyscope.operators.threads import nonempty_docs
from replyscope.plans import answer, golden
from replyscope.registry import sql as S
from replyscope.registry.inputs import documents, messages, r6, table, threads
from replyscope.session import cut_lineage, scratch_path


def _document_index(spark, d):
    docs = documents(spark, d).select(F.col("doc_id").cast("string").alias("doc_id"), F.trim("text").alias("text"))
    return I.index_build(docs.filter("text <> ''"))


def _thread_index(spark, d):
    return I.index_build(nonempty_docs(threads(spark, d)))


def _benchmark(spark, d):
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


# --- features -----------------------------------------------------------------------
def term_vocab(spark, d):
    return features.term_vocab(documents(spark, d), "text", 10_000, (1, 2))


def tfidf_vectors(spark, d):
    vectors = features.tfidf_vectors(documents(spark, d), "doc_id", "text", 5_000)
    return vectors.select("doc_id", "term", "tf", r6("weight").alias("weight"))


def weak_label_set(spark, d):
    t = threads(spark, d)
    return classifier.weak_label_set(t, t.count() // 2).select("tweet_id", "weak_intent")


# --- index ---------------------------------------------------------------------------
def index_build(spark, d):
    return _thread_index(spark, d).terms.select("kind", "term", "df", r6("idf").alias("idf"))


def index_save(spark, d):
    path = scratch_path(spark, "index")
    I.index_save(_thread_index(spark, d), path)
    read = {name: spark.read.parquet(f"{path}/{name}") for name in I.TABLES}
    kinds = read["terms"].groupBy("kind").agg(F.count(F.lit(1)).alias("terms"), r6(F.sum("idf")).alias("idf"))
    weights = read["postings"].join(read["terms"].select("term_key", "kind"), "term_key").join(read["texts"].select("text_key", "copies"), "text_key")
    weights = weights.groupBy("kind").agg(F.sum("copies").alias("postings"), F.round(F.sum(F.col("weight") * F.col("copies")), 4).alias("weight"))
    members = read["members"].agg(F.count(F.lit(1)).alias("members"), F.count_distinct("text_key").alias("texts"))
    both = kinds.join(weights, "kind").withColumn("one", F.lit(1))
    stats = read["stats"].select("n_docs", r6("average_length").alias("average_length"), F.lit(1).alias("one"))
    return both.join(stats, "one").join(members.withColumn("one", F.lit(1)), "one").drop("one")


def index_load(spark, d):
    """BM25 and TF-IDF weights of every document, after a round trip."""
    path = scratch_path(spark, "index")
    I.index_save(_thread_index(spark, d), path)
    loaded = I.index_load(spark, path)
    rows = loaded.postings.join(loaded.members, "text_key").join(loaded.terms, "term_key")
    return rows.select("kind", "doc_id", "term", r6("weight").alias("weight"))


# --- retrieval -----------------------------------------------------------------------
def _ranked(df, *columns):
    return df.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", *columns)


def bm25_scores(spark, d):
    found = retrieval.bm25_scores(_benchmark(spark, d), _document_index(spark, d), k=10)
    return _ranked(found, r6("bm25_raw").alias("bm25_raw"))


def minmax_per_query(spark, d):
    found = retrieval.ranked_docs(_benchmark(spark, d), _document_index(spark, d), alpha=1.0, k=10)
    return _ranked(found, r6("low").alias("low"), r6("high").alias("high"), r6("bm25").alias("bm25"))


def tfidf_cosine(spark, d):
    found = retrieval.tfidf_cosine(_benchmark(spark, d), _document_index(spark, d), k=10)
    return _ranked(found, r6("cosine").alias("cosine"))


def hybrid_ranked(spark, d):
    found = retrieval.ranked_docs(_benchmark(spark, d), _document_index(spark, d), k=10)
    return _ranked(found, r6("score").alias("score"), r6("bm25").alias("bm25"), r6("dense").alias("dense"))


def _hybrid_with(hot_texts):
    def query(spark, d):
        """Ranked with few rare terms, so that bounds and widening decide."""
        found = retrieval.ranked_docs(_benchmark(spark, d), _document_index(spark, d), k=10, hot_texts=hot_texts)
        return _ranked(found, r6("score").alias("score"), r6("bm25").alias("bm25"), r6("dense").alias("dense"))

    return query


def index_load_copies(spark, d):
    """Every document of an index in which one text has more than a hundred copies."""
    docs = documents(spark, d).select(F.col("doc_id").cast("string").alias("doc_id"), F.when(F.col("doc_id") % 3 == 0, "one reply for many").otherwise(F.concat(F.lit("reply "), F.col("doc_id"))).alias("text"))
    path = scratch_path(spark, "index")
    I.index_save(I.index_build(docs), path)
    loaded = I.index_load(spark, path)
    return loaded.members.join(loaded.texts.select("text_key", "text", "copies"), "text_key").select("doc_id", "text", "copies")


def hybrid_topk(spark, d):
    hits = retrieval.hybrid_topk(_benchmark(spark, d), _document_index(spark, d))
    return hits.select(
        "query_id",
        F.array_join(F.transform("retrieved", lambda h: h["doc_id"]), ",").alias("doc_ids"),
        r6(F.aggregate("retrieved", F.lit(0.0), lambda a, h: a + F.round(h["score"], 6))).alias("total"),
    )


def rerank_fuse(spark, d):
    """The cross-encoder score is a column; here it is a hash of the pair."""
    pool = retrieval.ranked_docs(_benchmark(spark, d), _document_index(spark, d), k=10)
    pair = F.md5(F.concat(F.col("query_id").cast("string"), F.lit(":"), F.col("doc_id")))
    pool = pool.withColumn("ce", F.conv(F.substring(pair, 1, 6), 16, 10).cast("double"))
    return _ranked(retrieval.rerank_fuse(pool), r6("score").alias("score"), "ce")


def rrf_fuse(spark, d):
    index, queries = _document_index(spark, d), _benchmark(spark, d)
    a = retrieval.ranked_docs(queries, index, alpha=1.0, k=10)
    b = retrieval.ranked_docs(queries, index, alpha=0.0, k=10)
    return retrieval.rrf_fuse(a, b).select("query_id", "doc_id", r6("rrf").alias("rrf"))


def dense_cosine(spark, d):
    vectors = table(spark, d, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    docs = vectors.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    return dense.dense_cosine(queries, docs, 5).select("query_id", "doc_id", r6("dense").alias("dense"), F.col("rank").cast("long").alias("rank"))


def dense_approximate(spark, d):
    """By buckets where these save anything; scores are exact, recall is measured."""
    vectors = table(spark, d, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    docs = vectors.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    return dense.dense_approximate(queries, docs, 5).select("query_id", "doc_id", r6("dense").alias("dense"), F.col("rank").cast("long").alias("rank"))


def _with_vectors(spark, d):
    """Documents and benchmark questions that have a vector of the same id."""
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("doc_id"), F.col("embedding").alias("vector"))
    docs = documents(spark, d).select(F.col("doc_id").cast("string").alias("doc_id"), F.trim("text").alias("text")).filter("text <> ''")
    docs = docs.join(vectors.select("doc_id"), "doc_id", "left_semi")
    asked = _benchmark(spark, d).join(vectors.select(F.col("doc_id").cast("long").alias("query_id"), "vector"), "query_id")
    return asked, I.index_build(docs), vectors.join(docs.select("doc_id"), "doc_id", "left_semi")


def hybrid_vectors(spark, d):
    found = hybrid.hybrid_vectors(*_with_vectors(spark, d), k=5)
    return _ranked(found, r6("score").alias("score"), r6("bm25").alias("bm25"), r6("dense").alias("dense"))


def hybrid_vectors_shallow(spark, d):
    """With cuts so early that most questions have to go deeper."""
    found = hybrid.hybrid_vectors(*_with_vectors(spark, d), k=5, depth=5)
    return _ranked(found, r6("score").alias("score"), r6("bm25").alias("bm25"), r6("dense").alias("dense"))


def answer_reranked(spark, d):
    """Benchmark questions as messages: vectors, the best ten reranked, answered."""
    asked, index, vectors = _with_vectors(spark, d)
    pool = hybrid.hybrid_vectors(asked, index, vectors, k=10)
    pair = F.md5(F.concat(F.col("query_id").cast("string"), F.lit(":"), F.col("doc_id")))
    pool = pool.withColumn("ce", F.conv(F.substring(pair, 1, 6), 16, 10).cast("double"))
    hits = retrieval.collect_hits(retrieval.rerank_fuse(pool), with_ce=True).select(F.col("query_id").cast("string").alias("tweet_id"), "retrieved")
    messages_ = asked.select(F.col("query_id").cast("string").alias("tweet_id"), F.col("query_text").alias("text"))
    answers = answer.answer_batch(messages_, index, hits=hits)
    return answers.select("tweet_id", "intent", F.array_join(F.transform("retrieved", lambda h: h["doc_id"]), ",").alias("doc_ids"), r6(F.col("retrieved")[0]["score"]).alias("best"))


def fallback_corpus(spark, d):
    """Threads answered from the stock replies."""
    hits = answer.answer_batch(threads(spark, d), I.fallback_corpus(spark))
    return hits.select("tweet_id", F.array_join(F.transform("retrieved", lambda h: h["doc_id"]), ",").alias("doc_ids"))


def _answer_columns(answers):
    return answers.select(
        "tweet_id", "brand", "intent", r6("intent_confidence").alias("intent_confidence"),
        F.array_join(F.transform("retrieved", lambda h: h["doc_id"]), ",").alias("doc_ids"),
        r6(F.coalesce(F.aggregate("retrieved", F.lit(0.0), lambda a, h: a + F.round(h["score"], 6)), F.lit(0.0))).alias("total"),
        "draft_reply", "escalate", "escalate_category",
    )


def answer_batch(spark, d):
    t = cut_lineage(threads(spark, d))
    return _answer_columns(answer.answer_batch(t, I.index_build(nonempty_docs(t))))


# --- classifier -----------------------------------------------------------------------
def _model(spark, d):
    t = cut_lineage(threads(spark, d))
    return t, classifier.train_intent(classifier.weak_label_set(t))


def train_intent(spark, d):
    """The fitted model: idf and weight of every term for every intent."""
    _, model = _model(spark, d)
    return classifier.model_weights(spark, model).select("intent", "term", r6("idf").alias("idf"), r6("weight").alias("weight"))


def _scored(t, model):
    return classifier.score_intent(t, model).select("tweet_id", "intent", r6("intent_confidence").alias("intent_confidence"))


def score_intent(spark, d):
    return _scored(*_model(spark, d))


def score_intent_unfitted(spark, d):
    return classifier.score_intent(threads(spark, d), None).select("tweet_id", "intent", "intent_confidence")


def _saved_and_loaded(spark, d):
    """Intents by the model that was saved and loaded, and whether the model in memory
    gives every row the same."""
    t, model = _model(spark, d)
    path = scratch_path(spark, "model")
    classifier.model_save(model, path)
    before = classifier.score_intent(t, model).select("*", F.struct("intent", "intent_confidence").alias("_before"))
    after = classifier.score_intent(before, classifier.model_load(path))
    same = F.struct("intent", "intent_confidence").eqNullSafe(F.col("_before"))
    return after.select("tweet_id", "intent", r6("intent_confidence").alias("intent_confidence"), same.alias("same"))


def model_save(spark, d):
    """Whether the saved and loaded model gives every row what the one in memory does."""
    return _saved_and_loaded(spark, d).select("tweet_id", "same")


def model_save_intents(spark, d):
    """As model_save, with the intents; a fit decides these, so there is no SQL."""
    return _saved_and_loaded(spark, d)


def model_load(spark, d):
    """No model at the path: keyword labels."""
    missing = classifier.model_load(scratch_path(spark, "no-model"))
    return classifier.score_intent(threads(spark, d), missing).select("tweet_id", "intent", "intent_confidence")


def holdout_report(spark, d):
    t = cut_lineage(threads(spark, d))
    report, _ = classifier.holdout_report(classifier.weak_label_set(t))
    return report.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"), "support")


def answer_with_model(spark, d):
    t, model = _model(spark, d)
    answers = answer.answer_batch(t, I.index_build(nonempty_docs(t)), model)
    return _answer_columns(answers).withColumn("intent_confidence", r6("intent_confidence"))


def answer_given_replies(spark, d):
    """Written replies instead of templates, with their grounded flag."""
    t = cut_lineage(threads(spark, d))
    answers = answer.answer_batch(t, I.index_build(nonempty_docs(t)), reply="brand_reply")
    return answers.select("tweet_id", F.md5("draft_reply").alias("draft"), "draft_model", "grounded")


def near_dup_small_blocks(spark, d):
    """As near_dup_pairs, in many rounds over short lists."""
    pairs = dedup.near_dup_pairs(documents(spark, d), "doc_id", "text", ["doc_id"], 0.9, first_block=16)
    return pairs.select("kept_doc_id", "removed_doc_id", r6("cosine").alias("cosine"))


# --- duplicates -------------------------------------------------------------------------
def near_dup_pairs(spark, d):
    pairs = dedup.near_dup_pairs(documents(spark, d), "doc_id", "text", ["doc_id"], 0.9)
    return pairs.select("kept_doc_id", "removed_doc_id", r6("cosine").alias("cosine"))


def near_dup_approximate(spark, d):
    """Found by bands; the exact cosine of every pair is above the threshold."""
    pairs = dedup.near_dup_approximate(documents(spark, d), "doc_id", "text", ["doc_id"], 0.9)
    return pairs.select("kept_doc_id", "removed_doc_id", r6("cosine").alias("cosine"))


def dedup_keep_first(spark, d):
    return dedup.dedup_keep_first(documents(spark, d), "doc_id", "text", ["doc_id"], 0.9).select("doc_id", "lang")


# --- language ----------------------------------------------------------------------------
def language_profiles(spark, d):
    return language.language_profiles(documents(spark, d)).select("lang", "gram", r6("logp").alias("logp"))


def detect_language(spark, d):
    docs = documents(spark, d)
    return language.detect_language(docs, cut_lineage(language.language_profiles(docs)), "doc_id", "text")


def filter_language(spark, d):
    docs = documents(spark, d)
    profiles = cut_lineage(language.language_profiles(docs))
    return language.filter_language(docs, profiles, "doc_id", "text").select("doc_id", "source")


# --- golden sets ---------------------------------------------------------------------------
def make_golden(spark, d):
    return golden.make_golden(messages(spark, d), 100)


def refine_golden(spark, d):
    t = cut_lineage(threads(spark, d))
    profiles = cut_lineage(language.language_profiles(documents(spark, d)))
    first = golden.make_golden(messages(spark, d), 100)
    return golden.refine_golden(first, t, profiles, None, n=110, min_per_class=8)


# --- SQL -------------------------------------------------------------------------------------
def corpus_sql(docs: str, queries: str, max_features: int = 10_000) -> list[str]:
    """CTEs from docs(doc_id, text) and queries(query_id, query_text) up to
    scored(query_id, doc_id, b, bm25, dense) over all pairs."""
    return [
        f"docs AS MATERIALIZED ({docs})",
        f"asked AS MATERIALIZED ({queries})",
        f"btok AS MATERIALIZED (SELECT doc_id, {S.tokens_ws('text')} AS t FROM docs)",
        "btf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM btok) GROUP BY ALL)",
        "dl AS (SELECT doc_id, len(t) AS l FROM btok)",
        "st AS MATERIALIZED (SELECT count(*) AS n, avg(l) AS avgdl FROM dl)",
        "rawidf AS MATERIALIZED (SELECT term, count(*) AS df, ln((SELECT n FROM st) - count(*) + 0.5) - ln(count(*) + 0.5) AS r FROM btf GROUP BY term)",
        "bidf AS MATERIALIZED (SELECT term, df, CASE WHEN r < 0 THEN 0.25 * (SELECT avg(r) FROM rawidf) ELSE r END AS idf FROM rawidf)",
        "bw AS MATERIALIZED (SELECT doc_id, term, tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * l / (SELECT avgdl FROM st))) AS w FROM btf JOIN dl USING (doc_id))",
        f"ctok AS MATERIALIZED (SELECT doc_id, list_concat(t, {S.bigrams('t')}) AS g FROM (SELECT doc_id, {S.tokens_word('text')} AS t FROM docs))",
        "ctf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(g) AS term FROM ctok) GROUP BY ALL)",
        f"cvoc AS MATERIALIZED (SELECT term, df, ln((1 + (SELECT n FROM st)) / (1.0::DOUBLE + df)) + 1 AS idf FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM ctf GROUP BY term ORDER BY cf DESC, term LIMIT {max_features}))",
        "cw AS MATERIALIZED (SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS w FROM ctf JOIN cvoc USING (term))",
        f"qb AS MATERIALIZED (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({S.tokens_ws('query_text')}) AS term FROM asked) GROUP BY ALL)",
        f"qg AS MATERIALIZED (SELECT query_id, term, count(*) AS tf FROM (SELECT query_id, unnest(list_concat(t, {S.bigrams('t')})) AS term FROM (SELECT query_id, {S.tokens_word('query_text')} AS t FROM asked)) GROUP BY ALL)",
        "qc AS MATERIALIZED (SELECT query_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY query_id)) AS w FROM qg JOIN cvoc USING (term))",
        "bsum AS MATERIALIZED (SELECT query_id, doc_id, sum(qtf * idf * w) AS b FROM qb JOIN bidf USING (term) JOIN bw USING (term) GROUP BY ALL)",
        "csum AS MATERIALIZED (SELECT query_id, doc_id, sum(qc.w * cw.w) AS c FROM qc JOIN cw USING (term) GROUP BY ALL)",
        "every AS MATERIALIZED (SELECT query_id, doc_id, coalesce(b, 0) AS b, coalesce(c, 0) AS dense FROM asked CROSS JOIN docs LEFT JOIN bsum USING (query_id, doc_id) LEFT JOIN csum USING (query_id, doc_id) WHERE query_text <> '')",
        "lim AS MATERIALIZED (SELECT query_id, min(b) AS low, max(b) AS high FROM every GROUP BY query_id)",
        "scored AS MATERIALIZED (SELECT query_id, doc_id, b, low, high, CASE WHEN high > low THEN (b - low) / (high - low) ELSE 0 END AS bm25, dense FROM every JOIN lim USING (query_id))",
        "hybrid AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM (SELECT *, 0.7 * bm25 + (1 - 0.7::DOUBLE) * dense AS score FROM scored))",
    ]


DOCS_SQL = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, trim(text) AS text FROM documents WHERE trim(text) <> ''"
BENCH_SQL = f"SELECT item_id AS query_id, {S.strip('text')} AS query_text FROM benchmark"
THREAD_DOCS_SQL = f"SELECT tweet_id AS doc_id, s AS text FROM (SELECT tweet_id, {S.strip('coalesce(nullif(brand_reply, chr(0)), inbound_text)')} AS s FROM threads) WHERE s <> ''".replace("chr(0)", "''")
THREAD_ASK_SQL = f"SELECT tweet_id AS query_id, {S.strip('inbound_text || CASE WHEN prev_turn <> chr(0) THEN chr(32) || prev_turn ELSE chr(0) END')} AS query_text FROM threads".replace("chr(0)", "''")
STOCK_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({S.q(i)}, {S.q(t)})" for i, t in C.STOCK_REPLIES) + ") AS v(doc_id, text)"


def bench_sql(body: str, *more: str) -> str:
    return "WITH " + ", ".join([*corpus_sql(DOCS_SQL, BENCH_SQL), *more]) + " " + body


def thread_sql(body: str, *more: str, docs: str = THREAD_DOCS_SQL) -> str:
    return S.with_threads(body, *corpus_sql(docs, THREAD_ASK_SQL), *more)


def top(order: str, columns: str, k: int = 10) -> str:
    return f"SELECT query_id, rank, doc_id, {columns} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round({order}, 9) DESC, doc_id) AS rank FROM scored) WHERE rank <= {k}"


TOTALS = "tops AS (SELECT query_id, string_agg(doc_id, ',' ORDER BY rank) AS doc_ids, round(sum(round(score, 6)), 6) AS total FROM hybrid WHERE rank <= 3 GROUP BY query_id)"
DUPLICATES = f"""tok AS MATERIALIZED (SELECT doc_id, {S.tokens_word('text')} AS t FROM documents),
tfs AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM tok) GROUP BY ALL),
voc AS MATERIALIZED (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + df)) + 1 AS idf
  FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM tfs GROUP BY term ORDER BY cf DESC, term LIMIT 5000)),
vec AS MATERIALIZED (SELECT doc_id, term, tf, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS w FROM tfs JOIN voc USING (term)),
sim AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, round(sum(a.w * b.w), 9) AS c FROM vec a JOIN vec b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY ALL HAVING round(sum(a.w * b.w), 9) > 0.9),
later AS MATERIALIZED (SELECT b, list(a) AS earlier, row_number() OVER (ORDER BY b) AS k FROM sim GROUP BY b),
walk(k, dropped) AS (SELECT CAST(0 AS BIGINT), []::BIGINT[] UNION ALL
  SELECT w.k + 1, CASE WHEN len(list_filter(l.earlier, lambda x: NOT list_contains(w.dropped, x))) > 0 THEN list_append(w.dropped, l.b) ELSE w.dropped END
  FROM walk w JOIN later l ON l.k = w.k + 1),
gone AS MATERIALIZED (SELECT unnest(dropped) AS doc_id FROM (SELECT dropped FROM walk ORDER BY k DESC LIMIT 1))"""
PROFILES = r"""norm AS MATERIALIZED (SELECT doc_id, lang, length(text) AS len, ' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) || ' ' AS t FROM documents),
grams AS MATERIALIZED (SELECT doc_id, lang, gram, count(*) AS n FROM (
  SELECT doc_id, lang, unnest(list_concat(list_concat(regexp_extract_all(t, '(?s).{3}'), regexp_extract_all(substr(t, 2), '(?s).{3}')), regexp_extract_all(substr(t, 3), '(?s).{3}'))) AS gram FROM norm) GROUP BY ALL),
bylang AS MATERIALIZED (SELECT lang, gram, CAST(sum(n) AS BIGINT) AS n FROM grams GROUP BY ALL),
sizes AS MATERIALIZED (SELECT lang, sum(n) + count(*) + 1 AS s FROM bylang GROUP BY lang),
prof AS MATERIALIZED (SELECT lang, gram, ln((n + 1.0::DOUBLE) / s) AS logp FROM (SELECT *, row_number() OVER () AS r FROM bylang) JOIN sizes USING (lang)
  UNION ALL SELECT lang, NULL, ln(1.0::DOUBLE / s) FROM sizes)"""
DETECT = """lows AS (SELECT lang AS l, logp AS low FROM prof WHERE gram IS NULL),
total AS (SELECT doc_id, sum(n) AS g FROM grams GROUP BY doc_id),
gain AS (SELECT g.doc_id, p.lang AS l, sum(g.n * (p.logp - low)) AS gain FROM grams g JOIN prof p ON p.gram = g.gram JOIN lows ON lows.l = p.lang GROUP BY ALL),
best AS (SELECT doc_id, first(l ORDER BY round(gain + g * low, 6) DESC, l) AS l FROM gain JOIN total USING (doc_id) JOIN lows USING (l) GROUP BY doc_id),
spoken AS (SELECT n.doc_id, CASE WHEN n.len <= 15 THEN 'en' ELSE coalesce(b.l, 'en') END AS language FROM norm n LEFT JOIN best b USING (doc_id))"""

def vector_sql(body: str, *more: str) -> str:
    docs = DOCS_SQL + " AND doc_id IN (SELECT vec_id FROM embeddings)"
    asked = BENCH_SQL + " WHERE item_id IN (SELECT vec_id FROM embeddings)"
    found = (
        "vec AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)",
        "vscored AS MATERIALIZED (SELECT s.query_id, s.doc_id, s.bm25, (list_cosine_similarity(a.v, b.v) + 1) / 2 AS near FROM scored s JOIN vec a ON a.vec_id = s.query_id JOIN vec b ON CAST(b.vec_id AS VARCHAR) = s.doc_id)",
        "vhybrid AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM (SELECT *, 0.7 * bm25 + (1 - 0.7::DOUBLE) * near AS score FROM vscored))",
    )
    return "WITH " + ", ".join([*corpus_sql(docs, asked), *found, *more]) + " " + body


VECTOR_SQL = vector_sql("SELECT query_id, rank, doc_id, round(score, 6) AS score, round(bm25, 6) AS bm25, round(near, 6) AS dense FROM vhybrid WHERE rank <= 5")
HYBRID_SQL = bench_sql("SELECT query_id, rank, doc_id, round(score, 6) AS score, round(bm25, 6) AS bm25, round(dense, 6) AS dense FROM hybrid WHERE rank <= 10")
NEAR_SQL = f"WITH RECURSIVE {DUPLICATES} SELECT min(a) AS kept_doc_id, b AS removed_doc_id, round(arg_min(c, a), 6) AS cosine FROM sim WHERE b IN (FROM gone) AND a NOT IN (FROM gone) GROUP BY b"
_ROUTED = S.route("inbound_text", "i", "0.45", "thread_len", "prev_turn")
ENTRIES = {
    "term_vocab": (
        term_vocab,
        f"WITH tok AS (SELECT doc_id, {S.tokens_word('text')} AS t FROM documents), tfs AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(list_concat(t, {S.bigrams('t')})) AS term FROM tok) GROUP BY ALL) "
        "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tfs GROUP BY term ORDER BY cf DESC, term LIMIT 10000",
    ),
    "tfidf_vectors": (tfidf_vectors, f"WITH RECURSIVE {DUPLICATES} SELECT doc_id, term, tf, round(w, 6) AS weight FROM vec"),
    "weak_label_set": (
        weak_label_set,
        S.with_threads(f"SELECT tweet_id, {S.label('inbound_text')} AS weak_intent FROM threads ORDER BY md5('42:' || tweet_id) LIMIT (SELECT count(*) // 2 FROM threads)"),
    ),
    "index_build": (index_build, thread_sql("SELECT 'b' AS kind, term, df, round(idf, 6) AS idf FROM bidf UNION ALL SELECT 'c', term, df, round(idf, 6) FROM cvoc")),
    "index_save": (
        index_save,
        thread_sql(
            "SELECT kind, terms, idf, postings, weight, (SELECT n FROM st) AS n_docs, (SELECT round(avgdl, 6) FROM st) AS average_length, (SELECT count(*) FROM docs) AS members, (SELECT count(DISTINCT text) FROM docs) AS texts FROM t JOIN p USING (kind)",
            "t AS (SELECT 'b' AS kind, count(*) AS terms, round(sum(idf), 6) AS idf FROM bidf UNION ALL SELECT 'c', count(*), round(sum(idf), 6) FROM cvoc)",
            "p AS (SELECT 'b' AS kind, count(*) AS postings, round(sum(w), 4) AS weight FROM bw UNION ALL SELECT 'c', count(*), round(sum(w), 4) FROM cw)",
        ),
    ),
    "index_load": (index_load, thread_sql("SELECT 'b' AS kind, doc_id, term, round(w, 6) AS weight FROM bw UNION ALL SELECT 'c', doc_id, term, round(w, 6) FROM cw")),
    "bm25_scores": (bm25_scores, bench_sql(top("bm25", "round(b, 6) AS bm25_raw"))),
    "minmax_per_query": (minmax_per_query, bench_sql(top("bm25", "round(low, 6) AS low, round(high, 6) AS high, round(bm25, 6) AS bm25"))),
    "tfidf_cosine": (tfidf_cosine, bench_sql(top("dense", "round(dense, 6) AS cosine"))),
    "hybrid_ranked": (hybrid_ranked, HYBRID_SQL),
    "index_load_copies": (
        index_load_copies,
        "WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 3 = 0 THEN 'one reply for many' ELSE 'reply ' || doc_id END AS text FROM documents) "
        "SELECT doc_id, text, count(*) OVER (PARTITION BY text) AS copies FROM t",
    ),
    "hybrid_hot_5": (_hybrid_with(5), HYBRID_SQL),
    "hybrid_hot_20": (_hybrid_with(20), HYBRID_SQL),
    "hybrid_topk": (hybrid_topk, bench_sql("SELECT * FROM tops", TOTALS)),
    "rerank_fuse": (
        rerank_fuse,
        bench_sql(
            "SELECT query_id, rank, doc_id, round(fused, 6) AS score, ce FROM fuse WHERE rank <= 3",
            "pool AS (SELECT query_id, doc_id, score, CAST(CAST('0x' || substr(md5(query_id || ':' || doc_id), 1, 6) AS BIGINT) AS DOUBLE) AS ce FROM hybrid WHERE rank <= 10)",
            "mm AS (SELECT *, min(ce) OVER (PARTITION BY query_id) AS lo, max(ce) OVER (PARTITION BY query_id) AS hi FROM pool)",
            "fz AS (SELECT query_id, doc_id, ce, 0.5 * score + 0.5 * CASE WHEN hi > lo THEN (ce - lo) / (hi - lo) ELSE 0 END AS fused FROM mm)",
            "fuse AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 9) DESC, doc_id) AS rank FROM fz)",
        ),
    ),
    "rrf_fuse": (
        rrf_fuse,
        bench_sql(
            "SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS rrf FROM lists GROUP BY ALL",
            "lists AS (" + top("bm25", "0 AS z") + " UNION ALL " + top("dense", "1 AS z") + ")",
        ),
    ),
    "dense_cosine": (
        dense_cosine,
        """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
           s AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, (list_cosine_similarity(a.v, b.v) + 1) / 2 AS dense FROM e a CROSS JOIN e b),
           r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(dense, 9) DESC, doc_id) AS rank FROM s)
           SELECT query_id, doc_id, round(dense, 6) AS dense, rank FROM r WHERE rank <= 5""",
    ),
    "dense_approximate": (dense_approximate, None),
    "hybrid_vectors": (hybrid_vectors, VECTOR_SQL),
    "hybrid_vectors_shallow": (hybrid_vectors_shallow, VECTOR_SQL),
    "answer_reranked": (
        answer_reranked,
        vector_sql(
            f"SELECT CAST(query_id AS VARCHAR) AS tweet_id, {S.label('query_text')} AS intent, doc_ids, best FROM told JOIN asked USING (query_id)",
            "pool AS (SELECT query_id, doc_id, score, CAST(CAST('0x' || substr(md5(query_id || ':' || doc_id), 1, 6) AS BIGINT) AS DOUBLE) AS ce FROM vhybrid WHERE rank <= 10)",
            "mm AS (SELECT *, min(ce) OVER (PARTITION BY query_id) AS lo, max(ce) OVER (PARTITION BY query_id) AS hi FROM pool)",
            "fz AS (SELECT query_id, doc_id, 0.5 * score + 0.5 * CASE WHEN hi > lo THEN (ce - lo) / (hi - lo) ELSE 0 END AS fused FROM mm)",
            "fuse AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 9) DESC, doc_id) AS rank FROM fz)",
            "told AS (SELECT query_id, string_agg(doc_id, ',' ORDER BY rank) AS doc_ids, round(max(fused), 6) AS best FROM fuse WHERE rank <= 3 GROUP BY query_id)",
        ),
    ),
    "fallback_corpus": (fallback_corpus, thread_sql("SELECT query_id AS tweet_id, doc_ids FROM tops", TOTALS, docs=STOCK_SQL)),
    "answer_batch": (
        answer_batch,
        thread_sql(
            f"""SELECT tweet_id, brand, i AS intent, 0.45::DOUBLE AS intent_confidence, coalesce(doc_ids, '') AS doc_ids, coalesce(total, 0) AS total, {S.template('i')} AS draft_reply,
                {_ROUTED[0]} AS escalate, {_ROUTED[2]} AS escalate_category FROM asking LEFT JOIN tops ON tops.query_id = asking.tweet_id""",
            TOTALS,
            f"asking AS MATERIALIZED (SELECT *, {S.label('inbound_text')} AS i FROM threads)",
        ),
    ),
    "train_intent": (train_intent, None),
    "score_intent": (score_intent, None),
    "score_intent_unfitted": (score_intent_unfitted, S.with_threads(f"SELECT tweet_id, {S.label('inbound_text')} AS intent, 0.4::DOUBLE AS intent_confidence FROM threads")),
    "model_save": (model_save, S.with_threads("SELECT tweet_id, true AS same FROM threads")),
    "model_save_intents": (model_save_intents, None),
    "model_load": (model_load, S.with_threads(f"SELECT tweet_id, {S.label('inbound_text')} AS intent, 0.4::DOUBLE AS intent_confidence FROM threads")),
    "holdout_report": (holdout_report, None),
    "answer_with_model": (answer_with_model, None),
    "answer_given_replies": (
        answer_given_replies,
        thread_sql(
            f"""SELECT tweet_id, md5(reply) AS draft, CASE WHEN brand_reply <> '' THEN 'given' ELSE 'heuristic' END AS draft_model,
                len(list_filter({S.long_numbers('reply')}, lambda n: NOT contains(coalesce(corpus, ''), n))) = 0 AS grounded FROM asking LEFT JOIN seen ON seen.query_id = asking.tweet_id""",
            "seen AS (SELECT query_id, string_agg(text, ' ' ORDER BY rank) AS corpus FROM hybrid JOIN docs USING (doc_id) WHERE rank <= 3 GROUP BY query_id)",
            f"asking AS MATERIALIZED (SELECT *, CASE WHEN brand_reply <> '' THEN brand_reply ELSE {S.template(S.label('inbound_text'))} END AS reply FROM threads)",
        ),
    ),
    "near_dup_small_blocks": (near_dup_small_blocks, NEAR_SQL),
    "near_dup_pairs": (near_dup_pairs, NEAR_SQL),
    "near_dup_approximate": (near_dup_approximate, None),
    "dedup_keep_first": (dedup_keep_first, f"WITH RECURSIVE {DUPLICATES} SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (FROM gone)"),
    "language_profiles": (language_profiles, f"WITH {PROFILES} SELECT lang, gram, round(logp, 6) AS logp FROM prof"),
    "detect_language": (detect_language, f"WITH {PROFILES}, {DETECT} SELECT * FROM spoken"),
    "filter_language": (filter_language, f"WITH {PROFILES}, {DETECT} SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM spoken WHERE language = 'en')"),
    "make_golden": (make_golden, None),
    "refine_golden": (refine_golden, None),
}
