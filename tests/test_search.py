"""Retrieval, duplicates, language and classifier against plain Python."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from replyscope.constants import INTENTS, STOP_WORDS
from replyscope.operators import classifier, dedup, dense, index as I, language, retrieval
from replyscope.plans import answer
from replyscope.plans.golden import make_golden, refine_golden
from replyscope.sources.raw import normalize_raw, synth_messages
from replyscope.operators.threads import build_threads

WORDS = ["order", "late", "refund", "parcel", "blue", "chair", "lamp", "thanks", "sorry", "please", "dm", "now"]


def words_of(text):
    return [w for w in text.lower().split() if len(w) > 1 and w not in STOP_WORDS]


def grams_of(text):
    words = words_of(text)
    return words + [" ".join(p) for p in zip(words, words[1:])]


def unit(weights):
    norm = math.sqrt(sum(v * v for v in weights.values()))
    return {k: v / norm for k, v in weights.items()} if norm else {}


def brute_force(docs, query, alpha, k):
    """Ranked (doc_id, score) over every document."""
    tokens = [t.lower().split() for _, t in docs]
    n, mean = len(docs), sum(map(len, tokens)) / len(docs)
    df = collections.Counter(w for t in tokens for w in set(t))
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    bm25 = []
    for t in tokens:
        tf = collections.Counter(t)
        bm25.append(sum(idf.get(w, 0) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(t) / mean)) for w in query.lower().split()))
    low, high = min(bm25), max(bm25)
    bm25 = [(b - low) / (high - low) if high > low else 0.0 for b in bm25]
    gdf = collections.Counter(g for _, t in docs for g in set(grams_of(t)))
    gidf = {g: math.log((1 + n) / (1 + c)) + 1 for g, c in gdf.items()}

    def vector(text):
        return unit({g: c * gidf[g] for g, c in collections.Counter(grams_of(text)).items() if g in gidf})

    asked = vector(query)
    cosine = [sum(w * asked.get(g, 0) for g, w in vector(t).items()) for _, t in docs]
    scored = [(d, alpha * b + (1 - alpha) * c) for (d, _), b, c in zip(docs, bm25, cosine)]
    return sorted(scored, key=lambda s: (-round(s[1], 9), s[0]))[:k]


def corpus(seed, n=60):
    rng = random.Random(seed)
    docs = [(f"d{i:03d}", "the " * rng.randrange(2) + " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 9)))) for i in range(n)]
    # A third of the documents are copies of one reply.
    return [(d, docs[0][1] if i % 3 == 0 else t.strip()) for i, (d, t) in enumerate(docs)]


@pytest.mark.parametrize("hot_texts", [0, 5, 1000])
def test_hybrid_equals_brute_force(spark, hot_texts):
    docs = corpus(1)
    queries = [(i, " ".join(random.Random(i).choice(WORDS + ["the", "unknown"]) for _ in range(1 + i % 6))) for i in range(12)]
    queries += [(90, "zzz"), (91, "  "), (92, "order order late"), (93, "order order late")]
    index = I.index_build(spark.createDataFrame(docs, "doc_id string, text string"))
    asked = spark.createDataFrame(queries, "query_id int, query_text string")
    hits = {r.query_id: [(h.doc_id, h.score) for h in r.retrieved] for r in retrieval.hybrid_topk(asked, index, k=7, hot_texts=hot_texts).collect()}
    assert hits[91] == []
    for qid, text in queries:
        if qid == 91:
            continue
        expected = brute_force(docs, text, 0.7, 7)
        assert [d for d, _ in hits[qid]] == [d for d, _ in expected], (qid, text)
        assert [s for _, s in hits[qid]] == pytest.approx([s for _, s in expected])


@pytest.mark.parametrize(
    "docs",
    [
        [("a", "order late")],
        [("a", "order late"), ("b", "order late"), ("c", "order late blue")],
        [("a", "order"), ("b", "order late"), ("c", "order late"), ("d", "late order blue"), ("e", "order late")],
    ],
)
def test_tiny_corpora_with_negative_weights(spark, docs):
    index = I.index_build(spark.createDataFrame(docs, "doc_id string, text string"))
    for text in ("order", "late order", "blue", "none"):
        asked = spark.createDataFrame([(1, text)], "query_id int, query_text string")
        got = [(h.doc_id, h.score) for h in retrieval.hybrid_topk(asked, index, k=3).first().retrieved]
        expected = brute_force(docs, text, 0.7, 3)
        assert [d for d, _ in got] == [d for d, _ in expected], text
        assert [s for _, s in got] == pytest.approx([s for _, s in expected])


def test_saved_index_and_stock_replies(spark, tmp_path):
    index = I.fallback_corpus(spark)
    I.index_save(index, str(tmp_path / "ix"))
    loaded = I.index_load(spark, str(tmp_path / "ix"))
    asked = spark.createDataFrame([(1, "login password reset")], "query_id int, query_text string")
    for one in (index, loaded):
        assert [h.doc_id for h in retrieval.hybrid_topk(asked, one).first().retrieved][0] == "3"


def test_rerank_keeps_own_scores(spark):
    pool = spark.createDataFrame([("q", "a", 0.9, 1.0), ("q", "b", 0.8, 5.0), ("q", "c", 0.1, 3.0)], "query_id string, doc_id string, score double, ce double")
    got = [(r.doc_id, r.score) for r in retrieval.rerank_fuse(pool, 2).orderBy("rank").collect()]
    assert got == [("b", pytest.approx(0.9)), ("a", pytest.approx(0.45))]


def test_dense_blocks(spark, monkeypatch):
    monkeypatch.setattr(dense, "QUERY_BLOCK", 7)
    monkeypatch.setattr(dense, "VECTOR_BLOCK", 9)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(5)]) for i in range(40)] + [(99, [0.0] * 5)]
    vectors = spark.createDataFrame(rows, "doc_id int, vector array<float>")
    got = collections.defaultdict(list)
    for r in dense.dense_cosine(vectors.withColumnRenamed("doc_id", "query_id"), vectors, 4).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.doc_id)
    for q, x in rows[:40]:
        def cosine(y):
            return sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x) * sum(b * b for b in y) or 1.0)

        assert got[q] == [d for d, _ in sorted(rows, key=lambda r: (-round((cosine(r[1]) + 1) / 2, 7), r[0]))[:4]]


def plain_dedup(rows, thresh, max_features):
    """Sequential pass over (id, text) in order: kept ids, first owner per removed id."""
    tf = [collections.Counter(words_of(t)) for _, t in rows]
    cf = collections.Counter(w for c in tf for w in c.elements())
    vocab = [w for w, _ in sorted(cf.items(), key=lambda x: (-x[1], x[0]))][:max_features]
    df = {w: sum(w in c for c in tf) for w in vocab}
    idf = {w: math.log((1 + len(rows)) / (1 + df[w])) + 1 for w in vocab}
    vectors = [unit({w: c * idf[w] for w, c in x.items() if w in idf}) for x in tf]
    kept, removed = [], {}
    for i, v in enumerate(vectors):
        owner = next((j for j in kept if round(sum(w * vectors[j].get(t, 0) for t, w in v.items()), 9) > thresh), None)
        if owner is None:
            kept.append(i)
        else:
            removed[rows[i][0]] = rows[owner][0]
    return {rows[i][0] for i in kept}, removed


@pytest.mark.parametrize("seed,thresh,max_features,block", [(1, 0.9, 5000, 256), (2, 0.7, 5000, 2), (3, 0.5, 6, 1), (4, 0.8, None, 1)])
def test_dedup_equals_sequential_pass(spark, seed, thresh, max_features, block):
    rng = random.Random(seed)
    rows = []
    for i in range(90):
        if i % 3 == 0:
            text = "order late refund parcel blue"  # a third of the rows
        elif i % 3 == 1 and rows:
            text = rng.choice(rows)[1] + " " + rng.choice(WORDS)
        else:
            text = " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 7)))
        rows.append((i, text))
    df = spark.createDataFrame(rows, "id int, text string")
    kept, removed = plain_dedup(rows, thresh, max_features)
    options = {"thresh": thresh, "max_features": max_features, "first_block": block}
    assert {r.id for r in dedup.dedup_keep_first(df, "id", "text", ["id"], **options).collect()} == kept
    pairs = dedup.near_dup_pairs(df, "id", "text", ["id"], **options).collect()
    assert {r.removed_id: r.kept_id for r in pairs} == removed


def test_language_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train, test = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    profiles = language.language_profiles(train)
    found = language.detect_language(test, profiles, "doc_id", "text").join(test, "doc_id")
    assert found.count() == test.count()
    assert found.agg(F.avg((F.col("language") == F.col("lang")).cast("int"))).first()[0] > 0.95
    short = spark.createDataFrame([(1, "ça va"), (2, ""), (3, None), (4, "1234567890 1234567890")], "id int, t string")
    assert {r.language for r in language.detect_language(short, profiles, "id", "t").collect()} == {"en"}


def test_classifier_learns_planted_labels(spark, tmp_path):
    marks = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf"]
    rng = random.Random(1)
    rows = []
    for i in range(280):
        k = i % 7 if i % 4 else 0  # the first class is frequent, 'other' is absent
        rows.append((str(i), f"{rng.choice(WORDS)} {marks[k]} {rng.choice(WORDS)} message", INTENTS[k]))
    df = spark.createDataFrame(rows, "tweet_id string, inbound_text string, weak_intent string")
    model = classifier.train_intent(df, max_iter=50)
    scored = classifier.score_intent(df, model)
    assert scored.filter("intent = weak_intent").count() >= 0.95 * len(rows)
    assert scored.filter("intent = 'other'").count() == 0
    assert 0 < scored.agg(F.min("intent_confidence")).first()[0] <= scored.agg(F.max("intent_confidence")).first()[0] <= 1
    classifier.model_save(model, str(tmp_path / "m"))
    again = classifier.score_intent(df, classifier.model_load(str(tmp_path / "m")))
    assert again.join(scored, ["tweet_id", "intent"]).count() == len(rows)
    assert classifier.model_load(str(tmp_path / "none")) is None


def test_answer_batch_fields(spark):
    index = I.fallback_corpus(spark)
    rows = [("1", "my order is late", "", 1, "keep"), ("2", "", "", 0, "keep"), ("3", "I was hacked, login fails", "again", 9, "keep")]
    messages = spark.createDataFrame(rows, "tweet_id string, text string, prev string, thread_len int, extra string").withColumn("intent", F.lit("old"))
    got = {r.tweet_id: r for r in answer.answer_batch(messages, index).collect()}
    assert got["1"].intent == "order_shipping" and len(got["1"].retrieved) == 3 and got["1"].extra == "keep"
    assert got["2"].retrieved == [] and got["2"].intent == "other"
    assert got["1"].escalate_category == "low_confidence"  # keyword labels have confidence 0.45
    assert answer.constant_prediction(messages).filter("escalate").count() == 0


def test_golden_sets(spark):
    raw = normalize_raw(synth_messages(spark, 400))
    golden = make_golden(raw, 40)
    threads = build_threads(raw)
    assert golden.count() <= 40 and golden.filter("needs_human_review").count() == golden.count()
    assert make_golden(raw, 4000).count() == threads.count()
    profiles = language.language_profiles(spark.createDataFrame([("en", "where is my order please help me now"), ("de", "wo ist denn meine bestellung bitte")], "lang string, text string"))
    refined = refine_golden(golden, threads, profiles, None, n=60, min_per_class=4)
    ids = [r.tweet_id for r in refined.collect()]
    assert len(ids) == len(set(ids)) <= 60
    assert refined.filter("human_labelled and not needs_human_review").count() == len(ids)
