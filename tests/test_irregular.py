"""Input that the SQL comparisons do not contain: duplicates, nulls, ties, long groups."""

import itertools

import pytest
from pyspark.sql import functions as F

from replyscope.operators import agreement, dedup, index as I, language, metrics, ordering, retrieval, sampling
from replyscope.operators.chains import reply_chain_depth
from replyscope.operators.classifier import train_intent


def test_rows_are_paired_by_position(spark):
    gold = spark.createDataFrame([(10, "a"), (20, "b"), (30, "c")], "row_ord int, intent string")
    pred = spark.createDataFrame([(1, "w"), (2, "x"), (3, "y"), (4, "z")], "row_ord int, intent string")
    rows = metrics.align_predictions(gold, pred).orderBy("position").collect()
    assert [(r["position"], r["gold_intent"], r["pred_intent"]) for r in rows] == [(0, "a", "w"), (1, "b", "x"), (2, "c", "y")]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_positions_and_totals_do_not_depend_on_partitions(spark, partitions):
    df = spark.createDataFrame([(i * 7 % 101, i) for i in range(101)], "k int, v long").repartition(partitions)
    got = {r["k"]: (r["at"], r["total"]) for r in ordering.running_total(ordering.dense_positions(df, [F.col("k")], "at"), [F.col("k")], "v", "total").collect()}
    values = {i * 7 % 101: i for i in range(101)}
    sums = list(itertools.accumulate(values[k] for k in range(101)))
    assert got == {k: (k, sums[k]) for k in range(101)}


def test_undated_copy_does_not_displace_a_dated_one(spark):
    text = "where is my parcel it should be here"
    df = spark.createDataFrame([("undated", None, text), ("dated", "2017-10-02", text)], "id string, at string, text string")
    kept = dedup.dedup_keep_first(df.withColumn("at", F.to_timestamp("at")), "id", "text", ["at"])
    assert [r["id"] for r in kept.collect()] == ["dated"]


def test_stratified_sample_has_exactly_n_rows(spark):
    rows = [(str(i % 60), f"text {i} refund" if i % 3 else "plain") for i in range(120)]
    df = spark.createDataFrame(rows, "tweet_id string, inbound_text string")
    picked = sampling.stratified_sample(df, 50)
    assert picked.count() == 50 and picked.columns == df.columns


def test_first_n_has_one_tie_rule(spark, monkeypatch):
    df = spark.createDataFrame([("same", i) for i in range(40)], "k string, v int")
    few = sorted(r["v"] for r in ordering.first_n(df.repartition(5), F.md5("k"), 7).collect())
    monkeypatch.setattr(ordering, "SMALL_N", 0)
    monkeypatch.setattr(ordering, "LAST_BUCKET", 3)
    assert sorted(r["v"] for r in ordering.first_n(df.repartition(2), F.md5("k"), 7).collect()) == few


def test_auroc_keeps_small_differences_and_leaves_out_null_scores(spark):
    df = spark.createDataFrame([(True, 0.1000002), (False, 0.1000001), (True, None), (False, None)], "gold_escalate boolean, s double")
    row = metrics.escalate_auroc(df, "s").first()
    assert row["auroc"] == 1.0 and row["n"] == 2


def test_ratings_keep_fractions(spark):
    rows = [("a", 4.9, 3.5), ("b", 3.0, 3.5)]
    columns = ", ".join(f"{d}_{s} double" for d in agreement.DIMENSIONS for s in ("human", "judge"))
    df = spark.createDataFrame([(k, *([h, j] * 4)) for k, h, j in rows], f"tweet_id string, {columns}")
    assert {r["within_one"] for r in agreement.within_one(agreement.pair_counts(df)).collect()} == {0.5}


def test_chain_into_a_circle_ends_without_many_rounds(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "b"), ("d", "")], "tweet_id string, in_response_to_tweet_id string")
    assert {r["tweet_id"]: r["depth"] for r in reply_chain_depth(df).collect()} == {"a": None, "b": None, "c": None, "d": 1}


def test_one_language_row_per_key(spark):
    labelled = spark.createDataFrame([("the and of the and", "en"), ("der die das und", "de")], "text string, lang string")
    docs = spark.createDataFrame([("1", "der die das und der")] * 3, "id string, text string")
    assert [tuple(r) for r in language.detect_language(docs, language.language_profiles(labelled), "id", "text").collect()] == [("1", "de")]


def test_index_keeps_every_copy_and_any_k(spark):
    docs = spark.createDataFrame([(f"{i:04d}", "same reply text") for i in range(150)] + [(f"x{i}", f"other words {i}") for i in range(4)], "doc_id string, text string")
    index = I.index_build(docs)
    assert index.members.count() == 154 and index.members.select("doc_id").distinct().count() == 154
    queries = spark.createDataFrame([("q", "same reply text")], "query_id string, query_text string")
    hits = retrieval.ranked_docs(queries, index, k=130).orderBy("rank").collect()
    assert [h["doc_id"] for h in hits] == [f"{i:04d}" for i in range(130)]


@pytest.mark.parametrize("hot_texts", [1, 3, 2_000])
def test_index_with_negative_weights_is_ranked_like_all_pairs(spark, hot_texts):
    words = ["red", "blue", "green", "gold"]
    docs = [(f"{i:02d}", " ".join(p)) for i, p in enumerate(itertools.permutations(words, 3))] + [("98", "pink"), ("99", "pink pink")]
    index = I.index_build(spark.createDataFrame(docs, "doc_id string, text string"))
    assert index.signed
    asked = [("a", "red blue"), ("b", "pink"), ("c", "unknown"), ("d", "gold gold red green blue")]
    got = retrieval.ranked_docs(spark.createDataFrame(asked, "query_id string, query_text string"), index, alpha=1.0, k=6, hot_texts=hot_texts)
    weight = {(r["text_key"], r["term"]): r["weight"] * r["idf"] for r in index.postings.join(index.terms.filter("kind = 'b'"), "term_key").collect()}
    key = {r["text"]: r["text_key"] for r in index.texts.collect()}
    for name, text in asked:
        b = {d: sum(weight.get((key[t], w), 0.0) for w in text.split()) for d, t in docs}
        low, high = min(b.values()), max(b.values())
        scaled = {d: (x - low) / (high - low) if high > low else 0.0 for d, x in b.items()}
        best = sorted(scaled, key=lambda d: (-round(scaled[d], 9), d))[:6]
        assert [r["doc_id"] for r in got.filter(F.col("query_id") == name).orderBy("rank").collect()] == best, name


def test_label_outside_the_taxonomy_is_left_out_of_training(spark):
    rows = [(f"refund my payment {i}", "billing_refund") for i in range(12)] + [(f"where is the order {i}", "order_shipping") for i in range(12)] + [("x", "no such label")]
    from replyscope.constants import INTENTS

    rows = [(t, INTENTS[0] if "refund" in t else INTENTS[1] if "order" in t else label) for t, label in rows]
    assert train_intent(spark.createDataFrame(rows, "inbound_text string, weak_intent string"), max_iter=20) is not None
