"""Saved index tables: buckets by term that a join by term reads in place."""

from pyspark.sql import functions as F

from replyscope.operators import index as I, language, retrieval


def test_postings_are_joined_without_an_exchange(spark, tmp_path):
    docs = [(f"d{i}", f"word{i % 7} reply number{i % 31} common") for i in range(300)]
    built = I.index_build(spark.createDataFrame(docs, "doc_id string, text string"))
    I.index_save(built, str(tmp_path / "index"), buckets=4)
    loaded = I.index_load(spark, str(tmp_path / "index"))
    assert (loaded.n_docs, loaded.n_texts, loaded.floor) == (built.n_docs, built.n_texts, built.floor)
    assert sorted(map(tuple, loaded.postings.collect())) == sorted(map(tuple, built.postings.collect()))
    asked = spark.createDataFrame([(1, "word3 common"), (2, "number5")], "query_id int, query_text string")
    answers = [sorted(map(str, map(tuple, retrieval.ranked_docs(asked, x, k=4).collect()))) for x in (built, loaded)]
    assert answers[0] == answers[1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        terms = loaded.terms.select("term_key", F.lit(1.0).alias("qw"))
        plan = terms.join(loaded.postings, "term_key")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1, plan  # the terms' side only
    I.index_save(built, str(tmp_path / "index"), buckets=3)  # saved again in the same place
    assert I.index_load(spark, str(tmp_path / "index")).postings.count() == built.postings.count()


def test_language_is_the_same_for_a_joined_table(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.unionByName(spark.createDataFrame([(-1, None, None), (-2, "", None), (-3, "1234567890 1234567890", None), (0, "deux textes pour une clé", None)], docs.schema))
    profiles = language.language_profiles(docs.filter("lang IS NOT NULL"))
    sent = dict(map(tuple, language.detect_language(docs, profiles, "doc_id", "text").collect()))
    monkeypatch.setattr(language, "BROADCAST_GRAMS", 10)
    assert dict(map(tuple, language.detect_language(docs, profiles, "doc_id", "text").collect())) == sent
    assert len(sent) == docs.select("doc_id").distinct().count() and sent[-1] == sent[-2] == sent[-3] == "en"
    none = language.detect_language(docs, profiles.limit(0), "doc_id", "text")
    assert {r["language"] for r in none.collect()} == {"en"}
