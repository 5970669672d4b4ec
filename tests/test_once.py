"""Costly expressions are computed once."""

from pyspark.sql import functions as F

from replyscope.functions.text import word_ngrams
from replyscope.operators.language import language_profiles


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_array_of_grams_is_computed_once(spark):
    df = spark.createDataFrame([("a b c",), ("d",)], "text string").repartition(1)
    grams = df.select(word_ngrams(F.split("text", " "), 1, 2).alias("g"))
    assert _plan(grams).count("split(") == 1
    assert sorted(r["g"] for r in grams.collect()) == [["a", "b", "c", "a b", "b c"], ["d"]]


def test_trigrams_of_profiles_are_counted_once(spark):
    rows = [("some words of a text", "en"), ("quelques mots", "fr"), (None, "de")]
    profiles = language_profiles(spark.createDataFrame(rows, "text string, lang string"))
    assert "regexp_extract_all" not in _plan(profiles)
    assert {"en", "fr"} <= {r["lang"] for r in profiles.collect()}
