"""Words and grams counted in Arrow batches, against Spark's own tokens."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from replyscope.functions.text import tokenize_word, tokenize_ws, word_ngrams
from replyscope.operators import counts
from replyscope.operators.index import index_build

TEXTS = [
    "One two  TWO\tone the the one", "", " ", None, "a bb ccc,ddd-eee_f 1 22", "Ünïcode straße ΣΑΣ İstanbul x yy　zz\x85q",
    "no​break ﻿mark  ogham\x1cunit\x0bline", "\U0001f600 smile \U00031350new ࡰold 日本語 テキスト", "the", "one two one two", "\n\nlast words\n",
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, i % 3 + 1) for i, t in enumerate(TEXTS)]
    return counts.with_length(spark.createDataFrame(rows, "text_key long, text string, copies long"))


def _expected(texts, words, low, high):
    rows = texts.select("text_key", "copies", word_ngrams(words, low, high).alias("grams")).collect()
    return {(r["text_key"], g): (n, r["copies"]) for r in rows for g, n in Counter(r["grams"]).items()}


@pytest.mark.parametrize("size", [1, 40, 1 << 23])
def test_counts_are_those_of_the_tokens(spark, texts, size, monkeypatch):
    monkeypatch.setattr(counts, "SLICE", size)
    assert all(r["length"] == r["n"] for r in texts.select("length", F.size(tokenize_ws(F.col("text"))).alias("n")).collect())
    held = counts.word_lists(texts).select("term", F.inline("held")).collect()
    assert {(r["text_key"], r["term"]): r["tf"] for r in held} == {k: n for k, (n, _) in _expected(texts, tokenize_ws(F.col("text")), 1, 1).items()}
    for stop_words, low, high in ((["the", "two"], 1, 2), (None, 2, 3), (["one"], 1, 1)):
        expected = _expected(texts, tokenize_word(F.col("text"), stop_words), low, high)
        sums = counts.gram_sums(texts, stop_words, low, high).groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", "n_texts", "cf")])
        wanted = {g: (0, 0, 0) for _, g in expected}
        for (_, g), (n, copies) in expected.items():
            wanted[g] = tuple(a + b for a, b in zip(wanted[g], (copies, 1, n * copies)))
        assert {r["term"]: (r["df"], r["n_texts"], r["cf"]) for r in sums.collect()} == wanted
        kept = sorted(wanted)[::2]
        vocabulary = spark.createDataFrame([(g, i, 1.0 + i) for i, g in enumerate(kept)], "term string, term_key long, idf double")
        found = counts.unit_postings(texts, vocabulary, stop_words, low, high).collect()
        raw = {(key, kept.index(g)): n * (1.0 + kept.index(g)) for (key, g), (n, _) in expected.items() if g in kept}
        length = {key: sum(x * x for (k, _), x in raw.items() if k == key) ** 0.5 for key, _ in raw}
        assert {(r["text_key"], r["term_key"]): round(r["weight"], 12) for r in found} == {at: round(x / length[at[0]], 12) for at, x in raw.items()}


def test_every_character_is_cut_as_spark_does(spark):
    known = spark.range(0, 0x110000, 1, 8).filter("id > 0 and (id < 55296 or id >= 57344)")
    mark = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    texts = known.select(F.concat(F.lit("ab"), mark, F.lit("cd")).alias("text"), F.col("id").alias("text_key"), F.lit(1).cast("long").alias("copies"))
    texts = texts.withColumn("length", F.lit(1).cast("long"))
    mine = counts.gram_sums(texts, []).groupBy("term").agg(F.sum("cf").alias("n"))
    spark_words = texts.select(F.explode(tokenize_word(F.col("text"), [])).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    assert mine.exceptAll(spark_words).isEmpty() and spark_words.exceptAll(mine).isEmpty()
    pieces = counts.word_lists(texts).select("term", F.size("held").cast("long").alias("n")).groupBy("term").agg(F.sum("n").alias("n"))
    tokens = texts.select("text_key", F.explode(F.array_distinct(tokenize_ws(F.col("text")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    assert pieces.exceptAll(tokens).isEmpty() and tokens.exceptAll(pieces).isEmpty()


def test_index_shuffles_no_row_per_word(spark, monkeypatch):
    """A word that a text repeats is one row before the first shuffle."""
    sent = []
    for name in ("gram_sums", "word_lists"):
        run = getattr(counts, name)
        monkeypatch.setattr(f"replyscope.operators.index.{name}", lambda *a, run=run: sent.append(run(*a)) or sent[-1])
    built = index_build(spark.createDataFrame([("a", "alpha beta " * 5000), ("b", "alpha")], "doc_id string, text string"))
    assert [df.count() <= 8 for df in sent] == [True, True]
    assert {(r["kind"], r["term"]): (r["df"], r["n_texts"]) for r in built.terms.collect()} == {
        ("b", "alpha"): (2, 2), ("b", "beta"): (1, 1), ("c", "alpha"): (2, 2), ("c", "beta"): (1, 1), ("c", "alpha beta"): (1, 1), ("c", "beta alpha"): (1, 1)
    }
    assert all(sum(x["n"] for x in r["levels"]) == r["n_texts"] and max(x["most"] for x in r["levels"]) > 0 for r in built.terms.collect())
