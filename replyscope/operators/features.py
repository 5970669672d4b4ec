"""TF-IDF features in long form (id, term, tf, weight)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.constants import STOP_WORDS
from replyscope.functions.text import tokenize_word, word_ngrams
from replyscope.operators.frequent import frequent_grams, gram_rows
from replyscope.session import spread_by

BROADCAST_TERMS = 100_000  # vocabularies up to this size are broadcast


def term_counts(docs: DataFrame, key: str, text: str, ngram: tuple[int, int], stop_words=STOP_WORDS) -> DataFrame:
    """(key, copies, term, tf). Rows are placed by key before the tokens are
    unrolled, so counting needs no second shuffle."""
    copies = F.col("copies") if "copies" in docs.columns else F.lit(1).cast("long")
    tokens = docs.select(F.col(key), copies.alias("copies"), tokenize_word(F.col(text), stop_words).alias("_tokens"))
    return (
        spread_by(tokens, key)
        .select(key, "copies", F.explode(word_ngrams(F.col("_tokens"), *ngram)).alias("term"))
        .groupBy(key, "copies", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def vocabulary(counts: DataFrame, max_features: int | None) -> DataFrame:
    """(term, df, cf): the terms with the highest corpus count, ties by term."""
    terms = counts.groupBy("term").agg(F.sum("copies").alias("df"), F.sum(F.col("tf") * F.col("copies")).alias("cf"))
    return terms if max_features is None else terms.orderBy(F.desc("cf"), "term").limit(max_features)


def term_vocab(
    docs: DataFrame, text: str, max_features: int | None, ngram=(1, 1), stop_words=STOP_WORDS, one_pass: bool = False
) -> DataFrame:
    """Vocabulary of a corpus: (term, df, cf). With a limit, rare terms are ruled out
    in a first pass, so that few are shuffled one by one. `one_pass` counts all terms:
    less reading, more shuffle, the same rows; for texts that are few or costly to read."""
    if max_features is not None and not one_pass:
        return frequent_grams(docs, text, max_features, ngram, stop_words).select("term", "df", "cf")
    terms = gram_rows(docs, text, ngram, stop_words).groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return terms if max_features is None else terms.orderBy(F.desc("cf"), "term").limit(max_features)


def with_idf(vocab: DataFrame, n_docs: int) -> DataFrame:
    """Smoothed inverse document frequency ln((1+N)/(1+df)) + 1."""
    return vocab.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1)


def hint_vocab(vocab: DataFrame, max_features: int | None) -> DataFrame:
    """Broadcast hint for a vocabulary of proven size."""
    return F.broadcast(vocab) if max_features is not None and max_features <= BROADCAST_TERMS else vocab


def unit_weights(counts: DataFrame, vocab_idf: DataFrame, key: str) -> DataFrame:
    """Adds weight = tf * idf, scaled to length 1 per key."""
    weighted = counts.join(vocab_idf.select("term", "df", "idf"), "term").withColumn("weight", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key)))
    return weighted.withColumn("weight", F.col("weight") / norm)


def tfidf_vectors(
    docs: DataFrame,
    key: str,
    text: str,
    max_features: int | None,
    ngram: tuple[int, int] = (1, 1),
    stop_words=STOP_WORDS,
) -> DataFrame:
    """(key, term, tf, weight) over the corpus' own vocabulary."""
    counts = term_counts(docs, key, text, ngram, stop_words)
    n_docs = docs.count()
    vocab = with_idf(vocabulary(counts, max_features), n_docs)
    return unit_weights(counts, hint_vocab(vocab, max_features), key).select(key, "term", "tf", "weight")
