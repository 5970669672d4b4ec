"""Retrieval index as tables.

Documents with the same text score the same for every query, and support
replies repeat a lot, so the index is built over distinct texts. Statistics
(N, df, average length) still count every document.

  texts     text_key, digest, text, copies, length
  members   text_key, doc_id, pos      every id of every text; pos numbers the
                                       first ones and is null behind them
  postings  term_key, text_key, weight, level
  terms     term_key, kind, term, df, n_texts, idf, max_weight, levels

The postings of a term are in blocks by weight: level 0 holds the highest weights, each
next level those lower by a quarter octave, the last one the rest. levels has the number
of postings and the highest weight of every block, so a search reads the first blocks of a
frequent term and knows what the others can add at most.

kind 'b' holds BM25 terms (whitespace tokens; weight is the length-normalised
term frequency), kind 'c' the TF-IDF n-grams (weight is the unit vector)."""

from __future__ import annotations

import dataclasses
import hashlib
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.constants import STOCK_REPLIES, STOP_WORDS
from replyscope.functions.text import tokenize_ws
from replyscope.operators.counts import gram_sums, unit_postings, with_length, word_lists
from replyscope.operators.ordering import top_per_group
from replyscope.session import cut_lineage

K1, B, EPSILON = 1.5, 0.75, 0.25
NUMBERED_MEMBERS = 100  # ids of a text that have a position
WITNESSES = 64
LEVELS = 16  # blocks of a term's postings
PER_OCTAVE = 4  # blocks in which the weight halves
TABLES = ("texts", "members", "postings", "terms", "stats")


def weight_level(weight: Column, most: float) -> Column:
    """Block of a posting: how far its weight is below `most`, in fractions of octaves."""
    below = F.floor(F.lit(float(PER_OCTAVE)) * F.log2(F.lit(most) / weight)).cast("int")
    return F.greatest(F.lit(0), F.least(F.lit(LEVELS - 1), below))


@dataclasses.dataclass
class Index:
    texts: DataFrame
    members: DataFrame
    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    # Plain numbers of the one-row stats table.
    n_docs: int
    n_texts: int
    average_length: float
    floor: float

    @property
    def signed(self) -> bool:
        """True if BM25 weights can be negative (only in tiny corpora)."""
        return self.floor < 0


def index_build(
    docs: DataFrame, max_features: int = 10_000, ngram: tuple[int, int] = (1, 2), stop_words=STOP_WORDS
) -> Index:
    """Index over documents (doc_id, text) with non-blank text."""
    keyed = docs.select(F.md5("text").alias("digest"), "text", F.col("doc_id").cast("string").alias("doc_id"))
    # Keys are short and ascend with the first document id of a text, which is
    # the order of equal scores.
    texts = (
        keyed.groupBy("digest")
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"))
        .orderBy("first_id", "digest")
        .select(F.monotonically_increasing_id().alias("text_key"), "digest", "text", "copies")
    )
    texts = cut_lineage(with_length(texts))
    # Only the head of a group is sorted; the other ids of a repeated text need no order.
    every = cut_lineage(keyed.select("digest", "doc_id").join(texts.select("digest", "text_key"), "digest").select("text_key", "doc_id"))
    head = top_per_group(every, ["text_key"], [F.col("doc_id")], NUMBERED_MEMBERS, "pos")
    last = head.groupBy("text_key").agg(F.max("pos").alias("n"), F.max("doc_id").alias("last")).filter(F.col("n") >= NUMBERED_MEMBERS)
    behind = every.join(cut_lineage(last), "text_key").filter(F.col("doc_id") > F.col("last"))
    members = head.unionByName(behind.select("text_key", "doc_id", F.lit(None).cast("int").alias("pos")))

    n_docs, n_texts, words = texts.agg(
        F.sum("copies"), F.count(F.lit(1)), F.sum(F.col("copies") * F.col("length"))
    ).first()
    n_docs, n_texts = n_docs or 0, n_texts or 0
    average_length = words / n_docs if n_docs else 0.0

    saturation = K1 * (1 - B + B * F.col("length") / F.lit(average_length or 1.0))
    bm25_weight = F.col("tf") * (K1 + 1) / (F.col("tf") + saturation)
    # Words are counted once: their texts are listed by word and slice, and numbered when
    # the vocabulary is known. All n-grams are counted, but only kept ones are listed.
    lists = cut_lineage(word_lists(texts), "lists")
    spread = lists.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n_texts").alias("n_texts"))
    spread = cut_lineage(spread.select(F.lit("b").alias("kind"), "term", "df", "n_texts"))
    raw_idf = F.log(F.lit(n_docs) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    b_terms = spread.withColumn("raw_idf", raw_idf)
    mean_idf = b_terms.agg(F.avg("raw_idf")).first()[0] or 0.0
    floor = EPSILON * mean_idf
    idf = F.when(F.col("raw_idf") < 0, F.lit(floor)).otherwise(F.col("raw_idf"))
    b_terms = b_terms.select("kind", "term", "df", "n_texts", idf.alias("idf"))
    c_terms = (
        gram_sums(texts, stop_words, *ngram).groupBy("term")
        .agg(*[F.sum(c).alias(c) for c in ("df", "n_texts", "cf")])
        .orderBy(F.desc("cf"), "term")
        .limit(max_features)
        .withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1)
        .select(F.lit("c").alias("kind"), "term", "df", "n_texts", "idf")
    )
    # Kept terms are numbered: keys are short and never collide.
    terms = cut_lineage(b_terms.unionByName(c_terms).select(F.monotonically_increasing_id().alias("term_key"), "*"))
    b_keys = terms.filter("kind = 'b'").select("term", "term_key")
    b_level = weight_level(bm25_weight, K1 + 1)  # no weight is higher
    b_held = lists.select("term", "held").join(b_keys, "term").select("term_key", F.inline("held"))
    b_postings = b_held.select("term_key", "text_key", bm25_weight.alias("weight"), b_level.alias("level"))
    c_postings = unit_postings(texts, terms.filter("kind = 'c'"), stop_words, *ngram)
    c_postings = c_postings.withColumn("level", weight_level(F.col("weight"), 1.0))
    stats = docs.sparkSession.range(1).select(
        F.lit(n_docs).alias("n_docs"),
        F.lit(n_texts).alias("n_texts"),
        F.lit(float(average_length)).alias("average_length"),
        F.lit(float(floor)).alias("floor"),
    )
    postings = cut_lineage(b_postings.unionByName(c_postings))
    # One shuffle by term: every block is a pair of columns until the sums are complete.
    in_level = [F.when(F.col("level") == i, F.col("weight")) for i in range(LEVELS)]
    sums = [agg(c).alias(f"{name}{i}") for i, c in enumerate(in_level) for name, agg in (("n", F.count), ("most", F.max))]
    blocks = postings.groupBy("term_key").agg(F.max("weight").alias("most"), *sums)
    block = [F.struct(F.lit(i).alias("level"), F.col(f"n{i}").alias("n"), F.col(f"most{i}").alias("most")) for i in range(LEVELS)]
    levels = F.filter(F.array(*block), lambda x: x["n"] > 0).alias("levels")
    highest = F.when(F.col("kind") == "b", F.col("most")).otherwise(F.lit(1.0))
    terms = terms.join(blocks.select("term_key", "most", levels), "term_key")
    terms = cut_lineage(terms.select("term_key", "kind", "term", "df", "n_texts", "idf", highest.alias("max_weight"), "levels"))
    return Index(
        texts, members, postings, terms, stats,
        n_docs, n_texts, float(average_length), float(floor),
    )


def index_save(index: Index, path: str, buckets: int | None = None) -> None:
    """One parquet folder per table. Postings are cut into buckets by term (as many
    as there are shuffle partitions, by default) and sorted by term and text inside, so
    that a join by term reads them where they are, and row groups are skipped."""
    spark = index.postings.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = os.path.join(path, "postings")
    name = _table_name(folder)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = index.postings.repartition(buckets, "term_key").write.mode("overwrite").option("path", folder)
    dealt.bucketBy(buckets, "term_key").sortBy("term_key", "text_key").saveAsTable(name)
    for table in ("texts", "members", "terms"):
        getattr(index, table).write.mode("overwrite").parquet(os.path.join(path, table))
    index.stats.withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(os.path.join(path, "stats"))


def _table_name(folder: str) -> str:
    """The session's name for the postings in a folder."""
    return f"postings_{hashlib.md5(folder.encode()).hexdigest()}"


def index_load(spark: SparkSession, path: str) -> Index:
    """The index saved at `path`, by this session or another one."""
    tables = {name: spark.read.parquet(os.path.join(path, name)) for name in TABLES if name != "postings"}
    stats = tables["stats"].first().asDict()
    buckets = stats.pop("buckets")
    folder = os.path.join(path, "postings")
    name = _table_name(folder)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (term_key BIGINT, text_key BIGINT, weight DOUBLE, level INT) USING parquet "
        f"CLUSTERED BY (term_key) SORTED BY (term_key, text_key) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    tables["stats"] = tables["stats"].drop("buckets")
    return Index(**tables, postings=spark.table(name), **stats)


def fallback_corpus(spark: SparkSession) -> Index:
    """Index over the stock replies, for use while no index exists."""
    return index_build(spark.createDataFrame(list(STOCK_REPLIES), "doc_id string, text string"))


def witnesses(index: Index) -> DataFrame:
    """Distinct BM25 terms of the shortest texts. A query that shares no term
    with one of them is known to have an unmatched text."""
    short = index.texts.orderBy("length", "text_key").limit(WITNESSES)
    return short.select("text_key", F.explode(F.array_distinct(tokenize_ws(F.col("text")))).alias("term"))
