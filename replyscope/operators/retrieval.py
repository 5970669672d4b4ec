"""Hybrid top-k retrieval as joins over the index tables.

Score = alpha * minmax(BM25) + (1 - alpha) * TF-IDF cosine, where min and max
run over all documents. Unrolling every shared word would join nearly every
query with nearly every document, because of words like 'the'. So candidates come
from the terms found in at most hot_texts texts, and from the blocks of highest weight
of the others, as many as hold HEAD_SHARE of that. What the unread blocks can add is
bounded by the highest weight in the first of them. Candidates that can still be
among the best are completed from the unread blocks. The bound shows which
queries are thereby answered exactly. The others are tried again: their best k scores so
far tell how small the bound has to be, and the bounds of larger limits are computed from
the blocks' highest weights alone, so each query takes the smallest limit that proves it.
Where the queries are so few that the matrix of their terms fits a task, all their
postings are read at once instead, as products of matrices (tiles.py): from the start, or,
with a hot_texts below HOT_TEXTS, if more candidates than texts would have to be completed
or queries are left open. Many queries whose terms join them with most texts anyway are
compared with the texts in blocks (products.py).
Results are the same for every value of hot_texts."""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyscope.functions.text import strip_text, tokenize_word, tokenize_ws, word_ngrams
from replyscope.operators.index import NUMBERED_MEMBERS, WITNESSES, Index, witnesses
from replyscope.operators.ordering import dense_positions, top_per_group
from replyscope.operators.products import Products, meets_most_pairs
from replyscope.operators.tiles import Tiles, fits
from replyscope.session import cut_lineage, spread_by

HOT_TEXTS = 2_000
WIDEN = 16  # for queries without k scores yet
HEAD_SHARE = 0.25  # of hot_texts: postings of a frequent term that are read first
SALTS = 16
PLACES = 16  # bits of a document's place within a part that is counted in one go
BROADCAST_WITNESS = 1_000_000  # characters in all witness texts


@dataclasses.dataclass
class Scored:
    """Exact scores of the best texts per query, and statistics per query."""

    best: DataFrame  # q_key, text_key, b, bm25, dense, score
    stats: DataFrame  # q_key, low, high, and texts where postings were joined


def query_terms(queries: DataFrame, index: Index, ngram=(1, 2)) -> DataFrame:
    """(q_key, kind, term, term_key, qw, n_texts, levels) of distinct query texts."""
    tokens = queries.select(
        "q_key", tokenize_ws(F.col("q_text")).alias("_b"), tokenize_word(F.col("q_text")).alias("_c")
    )

    def tagged(kind, terms):
        return F.transform(terms, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term")))

    grams = F.concat(tagged("b", F.col("_b")), tagged("c", word_ngrams(F.col("_c"), *ngram)))
    counts = (
        spread_by(tokens, "q_key")
        .select("q_key", F.inline(grams))
        .groupBy("q_key", "kind", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    known = counts.join(index.terms, ["kind", "term"])
    raw = F.col("tf") * F.col("idf")
    is_c = F.col("kind") == "c"
    norm = F.sqrt(F.sum(F.when(is_c, raw * raw).otherwise(0.0)).over(Window.partitionBy("q_key")))
    qw = F.when(is_c, raw / norm).otherwise(raw)
    return known.select("q_key", "kind", "term", "term_key", qw.alias("qw"), "n_texts", "levels")


def _sums():
    product = F.col("qw") * F.col("weight")
    is_b = F.col("kind") == "b"
    return [
        F.sum(F.when(is_b, product).otherwise(0.0)).alias("b"),
        F.sum(F.when(~is_b, product).otherwise(0.0)).alias("dense"),
        F.count_if(is_b).alias("b_terms"),
    ]


def with_unread(terms: DataFrame, head_share: float = HEAD_SHARE) -> DataFrame:
    """Adds unread, the first block of a term that is left unread at the query's hot_texts
    (null: all are read), and rest, the highest weight in an unread block. Blocks come by
    falling weight."""
    hot_texts = F.col("hot_texts")
    limit = F.when(F.col("n_texts") <= hot_texts, F.col("n_texts")).otherwise((hot_texts * head_share).cast("long"))

    def state(n, unread, rest):
        return F.struct(n.cast("long").alias("n"), unread.cast("int").alias("unread"), rest.cast("double").alias("rest"))

    def step(read, block):
        fits = read["n"] + block["n"] <= limit
        open_ = read["unread"].isNull()
        return F.when(open_ & fits, state(read["n"] + block["n"], F.lit(None), F.lit(0.0))).when(
            open_, state(read["n"], block["level"], block["most"])
        ).otherwise(read)

    read = F.aggregate("levels", state(F.lit(0), F.lit(None), F.lit(0.0)), step)
    marked = terms.withColumn("_read", read)
    return marked.select(*terms.columns, F.col("_read.unread").alias("unread"), F.col("_read.rest").alias("rest"))


def _unread_bounds() -> list[Column]:
    """Terms with unread blocks, and what these add at most to the scores of a text."""
    hot = F.col("unread").isNotNull()
    most = F.col("qw") * F.col("rest")
    hot_c = hot & (F.col("kind") == "c")
    # A text's weights are a unit vector, so the root of squares is a bound as well.
    root = F.sqrt(F.sum(F.when(hot_c, F.col("qw") * F.col("qw")).otherwise(0.0)))
    return [
        F.count_if(hot).alias("n_hot"),
        F.sum(F.when(hot & (F.col("kind") == "b"), most).otherwise(0.0)).alias("hot_b"),
        F.least(root, F.sum(F.when(hot_c, most).otherwise(0.0))).alias("hot_c"),
    ]


def _read_sums(terms: DataFrame, index: Index, heads: bool) -> DataFrame:
    """Scores by the blocks read, for every text in one of them. Terms read whole are
    joined by term; the first blocks of the others by term and block, so that the rest of
    their postings meets no query."""
    fields = ("q_key", "text_key", "kind", "qw", "weight")
    met = terms.filter("unread IS NULL").drop("levels").join(index.postings, "term_key").select(*fields)
    if heads:
        read = F.filter("levels", lambda x: x["level"] < F.col("unread"))
        blocks = terms.select("q_key", "kind", "qw", "term_key", F.explode(read["level"]).alias("level"))
        met = met.unionByName(blocks.join(index.postings, ["term_key", "level"]).select(*fields))
    return met.groupBy("q_key", "text_key").agg(*_sums())


def _worth_completing(partial: DataFrame, queries: DataFrame, alpha: float, k: int) -> DataFrame:
    """Candidates that can be among the best k of their query, or have its
    highest BM25 score, when unread blocks add at most hot_b and hot_c."""
    peaks = queries.join(partial.groupBy("q_key").agg(F.max("b").alias("peak")), "q_key")
    share = F.when(F.col("peak") + F.col("hot_b") > 0, F.col("b") / (F.col("peak") + F.col("hot_b"))).otherwise(F.lit(0.0))
    at_least = partial.join(peaks, "q_key").select("q_key", "text_key", (alpha * share + (1 - alpha) * F.col("dense")).alias("least"))
    kth = top_per_group(at_least, ["q_key"], [F.desc("least")], k).groupBy("q_key").agg(
        F.min("least").alias("kth"), F.count(F.lit(1)).alias("found")
    )
    limits = peaks.join(kth, "q_key").select(
        "q_key", "hot_b", "hot_c", "peak", F.when(F.col("found") >= k, F.col("kth")).otherwise(F.lit(-1.0)).alias("kth")
    )
    most_b = F.when(F.col("peak") > 0, F.least((F.col("b") + F.col("hot_b")) / F.col("peak"), F.lit(1.0))).otherwise(F.lit(1.0))
    at_most = alpha * most_b + (1 - alpha) * F.least(F.col("dense") + F.col("hot_c"), F.lit(1.0))
    hopeful = (at_most >= F.col("kth") - 1e-8) | (F.col("b") + F.col("hot_b") >= F.col("peak") - 1e-8)
    return partial.join(limits, "q_key").filter(hopeful).select(*partial.columns)


def _completed(partial: DataFrame, terms: DataFrame, index: Index) -> DataFrame:
    """Adds the unread blocks. (term_key, text_key) is unique in the postings,
    so the join cannot explode."""
    hot = terms.filter("unread IS NOT NULL")
    rest = (
        partial.select("q_key", "text_key")
        .join(hot.select("q_key", "kind", "term_key", "qw", "unread"), "q_key")
        .join(index.postings, ["term_key", "text_key"])
        .filter(F.col("level") >= F.col("unread"))
        .groupBy("q_key", "text_key")
        .agg(*_sums())
    )
    both = partial.unionByName(rest)
    return both.groupBy("q_key", "text_key").agg(*[F.sum(c).alias(c) for c in ("b", "dense", "b_terms")])


def _stats(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("q_key").agg(
        F.min("b").alias("b_min"), F.max("b").alias("b_max"), F.count(F.lit(1)).alias("texts"),
        F.count_if(F.col("b_terms") > 0).alias("b_texts"),
    )


def _rank(candidates: DataFrame, limits: DataFrame, alpha: float, k: int, carried: tuple[str, ...]) -> DataFrame:
    """Best k texts per query, with columns of the query carried along. Scores are attached and cut per (query, salt), so
    that a query with very many candidates is not ranked by one task."""
    salt = F.pmod(F.xxhash64("text_key"), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    width = F.col("high") - F.col("low")
    scored = (
        candidates.withColumn("_salt", salt)
        .join(limits.select("q_key", "low", "high", *carried, salts), ["q_key", "_salt"])
        .withColumn("bm25", F.when(width > 0, (F.col("b") - F.col("low")) / width).otherwise(F.lit(0.0)))
        .withColumn("score", alpha * F.col("bm25") + (1 - alpha) * F.col("dense"))
    )
    order = [F.desc(F.round("score", 9)), F.col("text_key")]
    first = F.row_number().over(Window.partitionBy("q_key", "_salt").orderBy(*order))
    cut = scored.withColumn("_r", first).filter(F.col("_r") <= k)
    fields = ("q_key", "text_key", "b", "bm25", "dense", "score", "low", "high", *carried)
    return top_per_group(cut.select(*fields), ["q_key"], order, k).drop("rank")


def _complete_limits(stats: DataFrame, index: Index) -> DataFrame:
    """Lowest and highest BM25 score over all texts, when every text with a
    score is among the candidates. Texts without a shared term score 0."""
    all_matched = F.col("b_texts") >= index.n_texts
    return stats.withColumn("low", F.when(all_matched, F.col("b_min")).otherwise(F.least("b_min", F.lit(0.0)))).withColumn(
        "high", F.when(all_matched, F.col("b_max")).otherwise(F.greatest("b_max", F.lit(0.0)))
    )


def _unmatched_witness(terms: DataFrame, index: Index) -> DataFrame:
    """(q_key, met): how many witness texts share a BM25 term with the query."""
    shown = witnesses(index)
    size = index.texts.orderBy("length", "text_key").limit(WITNESSES).agg(F.sum(F.length("text"))).first()[0] or 0
    shown = F.broadcast(shown) if size <= BROADCAST_WITNESS else shown
    return (
        terms.filter("kind = 'b'").select("q_key", "term").join(shown, "term")
        .groupBy("q_key").agg(F.count_distinct("text_key").alias("met"))
    )


def best_texts(queries: DataFrame, index: Index, alpha: float, k: int, hot_texts: int = HOT_TEXTS) -> Scored:
    """Exact best k texts for distinct queries (q_key, q_text)."""
    terms = cut_lineage(_weighed_terms(queries, index, alpha).withColumn("hot_texts", F.lit(hot_texts).cast("long")))
    tiled = fits(terms)
    if tiled and hot_texts >= HOT_TEXTS:
        return _by_tiles(terms, index, alpha, k)
    if not tiled and hot_texts >= HOT_TEXTS and meets_most_pairs(terms, index):
        return _by_products(terms, index, alpha, k)
    answered = _answered(terms, index, alpha, k, index.n_texts if tiled else None)
    if answered is None:
        return _by_tiles(terms, index, alpha, k)
    found, goals = answered
    if hot_texts >= index.n_texts:
        return found
    while True:
        rest = terms.filter(F.col("hot_texts") < index.n_texts).join(found.stats.select("q_key"), "q_key", "left_anti")
        if rest.isEmpty():
            return found
        if fits(rest):
            more = _by_tiles(rest, index, alpha, k)
            return Scored(found.best.unionByName(more.best), found.stats.unionByName(more.stats))
        terms = cut_lineage(_wider(cut_lineage(rest), goals, index, alpha, hot_texts))
        more, goals = _answered(terms, index, alpha, k)
        found = Scored(found.best.unionByName(more.best), found.stats.unionByName(more.stats))


def _by_tiles(terms: DataFrame, index: Index, alpha: float, k: int) -> Scored:
    """Best texts and limits of few queries, with every posting of their terms read."""
    tiles = Tiles(terms, index)
    stats = cut_lineage(_complete_limits(tiles.limits(), index).select("q_key", "low", "high", "texts"))
    order = [F.desc(F.round("score", 9)), F.col("text_key")]
    best = top_per_group(tiles.best(stats, alpha, k), ["q_key"], order, k).drop("rank")
    return Scored(cut_lineage(best), stats)


def _by_products(terms: DataFrame, index: Index, alpha: float, k: int) -> Scored:
    """Best texts and limits of many queries, with every posting of their terms read."""
    products = Products(terms, index)
    stats = cut_lineage(products.limits(), "limits")
    order = [F.desc(F.round("score", 9)), F.col("text_key")]
    best = top_per_group(products.best(stats, alpha, k), ["q_key"], order, k).drop("rank")
    return Scored(cut_lineage(best), stats)


def _wider(terms: DataFrame, goals: DataFrame, index: Index, alpha: float, hot_texts: int) -> DataFrame:
    """The terms with the smallest limit (a power of two times the last one) whose unread
    blocks can neither lift another text to the query's goal nor exceed the highest BM25
    score found. Only the terms' blocks are looked at, no postings."""
    steps = max(1, math.ceil(math.log2((index.n_texts + 1) / max(hot_texts, 1))))
    factor = F.explode(F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda i: F.pow(F.lit(2.0), i).cast("long")))
    limits = terms.select("*", factor.alias("_factor")).withColumn("hot_texts", F.greatest(F.col("hot_texts"), F.lit(1)) * F.col("_factor"))
    bounds = with_unread(limits.join(goals, "q_key")).groupBy("q_key", "hot_texts", "goal", "best_b").agg(*_unread_bounds())
    share = F.when(F.col("best_b") > 0, F.col("hot_b") / F.col("best_b")).otherwise(F.lit(0.0))
    ceiling = alpha * share + (1 - alpha) * F.least(F.col("hot_c"), F.lit(1.0))
    proven = (F.col("n_hot") == 0) | ((F.col("best_b") >= F.col("hot_b")) & (F.col("goal") > ceiling + 2e-8))
    enough = bounds.filter(proven).groupBy("q_key").agg(F.min("hot_texts").alias("_limit"))
    wider = F.coalesce(F.col("_limit"), F.greatest(F.col("hot_texts"), F.lit(1)) * WIDEN)
    return terms.join(enough, "q_key", "left").withColumn("hot_texts", wider).drop("_limit")


def _goals(candidates: DataFrame, queries: DataFrame, alpha: float, k: int) -> DataFrame:
    """(q_key, best_b, goal): the highest BM25 score found, and a score that the k-th best
    text has at least, of queries with k candidates."""
    peaks = queries.join(candidates.groupBy("q_key").agg(F.max("b").alias("best_b")), "q_key")
    high = F.greatest("best_b", "hot_b")
    least = alpha * F.when(high > 0, F.col("b") / high).otherwise(F.lit(0.0)) + (1 - alpha) * F.col("dense")
    at_least = candidates.join(peaks, "q_key").select("q_key", "text_key", "best_b", least.alias("least"))
    return top_per_group(at_least, ["q_key"], [F.desc("least")], k).groupBy("q_key", "best_b").agg(
        F.min("least").alias("goal"), F.count(F.lit(1)).alias("found")
    ).filter(F.col("found") >= k).drop("found")


def _weighed_terms(queries: DataFrame, index: Index, alpha: float) -> DataFrame:
    terms = query_terms(queries, index)
    return terms.filter("kind = 'b'") if alpha >= 1 else terms.filter("kind = 'c'") if alpha <= 0 else terms


def _answered(terms: DataFrame, index: Index, alpha: float, k: int, most: int | None = None) -> tuple[Scored, DataFrame] | None:
    """The queries whose best k texts are proven with candidates from the blocks read
    at their hot_texts, and the goals of all with k candidates. Where every block is read,
    a query is proven. None if more than `most` candidates would have to be completed."""
    terms = with_unread(terms)
    reach = terms.groupBy("q_key").agg(
        *_unread_bounds(), F.sum(F.when(F.col("kind") == "b", F.col("n_texts")).otherwise(0)).alias("reach")
    )
    # With frequent terms left out, the lowest score is still known to be 0 if
    # some text is known to be unmatched.
    some_unmatched = (F.col("reach") < index.n_texts) | (
        F.coalesce(F.col("met"), F.lit(0)) < min(WITNESSES, index.n_texts)
    )
    queries = reach.join(_unmatched_witness(terms, index), "q_key", "left").filter(
        (F.col("n_hot") == 0) | (F.lit(not index.signed) & some_unmatched)
    )
    queries = queries.select("q_key", "n_hot", "hot_b", "hot_c")
    heads = not terms.filter("unread IS NOT NULL").isEmpty()
    partial = _read_sums(terms, index, heads)
    if not heads:
        candidates, known = partial, _complete_limits(_stats(partial), index).join(queries, "q_key")
    else:
        queries = cut_lineage(queries)
        partial = cut_lineage(partial)
        worth = cut_lineage(_worth_completing(partial, queries, alpha, k))
        if most is not None and worth.count() > most:
            return None
        candidates = cut_lineage(_completed(worth, terms, index))
        highest = candidates.groupBy("q_key").agg(F.max("b").alias("best_b"))
        rare_only = F.col("n_hot") == 0
        # No text in unread blocks only may exceed the highest score found.
        known = (
            _complete_limits(_stats(partial), index).join(queries, "q_key").join(highest, "q_key")
            .filter(rare_only | (F.col("best_b") >= F.col("hot_b")))
            .withColumn("low", F.when(rare_only, F.col("low")).otherwise(F.lit(0.0)))
            .withColumn("high", F.when(rare_only, F.col("high")).otherwise(F.greatest("best_b", F.lit(0.0))))
        )
    best = cut_lineage(_rank(candidates, known, alpha, k, ("texts", "n_hot", "hot_b", "hot_c")))
    share = F.when(F.col("high") > 0, F.col("hot_b") / F.col("high")).otherwise(F.lit(0.0))
    ceiling = alpha * share + (1 - alpha) * F.least(F.col("hot_c"), F.lit(1.0))
    columns = ["q_key", "low", "high", "texts"]
    answered = best.groupBy(*columns, "n_hot", ceiling.alias("ceiling")).agg(
        F.min("score").alias("kth"), F.count(F.lit(1)).alias("found")
    )
    stats = answered.filter(
        (F.col("n_hot") == 0) | ((F.col("found") >= k) & (F.col("kth") > F.col("ceiling") + 1e-8))
    ).select(*columns)
    fields = ["q_key", "text_key", "b", "bm25", "dense", "score"]
    stats = cut_lineage(stats)
    return Scored(best.select(*fields).join(stats.select("q_key"), "q_key", "left_semi"), stats), _goals(candidates, queries, alpha, k)


def _with_padding(docs: DataFrame, queries: DataFrame, scored: Scored, index: Index, alpha: float, k: int) -> DataFrame:
    """Documents without any shared term fill short result lists, first ids
    first. With negative weights they may also rank above shared ones."""
    counts = docs.groupBy("q_key").agg(F.count(F.lit(1)).alias("have"), F.min("score").alias("least"))
    short = queries.select("q_key").join(counts, "q_key", "left").join(scored.stats, "q_key", "left")
    width = F.col("high") - F.col("low")
    pad_bm25 = F.when(width > 0, (F.lit(0.0) - F.col("low")) / width).otherwise(F.lit(0.0))
    short = short.withColumn("bm25", pad_bm25).filter(
        F.col("have").isNull() | (F.col("have") < k) | (F.col("least") <= alpha * F.col("bm25"))
    )
    short = cut_lineage(short.select("q_key", "bm25"))
    if short.isEmpty():
        return docs
    pads = _unshared(short, queries, index, alpha, k)
    return docs.unionByName(
        pads.select("q_key", "text_key", "doc_id", F.lit(0.0).alias("b"), "bm25", F.lit(0.0).alias("dense"), (alpha * F.col("bm25")).alias("score"))
    )


def _unshared(short: DataFrame, queries: DataFrame, index: Index, alpha: float, k: int) -> DataFrame:
    """The first k documents without a shared term for every short query.

    Documents are numbered by id once. A shared document at place p that is the i-th
    shared one of its query has p - i free places before it (i from 0), so the j-th
    free place is j plus the number of shared documents with at most j free places
    before them. These are counted; places are never listed."""
    terms = _weighed_terms(queries.join(short, "q_key", "left_semi"), index, alpha)
    shared = terms.join(index.postings, "term_key").select("q_key", "text_key").distinct()
    order = [F.col("doc_id"), F.col("text_key")]
    numbered = cut_lineage(dense_positions(index.members.select("text_key", "doc_id"), order, "at"), "numbered")
    met = cut_lineage(shared.join(numbered, "text_key").select("q_key", "at", F.shiftright("at", PLACES).alias("part")), "met")
    parts = met.groupBy("q_key", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("q_key").orderBy("part")) - F.col("n")
    parts = cut_lineage(parts.select("q_key", "part", before.alias("before")), "parts")
    inside = F.row_number().over(Window.partitionBy("q_key", "part").orderBy("at")) - 1
    free = met.join(parts, ["q_key", "part"]).withColumn("free", F.col("at") - F.col("before") - inside).filter(F.col("free") < k)
    skipped = free.groupBy("q_key", "free").agg(F.count(F.lit(1)).alias("n")).groupBy("q_key").agg(F.collect_list(F.struct("free", "n")).alias("skipped"))
    asked = short.join(skipped, "q_key", "left").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    passed = F.aggregate(
        F.filter("skipped", lambda x: x["free"] <= F.col("j")), F.lit(0).cast("long"), lambda total, x: total + x["n"]
    )
    places = asked.select("q_key", "bm25", (F.col("j") + F.coalesce(passed, F.lit(0))).alias("at"))
    return places.join(numbered, "at").select("q_key", "bm25", "text_key", "doc_id")


def _first_members(index: Index, best: DataFrame, k: int) -> DataFrame:
    """(text_key, doc_id): the first k documents of the texts found."""
    if k <= NUMBERED_MEMBERS:
        return index.members.filter(F.col("pos") <= k).drop("pos")
    found = index.members.join(best.select("text_key").distinct(), "text_key", "left_semi").drop("pos")
    return top_per_group(found, ["text_key"], [F.col("doc_id")], k).drop("rank")


def keyed_queries(queries: DataFrame, text: str) -> DataFrame:
    """Adds q_text (stripped) and q_key, equal for equal texts."""
    stripped = strip_text(F.col(text))
    return queries.withColumn("q_text", stripped).withColumn("q_key", F.md5("q_text"))


def ranked_distinct(distinct: DataFrame, index: Index, alpha: float = 0.7, k: int = 3, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """(q_key, rank, doc_id, text, score, bm25, dense, b, low, high): the best k
    documents of distinct queries (q_key, q_text); an empty text has none. b is
    the BM25 score before scaling, low and high its limits over all documents."""
    named = distinct.filter(F.col("q_text") != "").select(F.col("q_key").alias("q_name"), "q_text")
    distinct = cut_lineage(named.withColumn("q_key", F.monotonically_increasing_id()))  # short keys
    scored = best_texts(distinct, index, alpha, k, hot_texts)
    docs = scored.best.join(_first_members(index, scored.best, k), "text_key")
    docs = docs.select("q_key", "text_key", "doc_id", "b", "bm25", "dense", "score")
    docs = _with_padding(docs, distinct, scored, index, alpha, k)
    order = [F.desc(F.round("score", 9)), F.col("doc_id"), F.col("text_key")]
    top = top_per_group(docs, ["q_key"], order, k)
    full = top.join(index.texts.select("text_key", "text"), "text_key").join(
        scored.stats.select("q_key", "low", "high"), "q_key", "left"
    )
    zero = F.lit(0.0)
    return full.join(distinct.select("q_key", "q_name"), "q_key").select(
        F.col("q_name").alias("q_key"), "rank", "doc_id", "text", "score", "bm25", "dense", "b",
        F.coalesce("low", zero).alias("low"), F.coalesce("high", zero).alias("high"),
    )


def distinct_queries(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("q_key").agg(F.first("q_text").alias("q_text"))


def ranked_docs(
    queries: DataFrame, index: Index, alpha: float = 0.7, k: int = 3, query_id: str = "query_id", text: str = "query_text",
    hot_texts: int = HOT_TEXTS,
) -> DataFrame:
    """As ranked_distinct, for queries with an id: repeated texts are scored once."""
    keyed = keyed_queries(queries.select(query_id, text), text)
    ranked = ranked_distinct(distinct_queries(keyed), index, alpha, k, hot_texts)
    return keyed.select(query_id, "q_key").join(ranked, "q_key").drop("q_key")


def bm25_scores(queries: DataFrame, index: Index, k: int, query_id: str = "query_id", text: str = "query_text") -> DataFrame:
    """(query_id, rank, doc_id, bm25_raw, bm25, low, high): the best k documents by
    BM25 alone; bm25 is scaled by the limits low and high over all documents. Documents
    that share no term score 0 and fill short lists."""
    ranked = ranked_docs(queries, index, 1.0, k, query_id, text)
    return ranked.select(query_id, "rank", "doc_id", F.col("b").alias("bm25_raw"), "bm25", "low", "high")


def tfidf_cosine(queries: DataFrame, index: Index, k: int, query_id: str = "query_id", text: str = "query_text") -> DataFrame:
    """(query_id, rank, doc_id, cosine): the best k documents by TF-IDF cosine alone."""
    ranked = ranked_docs(queries, index, 0.0, k, query_id, text)
    return ranked.select(query_id, "rank", "doc_id", F.col("dense").alias("cosine"))


def collect_hits(ranked: DataFrame, query_id: str = "query_id", with_ce: bool = False) -> DataFrame:
    """(query_id, retrieved): the ranked hits as one array in rank order."""
    ce = F.col("ce") if with_ce else F.lit(None).cast("double")
    hit = F.struct("rank", "doc_id", "text", "score", "bm25", "dense", ce.alias("ce"))
    ordered = F.array_sort(F.collect_list(hit))
    fields = ("doc_id", "text", "score", "bm25", "dense", "ce")
    return ranked.groupBy(query_id).agg(
        F.transform(ordered, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("retrieved")
    )


def attach_hits(keyed: DataFrame, index: Index, alpha: float = 0.7, k: int = 3, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """Adds retrieved to rows that have q_key and q_text (see keyed_queries)."""
    hits = collect_hits(ranked_distinct(distinct_queries(keyed), index, alpha, k, hot_texts), "q_key")
    empty = F.array().cast(hits.schema["retrieved"].dataType)
    return keyed.join(hits, "q_key", "left").withColumn("retrieved", F.coalesce("retrieved", empty)).drop("q_key", "q_text")


def hybrid_topk(
    queries: DataFrame, index: Index, alpha: float = 0.7, k: int = 3, query_id: str = "query_id", text: str = "query_text",
    hot_texts: int = HOT_TEXTS,
) -> DataFrame:
    """(query_id, retrieved) for every query; an empty query has an empty list."""
    keyed = keyed_queries(queries.select(query_id, text), text)
    return attach_hits(keyed, index, alpha, k, hot_texts).select(query_id, "retrieved")


def minmax_per_query(scores: DataFrame, query: str, score: str, out: str) -> DataFrame:
    """Scores scaled to 0..1 within their query; constant scores become 0."""
    limits = scores.groupBy(query).agg(F.min(score).alias("_low"), F.max(score).alias("_high"))
    width = F.col("_high") - F.col("_low")
    scaled = F.when(width > 0, (F.col(score) - F.col("_low")) / width).otherwise(F.lit(0.0))
    return scores.join(limits, query).withColumn(out, scaled).drop("_low", "_high")


def rerank_fuse(pool: DataFrame, k: int = 3, query: str = "query_id", ce: str = "ce") -> DataFrame:
    """Half hybrid score, half scaled cross-encoder score, best k per query.
    Every hit carries its own fused score. The pool holds a few rows per query."""
    fused = minmax_per_query(pool, query, ce, "ce_scaled").withColumn(
        "score", 0.5 * F.col("score") + 0.5 * F.col("ce_scaled")
    )
    return top_per_group(fused.drop("rank"), [query], [F.desc(F.round("score", 9)), F.col("doc_id")], k)


def topk_per_query(scored: DataFrame, k: int, query: str = "query_id", score: str = "score", doc: str = "doc_id") -> DataFrame:
    return top_per_group(scored, [query], [F.desc(F.round(score, 9)), F.col(doc)], k)


def rrf_fuse(ranked_a: DataFrame, ranked_b: DataFrame, k: int = 60, query: str = "query_id", doc: str = "doc_id") -> DataFrame:
    """Reciprocal rank fusion of two ranked lists (query, doc, rank)."""
    both = ranked_a.select(query, doc, "rank").unionByName(ranked_b.select(query, doc, "rank"))
    return both.groupBy(query, doc).agg(F.sum(1.0 / (F.lit(k) + F.col("rank"))).alias("rrf"))
