"""Scores of few queries for all texts, by products of small matrices.

Frequent words join nearly every query with nearly every text. Rows of such a join cost
far more than the products they stand for, so the postings of the queries' terms are
packed by text, and a task multiplies a tile of texts with the matrix of all queries. It
keeps the best k texts per query; only these and one row of limits leave it. Every
posting is read, so the scores are exact whatever the weights."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.operators.index import Index
from replyscope.session import cut_lineage

MOST_QUERIES = 4_096
MOST_CELLS = 1 << 23  # terms times queries of the matrix that is sent to every task
TILE = 256  # texts whose scores a task holds at a time
LIMITS = ("b_min", "b_max", "texts", "b_texts")


class Tiles:
    """The queries' terms as a matrix, and the postings of these terms by text."""

    def __init__(self, terms: DataFrame, index: Index):
        # at most as many rows as the matrix has cells
        rows = terms.select("q_key", "kind", "term_key", "qw").orderBy("kind", "term_key", "q_key").collect()
        self.queries = np.array(sorted({r["q_key"] for r in rows}), np.int64)
        keys = list(dict.fromkeys(r["term_key"] for r in rows))
        at, column = {key: i for i, key in enumerate(keys)}, {key: i for i, key in enumerate(self.queries.tolist())}
        self.values = np.zeros((len(keys), len(self.queries)))
        self.shared = np.zeros(self.values.shape, np.float32)
        for r in rows:
            self.values[at[r["term_key"]], column[r["q_key"]]] += r["qw"]
            self.shared[at[r["term_key"]], column[r["q_key"]]] = 1
        self.split = len({r["term_key"] for r in rows if r["kind"] == "b"})  # BM25 terms come first
        spark = index.postings.sparkSession
        places = spark.createDataFrame(list(at.items()), "term_key long, at int")
        met = index.postings.join(F.broadcast(places), "term_key").select("text_key", F.struct("at", "weight").alias("e"))
        packed = met.groupBy("text_key").agg(F.collect_list("e").alias("e"))
        self.texts = cut_lineage(packed.select("text_key", F.col("e.at").alias("at"), F.col("e.weight").alias("weight")), "packed")

    def _scores(self):
        """A function from a batch of packed texts to (text_key, b, dense, shares a BM25
        term, shares any term) of its tiles, texts by queries."""
        shared = self.texts.sparkSession.sparkContext.broadcast((self.values, self.shared, self.split))

        def scores(batch: pa.RecordBatch):
            values, shares, split = shared.value
            keys = batch.column("text_key").to_numpy()
            order = np.argsort(keys, kind="stable")
            batch = batch.take(pa.array(order))
            for low in range(0, batch.num_rows, TILE):
                part = batch.slice(low, TILE)
                at, weight = part.column("at"), part.column("weight")
                row = np.repeat(np.arange(part.num_rows), at.value_lengths().to_numpy())
                tile = np.zeros((part.num_rows, len(values)))
                tile[row, at.flatten().to_numpy()] = weight.flatten().to_numpy()
                has = np.zeros(tile.shape, np.float32)
                has[row, at.flatten().to_numpy()] = 1
                by_b = has[:, :split] @ shares[:split] > 0
                any_ = by_b | (has[:, split:] @ shares[split:] > 0)
                yield part.column("text_key").to_numpy(), tile[:, :split] @ values[:split], tile[:, split:] @ values[split:], by_b, any_

        return scores

    def limits(self) -> DataFrame:
        """(q_key, b_min, b_max, texts, b_texts) over the texts that share a term."""
        scores, names = self._scores(), self.queries

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = np.full(len(names), np.inf), np.full(len(names), -np.inf)
            texts, b_texts = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
            for batch in batches:
                for _, b, _, by_b, any_ in scores(batch):
                    low = np.minimum(low, np.where(any_, b, np.inf).min(axis=0))
                    high = np.maximum(high, np.where(any_, b, -np.inf).max(axis=0))
                    texts, b_texts = texts + any_.sum(axis=0), b_texts + by_b.sum(axis=0)
            some = texts > 0
            columns = [names, low, high, texts, b_texts]
            yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in columns], ["q_key", *LIMITS])

        each = self.texts.mapInArrow(run, "q_key long, b_min double, b_max double, texts long, b_texts long")
        sums = [F.min("b_min").alias("b_min"), F.max("b_max").alias("b_max"), F.sum("texts").alias("texts"), F.sum("b_texts").alias("b_texts")]
        return each.groupBy("q_key").agg(*sums)

    def best(self, limits: DataFrame, alpha: float, k: int) -> DataFrame:
        """(q_key, text_key, b, bm25, dense, score): at least the best k texts of every
        query, given (q_key, low, high)."""
        scores, names = self._scores(), self.queries
        known = {r["q_key"]: (r["low"], r["high"]) for r in limits.select("q_key", "low", "high").collect()}  # a row per query
        low = np.array([known.get(q, (0.0, 0.0))[0] for q in names.tolist()])
        width = np.array([known.get(q, (0.0, 0.0))[1] for q in names.tolist()]) - low

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros((6, 0))  # query, b, bm25, dense, score and its rounded value
            texts = np.zeros(0, np.int64)
            for batch in batches:
                for keys, b, dense, _, any_ in scores(batch):
                    bm25 = np.where(width > 0, (b - low) / np.where(width > 0, width, 1.0), 0.0)
                    score = alpha * bm25 + (1 - alpha) * dense
                    rounded = np.where(any_, np.round(score, 9), -np.inf)
                    row = np.argsort(-rounded, axis=0, kind="stable")[:k].ravel()
                    col = np.tile(np.arange(len(names)), min(k, len(keys)))
                    taken = any_[row, col]
                    row, col = row[taken], col[taken]
                    new = np.stack([col, *[x[row, col] for x in (b, bm25, dense, score, rounded)]])
                    found, texts = np.concatenate([found, new], axis=1), np.concatenate([texts, keys[row]])
                    order = np.lexsort((texts, -found[5], found[0]))
                    rank = np.arange(len(order)) - np.searchsorted(found[0][order], found[0][order])
                    order = order[rank < k]
                    found, texts = found[:, order], texts[order]
            columns = [names[found[0].astype(np.int64)], texts, *found[1:5]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q_key", "text_key", "b", "bm25", "dense", "score"])

        return self.texts.mapInArrow(run, "q_key long, text_key long, b double, bm25 double, dense double, score double")


def fits(terms: DataFrame) -> bool:
    """True if the terms' matrix is small enough to be sent to every task."""
    queries, keys = terms.agg(F.count_distinct("q_key"), F.count_distinct("term_key")).first()
    return queries <= MOST_QUERIES and queries * keys <= MOST_CELLS
