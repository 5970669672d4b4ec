"""Scores of many queries for all texts, by products of sparse blocks.

Where queries and texts share frequent words, a join by term makes several rows for nearly
every pair. Here queries and texts are dealt into blocks, and a task multiplies a block of
queries with a block of texts: terms that many of both sides hold are columns of dense matrices, all
others are multiplied by their postings inside the block. It keeps the best k texts per
query; only these and one row of limits leave it. Every shared term is counted, so the
scores are exact whatever the weights. Work grows with the number of pairs, a task's
memory does not."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.operators.index import Index
from replyscope.session import cut_lineage

BLOCK = 16_384  # queries or texts of a block
SIDES = 6  # blocks of a side, as long as they are no larger than BLOCK
LEAST = 256  # rows of a block, below that there are fewer blocks
TILE = 1_024  # queries and texts whose scores a task holds at a time
DENSE = 1 / 300  # share of the pairs from which on a shared term is a column
MOST_COLUMNS = 2_048
EXPANDED = 1 << 21  # products over the other terms that a task holds at a time
SHARED = 0.25  # terms that a pair shares on average from which on blocks are faster
PLACE = 1e-9  # scores are rounded to nine places


def meets_most_pairs(terms: DataFrame, index: Index) -> bool:
    """True if a join of the queries' terms with the postings makes about a row per pair."""
    queries, rows = terms.agg(F.count_distinct("q_key"), F.sum(F.col("n_texts").cast("double"))).first()
    return (rows or 0.0) >= SHARED * queries * index.n_texts


class Products:
    """The queries' terms by query, and the postings of these terms by text."""

    def __init__(self, terms: DataFrame, index: Index):
        is_b = F.col("kind") == "b"
        used = cut_lineage(terms.select("term_key", is_b.alias("is_b")).distinct(), "used")
        self.queries = cut_lineage(_packed(terms.select("q_key", "term_key", is_b.alias("is_b"), F.col("qw").alias("weight")), "q_key"), "queries")
        self.texts = cut_lineage(_packed(index.postings.join(used, "term_key"), "text_key"), "packed")
        self.n_queries, self.n_texts, self.index = self.queries.count(), self.texts.count(), index
        self.weightless = not terms.filter("qw <= 0").isEmpty()

    def _dealt(self, queries: DataFrame, texts: DataFrame, compute, schema: str) -> DataFrame:
        """compute of every block of queries with every block of texts. Partitions of the
        two tables are paired without a shuffle; tasks read their blocks again."""
        kinds = {"long": pa.int64(), "double": pa.float64()}
        fields = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for pair in zip(batch.column("queries"), batch.column("texts")):
                    found = compute(*(pa.ipc.open_stream(block.as_buffer()).read_pandas() for block in pair))
                    yield pa.RecordBatch.from_pandas(found, fields, preserve_index=False)

        left, right = _blocks(queries, "q_key", self.n_queries, "queries"), _blocks(texts, "text_key", self.n_texts, "texts")
        return left.hint("shuffle_replicate_nl").crossJoin(right).mapInArrow(run, schema)

    def limits(self) -> DataFrame:
        """(q_key, low, high): lowest and highest BM25 score over all texts; texts without
        a shared term score 0."""
        names = self.queries.select("q_key")
        texts = self.texts.filter(F.size("b_terms") > 0).select("text_key", "b_terms", "b_weights")
        queries = self.queries.filter(F.size("b_terms") > 0).select("q_key", "b_terms", "b_weights")
        each = self._dealt(queries, texts, _block_limits, "q_key long, low double, high double")
        found = each.groupBy("q_key").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        if texts.count() < self.index.n_texts:
            found = found.select("q_key", F.least("low", F.lit(0.0)).alias("low"), F.greatest("high", F.lit(0.0)).alias("high"))
        zero = F.lit(0.0)
        return names.join(found, "q_key", "left").select("q_key", F.coalesce("low", zero).alias("low"), F.coalesce("high", zero).alias("high"))

    def best(self, limits: DataFrame, alpha: float, k: int) -> DataFrame:
        """(q_key, text_key, b, bm25, dense, score): at least the best k texts of every
        query, given (q_key, low, high)."""
        queries = self.queries.join(limits.select("q_key", "low", "high"), "q_key")
        compute = _block_best(alpha, k, self.weightless or self.index.signed)
        return self._dealt(queries, self.texts, compute, "q_key long, text_key long, b double, bm25 double, dense double, score double")


def _blocks(rows: DataFrame, key: str, count: int, name: str) -> DataFrame:
    """A row for each block of rows, with all of its rows as an Arrow stream."""
    n = max(1, min(SIDES, -(-count // LEAST)), -(-count // BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, writer = pa.BufferOutputStream(), None
        for batch in batches:
            if batch.num_rows:
                writer = writer or pa.ipc.new_stream(out, batch.schema)
                writer.write_batch(batch)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({name: pa.array([out.getvalue().to_pybytes()], pa.binary())})

    dealt = rows.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).repartitionById(n, "_block").drop("_block")
    return cut_lineage(dealt.mapInArrow(run, f"{name} binary"), name)


def _packed(entries: DataFrame, key: str) -> DataFrame:
    """(key, b_terms, b_weights, c_terms, c_weights) of (key, term_key, is_b, weight)."""
    entry = F.struct("is_b", "term_key", "weight")
    rows = entries.groupBy(key).agg(F.collect_list(entry).alias("e"))
    kinds = {"b": F.filter("e", lambda x: x["is_b"]), "c": F.filter("e", lambda x: ~x["is_b"])}
    rows = rows.select(key, *[e.alias(kind) for kind, e in kinds.items()])
    return rows.select(key, *[F.col(f"{kind}.{field}").alias(f"{kind}_{name}") for kind in kinds for field, name in (("term_key", "terms"), ("weight", "weights"))])


class _Side:
    """Terms of a block's rows, ordered by row: row, term, weight and kind of each."""

    def __init__(self, frame: pd.DataFrame, key: str):
        frame = frame.sort_values(key)
        self.frame, self.keys, self.size = frame, frame[key].to_numpy(np.int64), len(frame)
        parts = []
        for kind in ("b", "c"):
            if f"{kind}_terms" in frame:
                sizes = np.array([len(t) for t in frame[f"{kind}_terms"]], np.int64)
                some = sizes.sum() > 0
                term = np.concatenate(list(frame[f"{kind}_terms"])).astype(np.int64) if some else np.zeros(0, np.int64)
                weight = np.concatenate(list(frame[f"{kind}_weights"])).astype(float) if some else np.zeros(0)
                parts.append((np.repeat(np.arange(self.size), sizes), term, weight, np.full(len(term), kind == "b")))
        self.row, self.term, self.weight, self.is_b = (np.concatenate(x) for x in zip(*parts))

    def keep(self, known: np.ndarray) -> None:
        """Numbers the terms by their place in `known`; the others are dropped."""
        at = np.minimum(np.searchsorted(known, self.term), max(len(known) - 1, 0))
        held = np.flatnonzero(known[at] == self.term) if len(known) else np.zeros(0, np.int64)
        held = held[np.lexsort((at[held], self.row[held]))]
        self.row, self.term, self.weight, self.is_b = self.row[held], at[held], self.weight[held], self.is_b[held]


class _Pair:
    """A block of queries and a block of texts, with the terms they share."""

    def __init__(self, queries: pd.DataFrame, texts: pd.DataFrame):
        self.q, self.t = _Side(queries, "q_key"), _Side(texts, "text_key")
        known = np.intersect1d(self.q.term, self.t.term)
        self.q.keep(known)
        self.t.keep(known)
        met = np.bincount(self.q.term, minlength=len(known)) * np.bincount(self.t.term, minlength=len(known)).astype(float)
        columns = np.argsort(-met, kind="stable")[:MOST_COLUMNS]
        columns = columns[met[columns] >= DENSE * self.q.size * self.t.size]
        self.terms, self.width = len(known), len(columns)
        self.column = np.full(len(known), -1)
        self.column[columns] = np.arange(len(columns))

    def _part(self, side: _Side, at: int, weights: np.ndarray) -> tuple:
        """A tile's dense columns, and row, term and weight of its other terms by term."""
        low, high = np.searchsorted(side.row, [at, at + TILE])
        row, term, weight = side.row[low:high] - at, side.term[low:high], weights[low:high]
        column = self.column[term]
        dense, rare = np.zeros((min(TILE, side.size - at), self.width)), np.flatnonzero(column < 0)
        inside = column >= 0
        dense[row[inside], column[inside]] = weight[inside]
        rare = rare[np.argsort(term[rare], kind="stable")]
        return dense, row[rare], term[rare], weight[rare]

    def tiles(self, q_weights: np.ndarray, t_weights: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first query, first text, queries by texts) of every tile of products, all texts
        of a tile of queries one after the other."""
        texts = range(0, self.t.size, TILE)
        for i in range(0, self.q.size, TILE):
            left, q_row, q_term, q_weight = self._part(self.q, i, q_weights)
            for j in texts:
                right, t_row, t_term, t_weight = self._part(self.t, j, t_weights)
                scores = left @ right.T
                low, high = np.searchsorted(t_term, q_term), np.searchsorted(t_term, q_term, "right")
                upto = np.cumsum(high - low)
                start = 0
                while start < len(q_term):
                    before = upto[start - 1] if start else 0
                    end = max(start + 1, int(np.searchsorted(upto, before + EXPANDED, "right")))
                    n = (high - low)[start:end]
                    of = np.repeat(np.arange(start, end), n)
                    at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + low[of]
                    place = q_row[of] * scores.shape[1] + t_row[at]
                    scores += np.bincount(place, q_weight[of] * t_weight[at], scores.size).reshape(scores.shape)
                    start = end
                yield i, j, scores

    def sums(self, row: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """BM25 and cosine of pairs (row of a query, row of a text)."""
        low, high = np.searchsorted(self.q.row, row), np.searchsorted(self.q.row, row, "right")
        filed = self.t.row * self.terms + self.t.term
        b, dense = np.zeros(len(row)), np.zeros(len(row))
        step = max(1, EXPANDED // max(1, int((high - low).max(initial=0))))
        for start in range(0, len(row), step):
            n = (high - low)[start : start + step]
            pair = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + low[start : start + step][pair]
            wanted = col[start : start + step][pair] * self.terms + self.q.term[at]
            place = np.minimum(np.searchsorted(filed, wanted), max(len(filed) - 1, 0))
            hit = filed[place] == wanted if len(filed) else np.zeros(len(wanted), bool)
            pair, at, place = pair[hit], at[hit], place[hit]
            product, is_b = self.q.weight[at] * self.t.weight[place], self.q.is_b[at]
            b[start : start + step] = np.bincount(pair[is_b], product[is_b], len(n))
            dense[start : start + step] = np.bincount(pair[~is_b], product[~is_b], len(n))
        return b, dense


def _block_limits(queries: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
    if queries.empty or texts.empty:
        return pd.DataFrame({"q_key": [], "low": [], "high": []})
    pair = _Pair(queries, texts)
    low, high = np.full(pair.q.size, np.inf), np.full(pair.q.size, -np.inf)
    for i, _, scores in pair.tiles(pair.q.weight, pair.t.weight):
        part = slice(i, i + len(scores))
        low[part], high[part] = np.minimum(low[part], scores.min(axis=1)), np.maximum(high[part], scores.max(axis=1))
    return pd.DataFrame({"q_key": pair.q.keys, "low": low, "high": high})


def _block_best(alpha: float, k: int, weightless: bool) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Best k texts of a block per query. A product other than 0 shows that a term is shared;
    with weights of 0, or of either sign, shared terms are counted as well."""

    def compute(queries: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        names = ["q_key", "text_key", "b", "bm25", "dense", "score"]
        if queries.empty or texts.empty:
            return pd.DataFrame({name: [] for name in names})
        pair = _Pair(queries, texts)
        low, width = pair.q.frame["low"].to_numpy(), (pair.q.frame["high"] - pair.q.frame["low"]).to_numpy()
        scale = np.where(width > 0, alpha / np.where(width > 0, width, 1.0), 0.0)
        weights = pair.q.weight * np.where(pair.q.is_b, scale[pair.q.row], 1 - alpha)
        tiles = pair.tiles(weights, pair.t.weight)
        if weightless or (width <= 0).any():
            counts = pair.tiles(np.ones(len(weights)), np.ones(len(pair.t.weight)))
            tiles = ((i, j, scores, met[2] > 0) for (i, j, scores), met in zip(tiles, counts))
        else:
            tiles = ((i, j, scores, scores != 0) for i, j, scores in tiles)
        found = []
        for i, j, scores, shared in tiles:
            if j == 0:
                held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
                kth = np.full(len(scores), -np.inf)
            scores = np.where(shared, scores, -np.inf)
            last = min(k, scores.shape[1]) - 1
            if j == 0 and last < scores.shape[1] - 1:
                kth = -np.partition(-scores, last, axis=1)[:, last]
            row, col = np.nonzero(scores >= np.where(np.isneginf(kth), -np.finfo(float).max, kth - 2 * PLACE)[:, None])
            offset = (scale * low)[i + row]
            held = [np.concatenate(x) for x in zip(held, (row, j + col, np.round(scores[row, col] - offset, 9)))]
            order = np.lexsort((held[1], -held[2], held[0]))  # rows of texts are in the order of their keys
            rank = np.arange(len(order)) - np.searchsorted(held[0][order], held[0][order])
            held = [x[order[rank < k]] for x in held]
            full = order[rank == k - 1]
            if len(full):
                ends = np.flatnonzero(np.bincount(held[0], minlength=len(kth)) >= k)
                kth[ends] = held[2][np.searchsorted(held[0], ends, "right") - 1] + (scale * low)[i + ends]
            if j + scores.shape[1] >= pair.t.size:
                found.append((i + held[0], held[1]))
        row, col = (np.concatenate(x) for x in zip(*found))
        b, dense = pair.sums(row, col)
        bm25 = np.where(width[row] > 0, (b - low[row]) / np.where(width[row] > 0, width[row], 1.0), 0.0)
        values = [pair.q.keys[row], pair.t.keys[col], b, bm25, dense, alpha * bm25 + (1 - alpha) * dense]
        return pd.DataFrame(dict(zip(names, values)))

    return compute
