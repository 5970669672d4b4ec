"""Top-k by cosine between dense vectors: exact by a metric index, or approximate.

Unit vectors are points of a metric space, where the order of distances is the order
of cosines. Every vector is filed under the nearest of a few pivots and, within it,
by its distance from the pivot; the vectors in this order are cut into blocks, each a
ring around a pivot. By the triangle inequality the distance of a query from the pivot
bounds its distance from every vector of a ring. A query first reads its most
promising ring, which gives it k candidates, and then only rings that may hold a
vector as near as the k-th of them. Vectors without any structure leave nothing to
skip: then every ring is read, in the same blocks.

The approximate route files vectors under hashes of random projections and compares
queries with the vectors of their buckets. A sample of queries is answered exactly to
measure the recall; buckets are widened until it is reached.

In both, one task holds a block of vectors and a block of queries, and returns k rows
per query."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.operators.ordering import top_per_group
from replyscope.session import cut_lineage, own_scratch

QUERY_BLOCK = 20_000
QUERY_PARTS = 16  # of the queries that read a block, as long as they are no larger than QUERY_BLOCK
LEAST_QUERIES = 2_000  # of a part, below that there are fewer parts
VECTOR_BLOCK = 20_000
PIVOTS = 256
SLICE = 128  # queries whose scores a task holds at a time
MOST_BLOCKS = 1_000_000  # the table of blocks (32 bytes each) is sent to every task
MARGIN = 1e-8  # scores are rounded to nine places
BUCKET = 1_000  # vectors of a bucket of the approximate route, about
BANDS = 16  # buckets a vector is in, at first
MOST_BANDS = 128
AUDITED = 256  # queries that the recall is measured with


def _block_top(k: int):
    def compute(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or vectors.empty:
            return pd.DataFrame({"query_id": [], "doc_id": [], "dense": []})
        ids = vectors["doc_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        right = _unit(np.array(vectors["vector"].tolist(), dtype=np.float64))[order]
        left = _unit(np.array(queries["vector"].tolist(), dtype=np.float64))
        names = queries["query_id"].to_numpy()
        parts = []
        for at in range(0, len(left), SLICE):
            scores = np.round((left[at : at + SLICE] @ right.T + 1) / 2, 9)
            last = min(k, scores.shape[1]) - 1
            # The k-th score bounds the answer; ties with it come in id order.
            bound = -np.partition(-scores, last, axis=1)[:, last]
            row, col = np.nonzero(scores >= bound[:, None])
            order = np.lexsort((col, -scores[row, col], row))
            row, col = row[order], col[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            row, col = row[rank < k], col[rank < k]
            parts.append(pd.DataFrame({"query_id": names[at + row], "doc_id": ids[col], "dense": scores[row, col]}))
        return pd.concat(parts)

    return compute


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _distances(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances from every pivot; without a pivot there are no rings around one."""
    if not pivots.size or not len(unit):
        return np.zeros((len(unit), max(1, len(pivots))))
    return np.sqrt(np.maximum(0.0, 2 - 2 * unit @ pivots.T))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))


def _plain(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.col("vector").cast("array<double>").alias("vector"))


def _parts(n: Column) -> Column:
    """Parts of the n queries of a block; the block is sent once to each of them."""
    return F.greatest(F.ceil(n / QUERY_BLOCK), F.least(F.lit(QUERY_PARTS), F.ceil(n / LEAST_QUERIES))).cast("int")


def _compared(asked: DataFrame, filed: DataFrame, k: int) -> DataFrame:
    """(query_id, doc_id, dense): the best k of every block that a query reads, from
    asked (query_id, vector, block) and filed (doc_id, vector, block). A block that very
    many queries read is compared with them in several tasks."""
    read = cut_lineage(asked.groupBy("block").agg(_parts(F.count(F.lit(1))).alias("parts")), "read")
    left = asked.join(read, "block").select("query_id", "vector", "block", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part"))
    right = filed.join(read, "block").select("doc_id", "vector", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    kinds = {f.name: f.dataType.simpleString() for f in (*left.schema, *right.schema)}
    schema = f"query_id {kinds['query_id']}, doc_id {kinds['doc_id']}, dense double"
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(_block_top(k), schema)


def _placed(df: DataFrame, key: str, pivots: np.ndarray) -> DataFrame:
    """(key, vector, cell, ring): the nearest pivot and the distance from it; -1 for
    vectors of length zero, which are no points of the sphere."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_matrix(batch))
            far = _distances(unit, shared.value)
            cell = far.argmin(axis=1).astype(np.int32)
            cell[~unit.any(axis=1)] = -1
            ring = far[np.arange(len(far)), np.maximum(cell, 0)]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("vector"), pa.array(cell, pa.int32()), pa.array(ring)], [key, "vector", "cell", "ring"])

    return df.mapInArrow(run, f"`{key}` {kind}, vector array<double>, cell int, ring double")


class Rings:
    """The metric index: vectors in blocks, and the rings that the blocks are."""

    def __init__(self, vectors: DataFrame, block: int = VECTOR_BLOCK, pivots: int = PIVOTS):
        plain = cut_lineage(_plain(vectors, "doc_id"), "vectors")
        count = plain.count()
        block = max(block, -(-count // MOST_BLOCKS))
        drawn = plain.filter(F.exists("vector", lambda x: x != 0)).orderBy(F.xxhash64("vector")).limit(min(pivots, max(1, count // block + 1) * 4))
        points = np.array([r["vector"] for r in drawn.select("vector").collect()], float)  # at most `pivots`
        self.pivots = _unit(points) if len(points) else np.zeros((0, 0))
        self.count = count
        order = ["cell", "ring", "doc_id"]  # equal vectors may be dealt to several blocks
        dealt = _placed(plain, "doc_id", self.pivots).repartitionByRange(max(1, -(-count // block)), *order)
        file = F.struct(F.spark_partition_id().alias("file"), F.col("cell"))
        self.rows = cut_lineage(dealt.select("doc_id", "vector", "ring", file.alias("block")), "rings")
        sizes = self.rows.groupBy("block").agg(F.min("ring").alias("low"), F.max("ring").alias("high"), F.count(F.lit(1)).alias("n"))
        rings = sizes.select("block.file", "block.cell", "low", "high", "n").collect()  # a row per block, at most MOST_BLOCKS and a few
        self.rings = np.array([(r["file"], r["cell"], r["low"], r["high"], r["n"]) for r in rings], float).reshape(-1, 5)


def _chosen(queries: DataFrame, index: Rings, k: int, floor: bool) -> DataFrame:
    """(query_id, vector, block) of the rings a query reads: the most promising ones
    that hold k vectors, or, with a column `floor` of the k-th cosine found, all others
    that may hold a vector at least as near."""
    shared = queries.sparkSession.sparkContext.broadcast((index.pivots, index.rings))
    kind = dict(queries.dtypes)["query_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, rings = shared.value
        cell = rings[:, 1].astype(np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                unit = _unit(_matrix(batch))
                far = _distances(unit, pivots)[:, np.maximum(cell, 0)]
                gap = np.maximum(0.0, np.maximum(rings[:, 2] - far, far - rings[:, 3]))
                most = np.where(cell >= 0, 1 - gap**2 / 2, 0.0)  # the cosine with a zero vector is 0
                order = np.argsort(-most, axis=1, kind="stable")
                held = np.cumsum(rings[order, 4], axis=1)
                first = np.zeros(most.shape, bool)
                np.put_along_axis(first, order, held - rings[order, 4] < k, axis=1)
                if floor:
                    take = ~first & (most >= np.asarray(batch.column("floor"), float)[:, None] - MARGIN)
                else:
                    take = first
                row, ring = np.nonzero(take)
                block = pa.StructArray.from_arrays([pa.array(rings[ring, c].astype(np.int32), pa.int32()) for c in (0, 1)], ["file", "cell"])
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column("query_id").take(rows), batch.column("vector").take(rows), block], ["query_id", "vector", "block"])

    return queries.mapInArrow(run, f"query_id {kind}, vector array<double>, block struct<file:int,cell:int>")


@own_scratch
def dense_cosine(queries: DataFrame, vectors: DataFrame, k: int, block: int = VECTOR_BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, doc_id, dense, rank) from queries (query_id, vector) and vectors
    (doc_id, vector); dense is (cosine + 1) / 2, rounded to nine places, ties by
    doc_id. Exact for every `block` and `pivots`. Vectors of length zero have cosine 0
    with everything."""
    index = Rings(vectors, block, pivots)
    asked = cut_lineage(_plain(queries, "query_id"), "queries")
    order = [F.desc("dense"), F.col("doc_id")]
    first = cut_lineage(_compared(_chosen(asked, index, k, False), index.rows, k), "first")
    best = top_per_group(first, ["query_id"], order, k)
    floors = best.groupBy("query_id").agg((2 * F.min("dense") - 1).alias("floor"), F.count(F.lit(1)).alias("n"))
    # fewer than k found: all vectors have been read, or the query is repeated
    floors = floors.select("query_id", F.when(F.col("n") >= k, F.col("floor")).otherwise(-1.0).alias("floor"))
    rest = asked.join(cut_lineage(floors, "floors"), "query_id")
    second = _compared(cut_lineage(_chosen(rest, index, k, True), "chosen"), index.rows, k)
    return top_per_group(first.unionByName(second), ["query_id"], order, k)


def _buckets(df: DataFrame, key: str, dim: int, bands: int, width: int, seed: int) -> DataFrame:
    """(key, vector, block): the vector once for every band, under the hash of `width`
    projections, each cut into steps."""
    kind = dict(df.dtypes)[key]
    directions = np.random.default_rng(seed).normal(size=(dim, MOST_BANDS * 8))
    directions /= np.linalg.norm(directions, axis=0)
    shifts = np.random.default_rng(seed + 1).random(MOST_BANDS * 8)
    step = 2.0 / math.sqrt(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                cuts = np.floor(_unit(_matrix(batch)) @ directions / step + shifts).astype(np.int64).reshape(batch.num_rows, MOST_BANDS, 8)
                code = np.zeros((batch.num_rows, bands), np.int64)
                for i in range(width):
                    code = code * 64 + (cuts[:, :bands, i] + 32)
                rows = pa.array(np.repeat(np.arange(batch.num_rows), bands))
                block = pa.StructArray.from_arrays([pa.array(np.tile(np.arange(bands, dtype=np.int32), batch.num_rows)), pa.array(code.ravel())], ["band", "code"])
                yield pa.RecordBatch.from_arrays([batch.column(key).take(rows), batch.column("vector").take(rows), block], [key, "vector", "block"])

    return df.mapInArrow(run, f"`{key}` {kind}, vector array<double>, block struct<band:int,code:bigint>")


@own_scratch
def dense_approximate(queries: DataFrame, vectors: DataFrame, k: int, recall: float = 0.9, seed: int = 5) -> DataFrame:
    """As dense_cosine, from the vectors that share a bucket with the query. At most
    AUDITED queries, drawn by hash, are also answered exactly; bands are doubled, then
    buckets widened, until the share of their answers found reaches `recall`. Where no
    setting does, the exact answer is given. Scores are exact, answers may be missed."""
    filed, asked = cut_lineage(_plain(vectors, "doc_id"), "vectors"), cut_lineage(_plain(queries, "query_id"), "queries")
    shape = filed.filter("vector IS NOT NULL").select(F.size("vector")).first()
    if shape is None or asked.isEmpty():
        return dense_cosine(asked, filed, k)
    order = [F.desc("dense"), F.col("doc_id")]
    drawn = asked.dropDuplicates(["query_id"]).orderBy(F.xxhash64("query_id", F.lit(seed))).limit(AUDITED)
    drawn = cut_lineage(drawn, "audited")
    wanted = cut_lineage(dense_cosine(drawn, filed, k), "wanted")
    count, total = filed.count(), wanted.count()
    width = max(1, min(8, round(math.log(max(count / BUCKET, 1)) / math.log(3))))
    while width >= 1:
        bands = BANDS
        while bands <= MOST_BANDS:
            if bands * BUCKET <= 2 * count:  # more than that reads as much as all vectors
                found = _compared(_buckets(drawn, "query_id", shape[0], bands, width, seed), _buckets(filed, "doc_id", shape[0], bands, width, seed), k)
                hit = found.select("query_id", "doc_id").distinct().join(wanted.select("query_id", "doc_id"), ["query_id", "doc_id"]).count()
                if hit >= recall * total:
                    found = _compared(_buckets(asked, "query_id", shape[0], bands, width, seed), _buckets(filed, "doc_id", shape[0], bands, width, seed), k)
                    return top_per_group(found.distinct(), ["query_id"], order, k)
            bands *= 2
        width -= 1
    return dense_cosine(asked, filed, k)
