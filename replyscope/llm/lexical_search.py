"""Ranked lexical search by per-term blocks with exact summary bounds.

Documents are ordered by similarity (nearest and second nearest of a few centres) and
dealt to shards. In a shard every posting list is cut into blocks of similar documents,
and a block stores, for each term that an item reading the list can ask for, the
highest weight that one of its documents has: the coordinatewise maximum. An item's
product with that summary bounds its score of every document in the block.

A first, partial score by each item's rarest terms gives ten documents' scores as a
floor. Lists whose highest weights can't reach the floor together aren't read for the
item at all: every better document is also in one of its other lists. Of those lists a
block is skipped only when its bound is under the floor. The best blocks are scored
first, which lifts the floor, then all others that still reach it. Scores are
integers, bounds are sums of the same integers, so nothing is lost."""

from __future__ import annotations

import dataclasses
import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyscope.llm.common import as_bytes, map_batches, own_scratch, stored
from replyscope.operators.ordering import top_per_group

TOP = 10
ITEMS = 1_024  # items searched for at once, about
TERMS = 16_384  # different terms of these, about
SEEDS = 5_000  # postings of its rarest terms that an item's floor is found with
CENTRES = 64
SHARD = 8_192  # documents whose lists one task cuts at a time
BLOCK = 32  # documents of a block
PAIRS = 1 << 22  # pairs of a document's terms held at a time
ROWS = 1_024  # documents scored at a time
PROBES = 3  # blocks per item that are scored first

#: Bytes of a term stay, A-Z lower-cased; all others end it.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


@dataclasses.dataclass
class Items:
    """Weighted terms of some items, as broadcast to tasks: `weight` of every term;
    the items of a term and, `mine`, the terms of an item, with their repeats."""

    weight: np.ndarray
    start: np.ndarray
    item: np.ndarray
    repeats: np.ndarray
    mine: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, weight: np.ndarray, mine: list[tuple[np.ndarray, np.ndarray]]) -> Items:
        item = np.repeat(np.arange(len(mine)), [len(t) for t, _ in mine])
        term = np.concatenate([t for t, _ in mine]) if mine else np.zeros(0, np.int64)
        order = np.argsort(term, kind="stable")
        repeats = np.concatenate([r for _, r in mine])[order] if mine else np.zeros(0, np.int64)
        return cls(weight, np.searchsorted(term[order], np.arange(len(weight) + 1)), item[order], repeats, mine)

    def only(self, keep: Callable[[int, np.ndarray], np.ndarray]) -> Items:
        """The same items with some of their terms: keep(item, terms) -> flags."""
        return Items.of(self.weight, [(t[f], r[f]) for i, (t, r) in enumerate(self.mine) for f in [keep(i, t)]])

    def scores(self, row: np.ndarray, term: np.ndarray, impact: np.ndarray, rows: int) -> np.ndarray:
        """rows x items sums of the postings (row, term, impact)."""
        each = self.start[term + 1] - self.start[term]
        out = np.zeros(rows * len(self.mine), np.int64)
        at = np.repeat(self.start[term], each) + _counting(each)
        np.add.at(out, np.repeat(row, each) * len(self.mine) + self.item[at], np.repeat(impact, each) * self.repeats[at])
        return out.reshape(rows, len(self.mine))


def _counting(each: np.ndarray) -> np.ndarray:
    """0, 1, ... for every count, one after the other."""
    ends = np.cumsum(each)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - each, each)


@dataclasses.dataclass
class Vectors:
    """Documents as numpy arrays: postings (row, term, impact), row from 0."""

    key: np.ndarray
    row: np.ndarray
    term: np.ndarray
    impact: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, weight: np.ndarray) -> Vectors:
        lists = batch.column("terms")
        each = np.asarray(lists.value_lengths(), np.int64)
        row = np.repeat(np.arange(batch.num_rows), each)
        term, tf = np.asarray(lists.flatten(), np.int64), np.asarray(batch.column("tfs").flatten(), np.int64)
        scale = np.asarray(batch.column("m"), np.int64)
        return cls(np.asarray(batch.column("row"), np.int64), row, term, weight[term] * ((1_000_000_000 * tf) // (1_000 * tf + 8 * scale[row])))


def _over_vectors(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]], schema: str, rows: int = ROWS) -> DataFrame:
    """mapInArrow over (row, m, terms, tfs, ...) in batches of at most `rows`."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))
        for out in fn(cut):
            yield pa.RecordBatch.from_arrays([_array(out[f.name], f.type) for f in arrow], schema=arrow)

    def _array(values: object, kind: pa.DataType) -> pa.Array:
        return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)

    return df.mapInArrow(run, fields)


def _counts(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc, n, terms, tfs): number of terms of every document, and those of the vocabulary."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        number = known.value.get
        for part in parts:
            out = {"doc": part["doc"], "n": [], "terms": [], "tfs": []}
            for body in part["text"]:
                words = terms_of(body)
                found = sorted((t, n) for word, n in Counter(words).items() if (t := number(word)) is not None)
                out["n"].append(len(words))
                out["terms"].append([t for t, _ in found])
                out["tfs"].append([n for _, n in found])
            yield out

    rows = docs.select(F.col(key).cast("long").alias("doc"), as_bytes(text).alias("text"))
    return map_batches(rows, run, "doc long, n long, terms array<int>, tfs array<long>")


def _highest(vectors: DataFrame, items: Items, seeds: Items, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest weight of every term, and per item a floor: the k-th highest
    partial score by its seed terms, 1 if there aren't k."""
    known = vectors.sparkSession.sparkContext.broadcast((items.weight, seeds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        weight, few = known.value
        most, best = np.zeros(len(weight), np.int64), np.zeros((k, len(few.mine)), np.int64)
        for batch in batches:
            v = Vectors.of(batch, weight)
            np.maximum.at(most, v.term, v.impact)
            best = np.sort(np.vstack([best, few.scores(v.row, v.term, v.impact, batch.num_rows)]), axis=0)[-k:]
        seen, (rank, item) = np.flatnonzero(most), np.nonzero(best)
        yield {
            "floor": np.repeat([False, True], [len(seen), len(item)]), "at": np.concatenate([seen, item]),
            "value": np.concatenate([most[seen], best[rank, item]]),
        }

    found = stored(_over_vectors(vectors, run, "floor boolean, at int, value long"), "floors")
    most, floor = np.zeros(len(items.weight), np.int64), np.ones(len(items.mine), np.int64)
    for at, value in found.filter("NOT floor").groupBy("at").agg(F.max("value")).collect():  # one row per term
        most[at] = value
    last = top_per_group(found.filter("floor"), ["at"], [F.desc("value")], k).filter(F.col("rank") == k)
    for at, value in last.select("at", "value").collect():  # one row per item
        floor[at] = max(1, value)
    return most, floor


def _centres(vectors: DataFrame, weight: np.ndarray) -> np.ndarray:
    """terms x centres: unit vectors of a few documents, drawn by hash."""
    drawn = vectors.filter(F.size("terms") > 0).orderBy(F.xxhash64(F.lit("centre"), "row"), "row").limit(CENTRES)
    rows = drawn.select("m", "terms", "tfs").collect()  # CENTRES rows
    out = np.zeros((len(weight), max(len(rows), 1)), np.float32)
    for column, row in enumerate(rows):
        term, tf = np.array(row["terms"]), np.array(row["tfs"])
        impact = weight[term] * ((1_000_000_000 * tf) // (1_000 * tf + 8 * row["m"]))
        out[term, column] = impact / max(1.0, float(np.linalg.norm(impact)))
    return out


def _shards(vectors: DataFrame, weight: np.ndarray, centres: np.ndarray, read: np.ndarray, n_docs: int) -> DataFrame:
    """Documents with a term of `read`, similar ones side by side."""
    known = vectors.sparkSession.sparkContext.broadcast((weight, centres, read))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        weight, centres, read = known.value
        for batch in batches:
            v = Vectors.of(batch, weight)
            near = np.zeros((batch.num_rows, centres.shape[1]), np.float32)
            edges = np.searchsorted(v.row, np.arange(batch.num_rows + 1))
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                near[i] = v.impact[a:b].astype(np.float32) @ centres[v.term[a:b]]
            order = np.argsort(-near, axis=1, kind="stable")
            useful = np.bincount(v.row[read[v.term]], minlength=batch.num_rows) > 0
            yield {
                "row": v.key[useful], "first": order[useful, 0], "second": order[useful, min(1, order.shape[1] - 1)],
                **{c: batch.column(c).filter(pa.array(useful)) for c in ("m", "terms", "tfs")},
            }

    placed = _over_vectors(vectors, run, "row long, first int, second int, m long, terms array<int>, tfs array<long>")
    placed = placed.withColumn("mark", F.xxhash64("row"))
    near = ["first", "second", "mark"]  # equal documents are neighbours, and may be dealt to several shards
    return placed.repartitionByRange(max(1, math.ceil(n_docs / SHARD)), *near).sortWithinPartitions(*near)


def _blocks(shards: DataFrame, items: Items, reads: Items) -> DataFrame:
    """(block, term, rows, terms, most): the cut lists of all shards. `reads` has the
    lists that an item reads; a summary holds the terms of these items."""
    asked = np.zeros((len(items.weight), len(items.weight)), bool)
    for (lists, _), (terms, _) in zip(reads.mine, items.mine):
        asked[np.ix_(lists, terms)] = True
    known = shards.sparkSession.sparkContext.broadcast((items.weight, np.packbits(asked, axis=1), np.diff(reads.start) > 0))

    def cut(v: Vectors, bits: np.ndarray, read: np.ndarray) -> Iterator[dict]:
        edges = np.searchsorted(v.row, np.arange(len(v.key) + 1))
        at = np.flatnonzero(read[v.term])
        at = at[np.argsort(v.term[at], kind="stable")]  # by list, then in the order of similarity
        term, row = v.term[at], v.row[at]
        place = np.arange(len(at)) - np.searchsorted(term, term)
        first = np.flatnonzero(place % BLOCK == 0)
        block = np.cumsum(place % BLOCK == 0) - 1
        width = np.diff(edges)[row]
        load = np.add.reduceat(width, first) if len(first) else np.zeros(0, np.int64)
        part = np.cumsum(load) // PAIRS  # blocks whose pairs are held at the same time
        for low, high in zip(*_runs(part)):
            some = slice(first[low], first[high] if high < len(first) else len(at))
            pair = np.repeat(edges[row[some]], width[some]) + _counting(width[some])
            own = np.repeat(term[some], width[some])
            other = v.term[pair]
            wanted = (bits[own, other >> 3] >> (7 - (other & 7)).astype(np.uint8)) & 1 > 0
            cell = np.repeat(block[some], width[some])[wanted] * len(read) + other[wanted]
            order = np.argsort(cell, kind="stable")
            cell, impact = cell[order], v.impact[pair[wanted]][order]
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            owner, most = cell[starts] // len(read), np.maximum.reduceat(impact, starts)
            cuts = np.searchsorted(owner, np.arange(low, high + 1))
            rows_at = first[low:high] - first[low]
            yield {
                "term": term[first[low:high]],
                "rows": _lists(v.key[row[some]], np.r_[rows_at, some.stop - some.start]),
                "terms": _lists(cell[starts] % len(read), cuts), "most": _lists(most, cuts),
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        weight, bits, read = known.value
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= SHARD:
                yield from cut(_joined(held, weight), bits, read)
                held, size = [], 0
        if size:
            yield from cut(_joined(held, weight), bits, read)

    blocks = _over_vectors(shards, run, "term int, rows array<long>, terms array<int>, most array<long>")
    return stored(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _joined(batches: list[pa.RecordBatch], weight: np.ndarray) -> Vectors:
    return Vectors.of(pa.Table.from_batches(batches).combine_chunks().to_batches()[0], weight)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of equal values."""
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
    return first, np.r_[first[1:], len(x)] if len(x) else first


def _lists(values: np.ndarray, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values))


def _bounds(blocks: DataFrame, items: Items, reads: Items, floor: np.ndarray) -> DataFrame:
    """(block, item, bound) of every block that an item reads and that may hold a
    document at its floor or above."""
    known = blocks.sparkSession.sparkContext.broadcast((items, reads, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        items, reads, floor = known.value
        most = np.zeros(len(items.weight), np.int64)
        for batch in batches:
            out = defaultdict(list)
            lists, tops = batch.column("terms"), batch.column("most")
            for i, (block, term) in enumerate(zip(batch.column("block").to_pylist(), batch.column("term").to_pylist())):
                terms = np.asarray(lists[i].values)
                most[terms] = np.asarray(tops[i].values)
                for item in reads.item[reads.start[term] : reads.start[term + 1]].tolist():
                    mine, repeats = items.mine[item]
                    bound = int(most[mine] @ repeats)
                    if bound >= floor[item]:
                        for c, value in zip(("block", "item", "bound"), (block, item, bound)):
                            out[c].append(value)
                most[terms] = 0
            if out:
                yield out

    return _over_vectors(blocks.select("block", "term", "terms", "most"), run, "block long, item int, bound long")


def _scored(asked: DataFrame, blocks: DataFrame, vectors: DataFrame, items: Items, floor: np.ndarray) -> DataFrame:
    """(item, row, score) of the documents in the blocks `asked` (block, item), scores
    from the floor on. A document is scored once for an item."""
    known = vectors.sparkSession.sparkContext.broadcast((items, floor))
    rows = asked.join(blocks.select("block", "rows"), "block").select("item", F.explode("rows").alias("row"))
    wanted = rows.groupBy("row").agg(F.collect_set("item").alias("items"))  # at most the items searched for at once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        items, floor = known.value
        for batch in batches:
            v = Vectors.of(batch, items.weight)
            scores = items.scores(v.row, v.term, v.impact, batch.num_rows)
            lists = batch.column("items")
            row = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths(), np.int64))
            item = np.asarray(lists.flatten(), np.int64)
            found = scores[row, item]
            keep = found >= floor[item]
            yield {"item": item[keep], "row": v.key[row[keep]], "score": found[keep]}

    return _over_vectors(vectors.join(wanted, "row"), run, "item int, row long, score long")


def _floor(scored: DataFrame, floor: np.ndarray, k: int) -> np.ndarray:
    out = floor.copy()
    last = top_per_group(scored, ["item"], [F.desc("score")], k).filter(F.col("rank") == k)
    for item, score in last.select("item", "score").collect():  # one row per item
        out[item] = max(out[item], score)
    return out


@own_scratch
def _search_some(docs: DataFrame, wanted: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """(item, rank, doc, score) for the items `wanted` (item, term, repeats), few
    enough that their terms are broadcast."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "item long, rank int, doc long, score long")
    rows = wanted.collect()  # about ITEMS items and TERMS terms
    if not rows:
        return empty
    names = sorted({r["item"] for r in rows})
    vocabulary = {term: i for i, term in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    counts = stored(_counts(docs, key, text, vocabulary).withColumn("row", F.monotonically_increasing_id()), "counts")
    n_docs, n_terms = counts.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_terms:
        return empty
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per term
        df[term] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    number = {name: i for i, name in enumerate(names)}
    by_item: list[list[tuple[int, int]]] = [[] for _ in names]
    for r in rows:
        by_item[number[r["item"]]].append((vocabulary[bytes(r["term"])], r["repeats"]))
    mine = [tuple(np.array(sorted(pairs), np.int64).T) for pairs in by_item]
    items = Items.of(weight, mine)
    scale = F.expr(f"25 + (75 * n * {n_docs}L) div {n_terms}L")
    vectors = counts.filter(F.size("terms") > 0).select("row", scale.alias("m"), "terms", "tfs")

    def seeds(item: int, terms: np.ndarray) -> np.ndarray:
        order = np.argsort(df[terms], kind="stable")
        flags = np.zeros(len(terms), bool)
        flags[order] = np.cumsum(df[terms][order]) <= SEEDS
        return flags

    most, floor = _highest(vectors, items, items.only(seeds), k)

    def read(item: int, terms: np.ndarray) -> np.ndarray:
        """All but the most frequent terms that can't reach the floor together."""
        order = np.argsort(-df[terms], kind="stable")
        flags = np.zeros(len(terms), bool)
        flags[order] = np.cumsum((most[terms] * items.mine[item][1])[order]) >= floor[item]
        return flags & (df[terms] > 0)

    reads = items.only(read)
    shards = _shards(vectors, weight, _centres(vectors, weight), np.diff(reads.start) > 0, n_docs)
    blocks = _blocks(shards, items, reads)
    bounds = stored(_bounds(blocks, items, reads, floor), "bounds")
    probes = stored(top_per_group(bounds, ["item"], [F.desc("bound"), F.col("block")], PROBES).select("block", "item"), "probes")
    first = stored(_scored(probes, blocks, vectors, items, floor), "probed")
    floor = _floor(first.distinct(), floor, k)
    floors = spark.createDataFrame(list(enumerate(floor.tolist())), "item int, least long")
    rest = bounds.join(F.broadcast(floors), "item").filter("bound >= least").join(probes, ["block", "item"], "left_anti")
    second = _scored(rest.select("block", "item"), blocks, vectors, items, floor)
    found = first.unionByName(second).distinct().join(F.broadcast(floors), "item").filter("score >= least")
    found = stored(found.select("item", "row", "score"), "scored")
    found = found.join(counts.select("row", "doc"), "row")
    order = [F.desc("score"), F.col("doc").asc_nulls_last(), F.col("row")]
    best = top_per_group(found, ["item"], order, k)
    named = spark.createDataFrame(list(enumerate(names)), "at int, name long")
    best = best.withColumnRenamed("item", "at").join(F.broadcast(named), "at")
    return best.select(F.col("name").alias("item"), F.col("rank").cast("int").alias("rank"), "doc", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(item, rank, key, score): the k highest-scoring rows of `docs` for every row of
    `items`, scores above 0 only, equal scores by ascending key (null last). All rows
    of `docs` are searched; scores and order are exact.

    Null and empty texts have no terms: such documents are never found and not counted,
    such items find nothing. Repeated rows, equal and null keys are documents and items
    of their own. Empty tables give an empty result. Other columns are not read. Items
    are searched for in blocks of about ITEMS items and TERMS terms, one after the other."""
    named = items.select(F.col(item).cast("long").alias("name"), as_bytes(text).alias("text"))
    named = stored(named.withColumn("item", F.monotonically_increasing_id()), "items")

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            out = {"item": [], "term": [], "repeats": []}
            for name, body in zip(part["item"], part["text"]):
                for term, n in Counter(terms_of(body)).items():
                    for c, value in zip(out, (name, term, n)):
                        out[c].append(value)
            yield out

    wanted = stored(map_batches(named.select("item", "text"), run, "item long, term binary, repeats long"), "wanted")
    n_items, n_terms = wanted.agg(F.count_distinct("item"), F.count(F.lit(1))).first()
    parts = max(1, math.ceil(n_items / ITEMS), math.ceil(n_terms / TERMS) if n_items > 1 else 1)
    found = None
    for part in range(parts):
        some = wanted.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        one = _search_some(docs, some, k, key, text)
        found = one if found is None else found.unionByName(one)
    best = found.join(named.select("item", F.col("name")), "item")
    return best.select(F.col("name").alias(item), "rank", F.col("doc").alias(key), "score")
