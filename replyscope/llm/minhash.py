"""Near-duplicate documents by HyperMinHash sketches (Yu and Weber, 2017).

Every word shingle is hashed once. Seven bits choose one of 128 buckets; of the
smallest hash of a bucket only the number of leading zeros (6 bits) and the 10
bits after the leading one are kept. Four registers make one 64-bit band, 32 bands
one sketch. Buckets without a shingle borrow the register of another bucket in a
fixed random order (optimal densification, Shrivastava 2017), so that small sets
have full bands too: two sets of Jaccard similarity s share a band with
probability 1 - (1 - s^4)^32, which leaves out 5 in 10^8 pairs at s = 0.8.

Documents with equal sets are one class from the start. Bands are then used in three
rounds, each with its third: every class is compared with one random class of each of its bands,
the most similar of them is confirmed on the full shingle sets, and components grow.
That is linear in any group of copies, and joins almost all of a group. At last the
bands that still hold several components are searched completely: a task compares
two blocks of a band, sets included, for pairs of different components that share no
earlier band, and reports one confirmed link for a class and component. Pairs are
confirmed unless the estimated similarity, corrected for accidental register
equality, is five standard errors below the threshold. No band, group or number of
partners is capped."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import as_bytes, map_batches, mix, own_scratch, signed, split_words, stored, window_hashes, word_hashes
from replyscope.llm.components import components

BUCKETS = 128
BANDS = 32
MANTISSA = 10
HASH_BITS = 57  # of a shingle's hash, below the seven that choose the bucket
BLOCK = 2_000_000  # shingles of one band's block; a task compares two blocks at most
ROUNDS = 3  # of linear comparisons, each with its share of the bands
STEPS = 3  # that components grow between rounds
BROADCAST_ROWS = 500_000  # pairs or ids, 16 bytes each, that are sent to every task
_BORROW = np.stack([np.random.default_rng(i).permutation(BUCKETS) for i in range(BUCKETS)])


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of `size` words; fewer words are
    one shingle, no words none. Only A-Z are lower-cased."""
    words = split_words(text.lower() if text else text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(window_hashes(hashes, min(size, len(hashes))))


def registers(shingles: np.ndarray) -> np.ndarray:
    """The 128 16-bit registers of a non-empty sorted shingle set."""
    first = np.searchsorted(shingles, np.arange(BUCKETS, dtype=np.uint64) << np.uint64(HASH_BITS))
    full = np.zeros(BUCKETS, bool)
    inside = first < len(shingles)
    full[inside] = (shingles[first[inside]] >> np.uint64(HASH_BITS)) == np.flatnonzero(inside).astype(np.uint64)
    low = np.zeros(BUCKETS, np.uint64)
    low[full] = shingles[first[full]] & np.uint64((1 << HASH_BITS) - 1)
    out = np.zeros(BUCKETS, np.uint16)
    out[full] = _compress(low[full])
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _BORROW[empty]
        out[empty] = out[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return out


def _compress(low: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of 57-bit values."""
    top, end = (low >> np.uint64(32)).astype(np.float64), (low & np.uint64(0xFFFFFFFF)).astype(np.float64)
    length = np.where(top > 0, np.frexp(top)[1] + 32, np.frexp(end)[1]).astype(np.int64)
    zeros = np.uint64(HASH_BITS) - length.astype(np.uint64)
    shift = length - 1 - MANTISSA
    kept = np.where(shift >= 0, low >> np.maximum(shift, 0).astype(np.uint64), low << np.maximum(-shift, 0).astype(np.uint64))
    return ((zeros << np.uint64(MANTISSA)) | (kept & np.uint64((1 << MANTISSA) - 1))).astype(np.uint16)


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that the registers of one bucket are equal by accident, for
    unrelated sets of these sizes: the sum over leading-zero counts of both
    sets' probability to have it, spread over the mantissas."""
    edges = 0.5 ** np.arange(HASH_BITS + 1)

    def has(n):
        rate = np.maximum(np.asarray(n, np.float64), 1)[:, None] / BUCKETS
        empty = np.exp(-rate)
        within = np.exp(-rate * edges[1:]) - np.exp(-rate * edges[:-1])
        return within / np.maximum(1 - empty, 1e-12)

    return (has(n_a) * has(n_b)).sum(axis=1) / (1 << MANTISSA)


def estimate(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers."""
    c = chance(n_a, n_b)
    return (equal / BUCKETS - c) / (1 - c)


def floor_of(percent: int) -> float:
    s = percent / 100
    return s - 5 * np.sqrt(s * (1 - s) / BUCKETS)


def sketches(docs: DataFrame, shingle: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, f1, f2, registers): size and 128-bit fingerprint of the
    shingle set, and its sketch (null for an empty set)."""

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            out = {name: [] for name in ("key", "n_shingles", "f1", "f2", "registers")}
            out["key"] = part["key"]
            for body in part["text"]:
                s = shingle_set(body, shingle)
                out["n_shingles"].append(len(s))
                out["f1"].append(int(mix(s).sum(dtype=np.uint64).view(np.int64)))
                out["f2"].append(int(mix(~s).sum(dtype=np.uint64).view(np.int64)))
                out["registers"].append(registers(s).tobytes() if len(s) else None)
            yield out

    columns = docs.select(F.col(key).cast("long").alias("key"), as_bytes(text).alias("text"))
    return map_batches(columns, run, "key long, n_shingles long, f1 long, f2 long, registers binary")


@own_scratch
def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(key, n_shingles, component_id, kept) per row of `docs`: documents are
    linked if 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest key reachable by links.

    Null and empty texts have no shingles and are linked with nothing. Rows with a
    null key are linked with nothing, have a null component and are kept. Repeated
    rows get the same answer each; a key with several texts links all of them.
    Other columns of `docs` are ignored. Work: two passes over the texts, the band
    keys twice, and the texts of candidate documents."""
    same_set = ["n_shingles", "f1", "f2"]
    sketch = stored(sketches(docs, shingle, key, text), "sketch")
    linkable = F.col("key").isNotNull() & (F.col("n_shingles") > 0)
    known = sketch.filter(linkable)
    classes = stored(known.groupBy(*same_set).agg(F.min("key").alias("rep"), F.min("registers").alias("registers")), "classes")
    links = class_links(classes, docs, shingle, percent, key, text, block)
    member = stored(known.select("key", *same_set).join(classes.drop("registers"), same_set).select("key", "n_shingles", "rep"), "member")
    several = stored(member.groupBy("key").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).filter("b <> top"), "several")
    same_key = member.join(several, "key").select(F.col("rep").alias("a"), "b")
    comp = components(links.unionByName(same_key)).withColumnRenamed("node", "rep")
    joined = member.join(comp, "rep", "left").select("key", "n_shingles", F.coalesce("component", "rep").alias("component"))
    found = joined.unionByName(sketch.filter(~linkable).select("key", "n_shingles", F.col("key").alias("component")))
    return found.select(
        F.col("key").alias(key), "n_shingles", F.col("component").alias("component_id"), F.col("key").eqNullSafe(F.col("component")).alias("kept")
    )


@own_scratch
def class_links(classes: DataFrame, docs: DataFrame, shingle: int, percent: int, key: str, text: str, block: int) -> DataFrame:
    """Confirmed links (a, b) between class representatives that connect all
    representatives which links connect."""
    bands = stored(_bands(classes), "bands")
    shared = stored(bands.groupBy("band", "value").agg(F.count("rep").alias("n")).filter("n > 1").drop("n"), "shared")
    members = stored(bands.join(shared, ["band", "value"]), "members")
    candidates = stored(members.select("rep").distinct(), "candidates")
    light = stored(classes.select("rep", "n_shingles", "registers").join(_sent(candidates), "rep"), "light")
    sets = stored(_shingle_sets(docs, candidates, shingle, key, text), "sets")
    links, comp = [], light.select("rep", "n_shingles", F.col("rep").alias("component"))
    for round_ in range(ROUNDS):
        placed = members.filter(F.col("band") % ROUNDS == round_).join(_sent(comp), "rep")
        order = F.xxhash64("rep", "band", "value")
        centre = placed.groupBy("band", "value").agg(
            F.min_by("rep", order).alias("a"), F.min_by("component", order).alias("c"), F.min("component").alias("c1"), F.max("component").alias("c2")
        )
        centre = stored(centre.filter("c1 <> c2").select("band", "value", "a", "c"), "centres")
        star = placed.join(centre, ["band", "value"]).filter("component <> c").select("a", F.col("rep").alias("b")).distinct()
        near = _similar(star, light, percent).groupBy("b").agg(F.max_by("a", "similarity").alias("a"))
        links.append(stored(_confirmed(near.select("a", "b"), sets, percent), "links"))
        comp = stored(_contracted(comp, links[-1]), "comp")
    placed = members.join(_sent(comp), "rep")
    mixed = placed.groupBy("band", "value").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.sum("n_shingles").alias("n"))
    mixed = stored(mixed.filter("c1 <> c2").select("band", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "mixed")
    open_members = stored(placed.drop("n_shingles").join(mixed, ["band", "value"]), "open")
    rest = _links_of_blocks(open_members.join(sets.withColumnRenamed("key", "rep"), "rep"), percent)
    return reduce(DataFrame.unionByName, links, rest)


def _contracted(comp: DataFrame, links: DataFrame) -> DataFrame:
    """`comp` (rep, n_shingles, component) after `STEPS` steps along new links towards the
    smallest component. What stays apart is no mistake here: it is searched again."""
    ends = [comp.select(F.col("rep").alias(c), F.col("component").alias(f"c{c}")) for c in ("a", "b")]
    across = links.join(_sent(ends[0]), "a").join(_sent(ends[1]), "b").filter("ca <> cb")
    both = across.select(F.col("ca").alias("x"), F.col("cb").alias("y")).unionByName(across.select(F.col("cb").alias("x"), F.col("ca").alias("y")))
    both = stored(both.distinct(), "across")
    label = stored(both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("z")), "labels")
    for _ in range(STEPS - 1):
        beside = _sent(label).withColumnRenamed("x", "y")
        label = stored(both.join(beside, "y").groupBy("x").agg(F.min("z").alias("z")), "labels")
    label = _sent(label).withColumnRenamed("x", "component")
    return comp.join(label, "component", "left").select("rep", "n_shingles", F.coalesce("z", "component").alias("component"))


def _sent(table: DataFrame) -> DataFrame:
    """The stored table, sent to every task if it is counted to be small."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS // (1 + 16 * ("registers" in table.columns)) else table


def _bands(classes: DataFrame) -> DataFrame:
    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            values = np.frombuffer(b"".join(part["registers"]), np.int64)
            n = len(part["rep"])
            yield {"band": np.tile(np.arange(BANDS, dtype=np.int8), n), "value": values, "rep": np.repeat(np.array(part["rep"], np.int64), BANDS)}

    return map_batches(classes.select("rep", "registers"), run, "band byte, value long, rep long")


def _similar(pairs: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    """(a, b, similarity) of the pairs whose estimate does not exclude the threshold."""
    floor = floor_of(percent)

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            if not part["a"]:
                continue
            ra = np.frombuffer(b"".join(part["ra"]), np.uint16).reshape(-1, BUCKETS)
            rb = np.frombuffer(b"".join(part["rb"]), np.uint16).reshape(-1, BUCKETS)
            similarity = estimate((ra == rb).sum(axis=1), np.array(part["na"]), np.array(part["nb"]))
            keep = similarity >= floor
            yield {c: np.array(part[c], np.int64)[keep] for c in ("a", "b")} | {"similarity": similarity[keep]}

    a = light.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("registers").alias("ra"))
    b = light.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("registers").alias("rb"))
    sized = pairs.join(a, "a").join(b, "b").filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return map_batches(sized.select("a", "b", "na", "nb", "ra", "rb"), run, "a long, b long, similarity double")


def _links_of_blocks(members: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between different components within one band, one
    for every class and other component of a block. Pairs that share an earlier band
    are left to it. A band's members are dealt over a grid of blocks."""
    floor = floor_of(percent)

    def compare(table: pa.Table) -> pa.Table:
        rep, comp = (table[c].to_numpy() for c in ("rep", "component"))
        left, diagonal = table["left"].to_numpy(zero_copy_only=False), table["row"][0].as_py() == table["col"][0].as_py()
        sets = [x.values.to_numpy().view(np.uint64) for x in table["shingles"].combine_chunks()]
        n, reg = np.array([len(s) for s in sets]), np.stack([registers(s) for s in sets])
        earlier = reg.view(np.uint64)[:, : table["band"][0].as_py()]
        right, found = np.arange(len(rep)) if diagonal else np.flatnonzero(~left), []
        for i in np.flatnonzero(left):
            other = right[right > i] if diagonal else right
            other = other[(comp[other] != comp[i]) & (100 * np.minimum(n[other], n[i]) >= percent * np.maximum(n[other], n[i]))]
            other = other[(earlier[other] != earlier[i]).all(axis=1)]
            other = other[estimate((reg[other] == reg[i]).sum(axis=1), np.full(len(other), n[i]), n[other]) >= floor]
            linked: set[int] = set()
            for j in other:
                if comp[j] not in linked and 100 * (common := _common(sets[i], sets[j])) >= percent * (n[i] + n[j] - common):
                    linked.add(comp[j])
                    found.append((rep[i], rep[j]))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    grid = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grid = grid.select(
        "band", "value", "rep", "component", "shingles",
        F.least("own", "other").alias("row"), F.greatest("own", "other").alias("col"), (F.col("own") <= F.col("other")).alias("left"),
    )
    return grid.groupBy("band", "value", "row", "col").applyInArrow(compare, "a long, b long")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return int((a[at] == b).sum())


def _shingle_sets(docs: DataFrame, candidates: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """(key, shingles) of the candidate documents."""

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            yield {"key": part["key"], "shingles": [signed(shingle_set(body, shingle)) for body in part["text"]]}

    texts = docs.select(F.col(key).cast("long").alias("key"), as_bytes(text).alias("text"))
    texts = texts.join(_sent(candidates.withColumnRenamed("rep", "key")), "key", "left_semi")
    return map_batches(texts, run, "key long, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold. Sets that no pair
    needs stay where they are."""
    pairs = stored(pairs, "pairs")
    ends = stored(pairs.select("a").distinct(), "ends")
    a = sets.withColumnsRenamed({"key": "a", "shingles": "sa"}).join(_sent(ends), "a", "left_semi")
    b = sets.withColumnsRenamed({"key": "b", "shingles": "sb"})
    both = b.join(_sent(pairs), "b").join(a, "a").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.filter(100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b").distinct()
