"""Near-duplicate vectors by NN-descent (Dong, Charikar and Li, 2011).

A graph of nearest neighbours starts from buckets of random hyperplanes and is
refined: every node brings its neighbours and the nodes it is a neighbour of
together, and each of them keeps the nearest it has met. A node whose whole list
lies above the threshold may have more such neighbours; its list is doubled. The
refinement ends when hardly any list changes. The recall of the links is then
measured with a sample of nodes against all vectors; if it is too low, more
buckets are drawn and the descent goes on.

Equal vectors are one node with a multiplicity. Edges above the threshold give the
components. A list that was saturated may lack links to other components; such
nodes are covered by leaders, and components are joined exactly through pairs of
leaders whose angle allows a link of their members. Saturated lists are completed
inside their component, block by block, where counts of links and not pairs leave
a task. All similarities are computed in double precision."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import map_batches, own_scratch, stored
from replyscope.llm.components import components

THRESHOLD = 0.9
NEIGHBOURS = 8
TABLES = 10  # bucket tables drawn at a time, and the fewest of a descent
BUCKET = 96  # vectors compared in one bucket
ROUNDS = 8
SETTLED = 0.002  # share of changed entries that ends the descent
RECALL = 0.99
START = 0.95  # chance that a pair at the threshold shares one of the buckets of a descent
FINER = 12  # further bits that divide buckets above `BUCKET`
AUDIT = 256  # vectors compared with all others at first
AUDIT_MOST = 16_384  # and at most
AUDITED = 64  # vectors with few links that the audit looks for
BLOCK = 1_024  # vectors of a component's block
LONGEST = 64  # neighbours that a saturated list grows to before its component is counted in blocks
COVER = 0.99  # cosine of a leader to the nodes it stands for


def unit_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): usable vectors scaled to length one, in double precision. Null or
    zero vectors, and those with null or non-finite components, are left out."""

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            out = {"id": [], "v": []}
            for name, x in zip(part["id"], part["v"]):
                if x and None not in x:
                    unit = np.array(x, np.float64)
                    largest = np.abs(unit).max()
                    if np.isfinite(unit).all() and largest > 0:
                        unit = unit / largest  # no overflow of squares
                        out["id"].append(name)
                        out["v"].append(unit / np.sqrt((unit * unit).sum()) + 0.0)  # no negative zeros
            yield out

    rows = vectors.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return map_batches(rows, run, "id long, v array<double>")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _best(ids: np.ndarray, v: np.ndarray, k: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, ...]:
    """The k[i] nearest of every member among the others that are nearer than floor[i]."""
    s = np.round(v @ v.T, 12)
    np.fill_diagonal(s, -2.0)
    s[ids[:, None] == ids[None, :]] = -2.0
    width = min(int(k.max()), len(ids) - 1)
    if width < 1:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.float64))
    near = np.argpartition(-s, width - 1, axis=1)[:, :width]
    sim = np.take_along_axis(s, near, axis=1)
    order = np.argsort(-sim, axis=1, kind="stable")
    near, sim = np.take_along_axis(near, order, axis=1), np.take_along_axis(sim, order, axis=1)
    keep = (np.arange(width)[None, :] < k[:, None]) & (sim > floor[:, None]) & (sim > -1.5)
    i, j = np.nonzero(keep)
    return ids[i], ids[near[i, j]], sim[i, j]


def _groupwise(df: DataFrame, group: list[str], columns: list[str], fn, schema: str) -> DataFrame:
    """`fn(columns as arrays) -> dict` for every group, many groups to a task."""

    def run(table: pa.Table) -> pa.Table:
        out = fn({c: _matrix(table[c]) if c == "v" else table[c].to_numpy() for c in columns})
        return pa.table([pa.array(x) for x in out], names=names)

    names = [part.strip().split()[0] for part in schema.split(",")]
    return df.select(*group, *columns).groupBy(*group).applyInArrow(run, schema)


def _bits(count: int) -> int:
    return max(1, min(40, int(np.ceil(np.log2(max(count / (BUCKET / 2), 1))))))


def tables_needed(count: int, threshold: float) -> int:
    """Tables in one of which a pair at the threshold shares a bucket with chance `START`."""
    shared = (1 - np.arccos(np.clip(threshold, -1.0, 1.0)) / np.pi) ** _bits(count)
    return TABLES if shared >= 1 else max(TABLES, int(np.ceil(np.log(1 - START) / np.log1p(-shared))))


def _buckets(vectors: DataFrame, count: int, dim: int, seed: int, tables: int) -> DataFrame:
    """(table, code, fine, part, id, v): every vector in one bucket of every table.
    Buckets larger than `BUCKET` are divided by further hyperplanes, and what is
    still larger, as copies are, is dealt by a hash of the id."""
    bits = _bits(count)
    planes = np.random.default_rng(seed).standard_normal((tables, dim, bits + FINER))

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            if part["id"]:
                v = np.array(part["v"])
                codes = np.stack([((v @ p > 0) @ (1 << np.arange(bits + FINER))).astype(np.int64) for p in planes], axis=1)
                yield {"id": part["id"], "codes": list(codes)}

    codes = map_batches(vectors.select("id", "v"), run, "id long, codes array<long>")
    coded = codes.select("id", F.posexplode("codes").alias("table", "all"))
    coded = stored(coded.select("id", "table", F.expr(f"all & {(1 << bits) - 1}L").alias("code"), F.shiftright("all", bits).alias("rest")), "codes")
    sizes = coded.groupBy("table", "code").agg(F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes.select("table", "code", F.least(F.ceil(F.log2(F.greatest(F.col("n") / BUCKET, F.lit(1.0)))), F.lit(FINER)).cast("int").alias("more")), "code_sizes")
    fine = stored(coded.join(sizes, ["table", "code"]).select("id", "table", "code", F.expr("rest & (shiftleft(1L, more) - 1L)").alias("fine")), "codes")
    sizes = stored(fine.groupBy("table", "code", "fine").agg(F.count(F.lit(1)).alias("n")), "code_sizes")
    deal = F.pmod(F.xxhash64("id", "table"), F.ceil(F.col("n") / BUCKET)).cast("long")
    placed = fine.join(sizes, ["table", "code", "fine"]).select("id", "table", "code", "fine", deal.alias("part"))
    return placed.join(vectors, "id")


def _merge(old: DataFrame | None, found: DataFrame, lists: DataFrame) -> DataFrame:
    """The nearest k of every node among old and new neighbours; the node's list
    is one row (id, k, near) with near an array of (sim, nbr), nearest first."""
    new = found.select("id", F.struct((-F.col("sim")).alias("d"), F.col("nbr").alias("nbr")).alias("e"))
    if old is not None:
        new = new.unionByName(old.select("id", F.explode("near").alias("e")))
    merged = new.groupBy("id").agg(F.sort_array(F.collect_set("e")).alias("near"))
    return lists.join(merged, "id", "left").select("id", "k", F.slice(F.coalesce("near", F.array().cast("array<struct<d:double,nbr:bigint>>")), 1, F.col("k")).alias("near"))


def descend(vectors: DataFrame, threshold: float, graph: DataFrame | None, round_: int, count: int, dim: int) -> DataFrame:
    """One descent: fresh buckets, then refinement until the lists settle."""
    lists = vectors.select("id").withColumn("k", F.lit(NEIGHBOURS)) if graph is None else graph.select("id", "k")

    def in_bucket(c: dict) -> tuple:
        n = len(c["id"])
        return _best(c["id"], c["v"], np.full(n, NEIGHBOURS), np.full(n, -2.0))

    left, seed = tables_needed(count, threshold), 1000 + round_
    while left > 0:
        buckets = _buckets(vectors, count, dim, seed, min(left, TABLES))
        start = _groupwise(buckets, ["table", "code", "fine", "part"], ["id", "v"], in_bucket, "id long, nbr long, sim double")
        graph = stored(_merge(graph, start, lists), "graph")
        left, seed = left - TABLES, seed + 1000
    for _ in range(ROUNDS):
        full = F.size("near") >= F.col("k")
        saturated = full & (F.try_element_at("near", F.lit(-1))["d"] <= -threshold) & (F.col("k") < LONGEST)
        kth = F.when(full & ~saturated, -F.try_element_at("near", F.lit(-1))["d"]).otherwise(F.lit(-2.0))
        limits = graph.select("id", F.when(saturated, F.col("k") * 2).otherwise(F.col("k")).alias("k"), kth.alias("floor"))
        limits = stored(limits.join(vectors, "id"), "limits")
        # the members that a node brings together: itself, its neighbours, and some whose neighbour it is
        forward = graph.select(F.col("id").alias("at"), F.explode(F.slice("near", 1, NEIGHBOURS)).alias("e")).select("at", F.col("e.nbr").alias("id"))
        backward = forward.select(F.col("id").alias("at"), F.col("at").alias("id"))
        some = backward.withColumn("slot", F.pmod(F.xxhash64("at", "id", F.lit(_)), F.lit(NEIGHBOURS)))
        some = some.groupBy("at", "slot").agg(F.min("id").alias("id")).select("at", "id")
        own = graph.select(F.col("id").alias("at"), "id")
        together = forward.unionByName(some).unionByName(own).distinct()
        members = together.join(limits, "id")

        def meet(c: dict) -> tuple:
            return _best(c["id"], c["v"], c["k"], c["floor"])

        found = _groupwise(members, ["at"], ["id", "v", "k", "floor"], meet, "id long, nbr long, sim double").distinct()
        after = stored(_merge(graph, found, limits.select("id", "k")), "graph")
        pairs = graph.select("id", F.explode("near.nbr").alias("nbr"))
        now = after.select("id", F.explode("near.nbr").alias("nbr"))
        changed, total = now.join(pairs, ["id", "nbr"], "left_anti").count(), now.count()
        graph = after
        if changed <= SETTLED * max(total, 1):
            break
    return graph


def _collapse(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, v, w): every different vector under the smallest of its w ids; and
    (id, node, w) for every id."""
    nodes = stored(rows.groupBy("v").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("w")), "nodes")
    many = stored(nodes.filter("w > 1"), "repeated")
    named = rows.join(many, "v", "left").select("id", F.coalesce("node", "id").alias("node"), F.coalesce("w", F.lit(1)).cast("long").alias("w"))
    return stored(nodes.select(F.col("node").alias("id"), "v", "w"), "vectors"), stored(named, "named")


def _joined(comp: DataFrame, pairs: DataFrame) -> DataFrame:
    """`comp` with the components of every pair (a, b) joined."""
    roots = stored(components(pairs).select(F.col("node").alias("component"), F.col("component").alias("root")), "roots")
    return stored(comp.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "components")


def _cover(c: dict) -> tuple:
    """A leader of every node, at cosine `COVER` or more, and the cosine."""
    ids, s = c["id"], c["v"] @ c["v"].T
    leader, left = np.zeros(len(ids), np.int64), np.ones(len(ids), bool)
    while left.any():
        i = int(left.argmax())
        own = left & (s[i] >= COVER)
        own[i] = True
        leader[own] = i
        left &= ~own
    return ids, ids[leader], np.minimum(s[np.arange(len(ids)), leader], 1.0)


def _cross(vectors: DataFrame, graph: DataFrame, comp: DataFrame, threshold: float) -> DataFrame:
    """`comp` with those components joined that a link between two nodes joins whose
    lists are or were saturated. Exact: two nodes can be linked only if the angle of
    their leaders is at most that of the threshold and both leaders' reach. Leaders
    are compared over a grid of blocks, then the members of the pairs that are left."""
    last = F.try_element_at("near", F.lit(-1))["d"]
    crowded = graph.filter((F.col("k") > NEIGHBOURS) | (last <= -threshold)).select(F.col("id").alias("node"))
    crowded = stored(crowded.join(comp, "node").select(F.col("node").alias("id"), "component"), "crowded")
    if crowded.select("component").distinct().limit(2).count() < 2:
        return comp
    sizes = stored(crowded.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks")), "sizes")
    placed = crowded.join(sizes, "component").select("id", "component", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("part"))
    covers = _groupwise(placed.join(vectors.select("id", "v"), "id"), ["component", "part"], ["id", "v"], _cover, "id long, leader long, sim double")
    covers = stored(covers, "covers")
    leaders = covers.groupBy("leader").agg(F.min("sim").alias("reach")).withColumnRenamed("leader", "id")
    leaders = stored(leaders.join(crowded, "id"), "leaders")
    blocks = -(-leaders.count() // BLOCK)
    grid = leaders.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    grid = grid.withColumn("r", F.least("own", "other")).withColumn("c", F.greatest("own", "other"))
    widest = np.arccos(min(1.0, threshold))

    def compare(c: dict) -> tuple:
        ids, group, reach = c["id"], c["component"], np.arccos(c["reach"])
        first = c["own"] == c["own"].min()
        left, right = np.flatnonzero(first), np.flatnonzero(~first)
        if not len(right):  # a block with itself, or one whose partner is empty
            right = left
        s = np.round(c["v"][left] @ c["v"][right].T, 12)
        angle = np.arccos(np.clip(s, -1.0, 1.0))
        i, j = np.nonzero((angle <= widest + reach[left][:, None] + reach[right][None, :] + 1e-6) & (group[left][:, None] < group[right][None, :]))
        if len(left) and right is not left:
            x, y = np.nonzero((angle <= widest + reach[left][:, None] + reach[right][None, :] + 1e-6) & (group[left][:, None] > group[right][None, :]))
            i, j = np.r_[i, x], np.r_[j, y]
        a, b = left[i], right[j]
        return ids[a], ids[b], group[a], group[b], s[i, j] >= threshold

    found = _groupwise(grid.join(vectors.select("id", "v"), "id"), ["r", "c"], ["id", "component", "reach", "own", "v"], compare, "a long, b long, ca long, cb long, sure boolean")
    found = stored(found, "leader_pairs")
    sure = found.filter("sure").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    comp = _joined(comp, sure)
    # pairs of leaders that may have linked members, if their components are still apart
    root = comp.select(F.col("node").alias("ca"), F.col("component").alias("ra"))
    open_ = found.filter("NOT sure").join(root, "ca").join(root.select(F.col("ca").alias("cb"), F.col("ra").alias("rb")), "cb").filter("ra <> rb").select("a", "b", "ra", "rb")
    open_ = stored(open_, "open_pairs")
    sides = open_.select("*", F.col("a").alias("leader"), F.lit(0).alias("side")).unionByName(open_.select("*", F.col("b").alias("leader"), F.lit(1).alias("side")))

    def meet(c: dict) -> tuple:
        left = c["side"] == 0
        hit = bool((np.round(c["v"][left] @ c["v"][~left].T, 12) >= threshold).any())
        return c["ra"][:hit], c["rb"][:hit]

    members = sides.join(covers.select("leader", "id"), "leader").join(vectors.select("id", "v"), "id")
    members = members.withColumn("p", F.col("a")).withColumn("q", F.col("b"))
    return _joined(comp, _groupwise(members, ["p", "q"], ["ra", "rb", "side", "v"], meet, "a long, b long").distinct())


def _recall(vectors: DataFrame, comp: DataFrame, threshold: float, count: int) -> float:
    """The share of a vector's links that join vectors of one component, averaged
    over vectors chosen by a hash and compared with all others. Vectors of fewer than
    `LONGEST` links and of more are averaged apart, and the lower mean counts, so
    that large groups do not hide small ones. The sample grows with the root of the
    table, and on until `AUDITED` vectors with few links are seen, all vectors, or
    `AUDIT_MOST`; without any link the recall is 1. Only counts leave a task."""
    named = vectors.select("id", "v").join(comp.withColumnRenamed("node", "id"), "id", "left")
    named = stored(named.select("id", "v", F.coalesce("component", "id").alias("component")), "audited")
    size = max(AUDIT, int(np.sqrt(count)))
    while True:
        size = min(size, count, AUDIT_MOST)
        span = 1 << 40
        chosen = named.filter(F.pmod(F.xxhash64("id"), F.lit(span)) < F.lit(-(-span * size // count))).collect()  # a bounded sample
        small = large = np.zeros(0)
        if chosen:
            ids, group = np.array([r["id"] for r in chosen]), np.array([r["component"] for r in chosen])
            q = vectors.sparkSession.sparkContext.broadcast(np.array([r["v"] for r in chosen]))

            def run(parts: Iterator[dict]) -> Iterator[dict]:
                there, hit = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
                for part in parts:
                    if part["id"]:
                        link = np.round(np.array(part["v"]) @ q.value.T, 12) >= threshold
                        link &= np.array(part["id"])[:, None] != ids[None, :]
                        there += link.sum(axis=0)
                        hit += (link & (np.array(part["component"])[:, None] == group[None, :])).sum(axis=0)
                some = np.flatnonzero(there)
                yield {"id": ids[some], "there": there[some], "hit": hit[some]}

            sums = map_batches(named, run, "id long, there long, hit long").groupBy("id").agg(F.sum("there").alias("there"), F.sum("hit").alias("hit")).collect()
            there, share = np.array([r["there"] for r in sums]), np.array([r["hit"] / r["there"] for r in sums])
            small, large = share[there < LONGEST], share[there >= LONGEST]
        if len(small) >= AUDITED or size >= min(count, AUDIT_MOST):
            return float(min(x.mean() if len(x) else 1.0 for x in (small, large)))
        size *= 4


@own_scratch
def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """(key, n_links, component_id, kept) per row of `vectors`: links are pairs of
    cosine at or above the threshold.

    Vectors that are null, zero, or hold null or non-finite components, and rows
    with a null key, are linked with nothing and kept; so are vectors of another length
    than the most frequent one (of equally frequent ones, the shortest). Repeated keys are one vector, the smallest. Other
    columns are ignored. The measured recall, sampled against brute force, has to
    reach `recall` in four descents, otherwise this raises."""
    rows = stored(unit_vectors(vectors, key, vector).groupBy("id").agg(F.min("v").alias("v")), "unit")
    shape = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    out = vectors.select(F.col(key).cast("long").alias("id"))
    if not shape:
        comp, links = None, None
    else:
        usable, named = _collapse(rows.filter(F.size("v") == shape[0]["dim"]))
        graph, count = None, usable.count()
        for round_ in range(4):
            graph = descend(usable, threshold, graph, round_, count, shape[0]["dim"])
            edges = graph.select(F.col("id").alias("a"), F.explode("near").alias("e")).filter(F.col("e.d") <= -threshold)
            edges = stored(edges.select("a", F.col("e.nbr").alias("b")), "links")
            comp = _cross(usable, graph, stored(components(edges), "components"), threshold)
            found = _recall(usable, comp, threshold, count)
            if found >= recall:
                break
        else:
            raise RuntimeError(f"recall {found} of the audited vectors' links")
        links = _count_links(usable, comp, threshold)
    if comp is None:
        return out.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    joined = out.join(named, "id", "left").join(comp, "node", "left").join(links.withColumnRenamed("id", "node"), "node", "left")
    component = F.coalesce("component", "node", "id")
    return joined.select(F.col("id").alias(key), F.coalesce("n_links", F.col("w") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _count_links(vectors: DataFrame, comp: DataFrame, threshold: float) -> DataFrame:
    """(id, n_links): links of every vector inside its component, copies counted,
    over a grid of blocks. A task compares two blocks at most and returns counts."""
    sizes = stored(comp.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "sizes")
    placed = stored(comp.withColumnRenamed("node", "id").join(sizes, "component"), "placed")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    grid = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grid = grid.select("id", "component", "own", F.least("own", "other").alias("row"), F.greatest("own", "other").alias("col"))

    def count(c: dict) -> tuple:
        ids, side, v, w = c["id"], c["own"], c["v"], c["w"]
        if side.min() == side.max():
            near = np.round(v @ v.T, 12) >= threshold
            np.fill_diagonal(near, True)
            hit = near @ w - 1 if c["row"][0] == c["col"][0] else np.zeros(len(ids), np.int64)
            return ids, hit.astype(np.int64)
        left = side == c["row"][0]
        hit = np.round(v[left] @ v[~left].T, 12) >= threshold
        return np.r_[ids[left], ids[~left]], np.r_[hit @ w[~left], w[left] @ hit].astype(np.int64)

    parts = grid.join(vectors, "id").withColumn("r", F.col("row")).withColumn("c", F.col("col"))
    counted = _groupwise(parts, ["component", "r", "c"], ["id", "own", "row", "col", "v", "w"], count, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").cast("long").alias("n_links"))
