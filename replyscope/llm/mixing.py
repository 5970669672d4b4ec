"""Mixing sources to target weights by fitting token budgets.

Documents of a source are counted by exact length. A budget first takes the same
share of every length, rounded down; the largest remainders follow while they fit;
the rest is a bounded subset-sum over the lengths that are left, solved by dynamic
programming. Which documents of a length are taken is decided by a seeded hash of
the document, so a rerun takes the same ones however the table is partitioned."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyscope.llm.common import own_names, stored, word_count
from replyscope.operators.ordering import dense_positions

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
SEED = 7
LARGEST_SUM = 65_536  # remaining budget that dynamic programming solves, or four of the longest document if that is more
GROUP = ["source_null", "source_name"]


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """How many documents of each length to take so that their total length comes
    nearest to the budget that the method finds; at most counts[i] of lengths[i].

    Shares and remainders are taken until a rest is left that several documents of any
    length fit into; dynamic programming always solves that rest whole."""
    room = max(LARGEST_SUM, 4 * int(lengths.max(initial=0)))
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    share = counts * (max(budget, 0.0) / total)
    take = np.floor(share).astype(np.int64)
    take[lengths == 0] = 0
    rest = budget - float((take * lengths).sum())
    for i in np.lexsort((lengths, -(share - take))):  # largest remainders first
        if rest <= room:
            break
        if 0 < lengths[i] <= rest and take[i] < counts[i]:
            take[i] += 1
            rest -= int(lengths[i])
    for i in np.argsort(-lengths, kind="stable"):  # until the rest is small enough to be solved
        if rest <= room:
            break
        if lengths[i] > 0:
            more = min(int(counts[i] - take[i]), int((rest - room) // lengths[i]) + 1)
            take[i] += more
            rest -= more * int(lengths[i])
    extra = subset_sum(lengths, counts - take, int(rest))
    take += extra
    rest -= float((extra * lengths).sum())
    free = np.flatnonzero((take < counts) & (lengths > 0))
    if len(free):
        i = free[lengths[free].argmin()]
        if lengths[i] - rest < rest:
            take[i] += 1
    return take


def subset_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: counts to take so that the total is the largest
    reachable sum up to the budget."""
    take = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return take
    reached = np.full(budget + 1, -1, np.int32)  # the chunk that first reached a sum
    reached[0] = 0
    chunks: list[tuple[int, int]] = [(-1, 0)]
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        if not 0 < length <= budget or reached[budget] >= 0:
            continue
        left, size = min(int(counts[i]), budget // length), 1
        while left > 0:
            size = min(size, left)
            step = size * length
            new = np.flatnonzero((reached[step:] < 0) & (reached[: budget + 1 - step] >= 0)) + step
            reached[new] = len(chunks)
            chunks.append((int(i), size))
            left, size = left - size, size * 2
    at = int(np.flatnonzero(reached >= 0)[-1])
    while at > 0:
        i, size = chunks[reached[at]]
        take[i] += size
        at -= size * int(lengths[i])
    return take


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source_null, source_name, source_size, target). Sources in code-point
    order, null last, get the weights in turn; targets share `share` times the
    total, none above `cap` times its source's size."""
    order = dense_positions(sizes, [F.col("source_null"), F.col("source_name")], "_position")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_position") % len(weights) + 1).cast("int"))
    table = stored(order.select(*GROUP, "source_size", weight.alias("weight")), "sources")
    limit = F.col("source_size") * cap
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * level > limit
        row = table.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("weights"),
            F.count_if(over).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["weights"]:
            break
        capped, level = row["capped"], (share * float(row["all"] or 0) - row["fixed"]) / row["weights"]
    return table.select(*GROUP, "source_size", F.least(F.col("weight") * level, limit).alias("target"))


def mix_plan(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """One row per row of `docs`: (key, row_a, row_b, size, source_size, target,
    copies). `size` is the number of words (null text: 0), `copies` how often the
    mix takes the document (0 to cap, rounded up). A source whose target exceeds
    its size is taken whole, and again up to the rest. Documents without words are
    never taken. Repeated rows are documents of their own; which of them is taken
    makes no difference. Null keys are ordinary values, null sources are one source.
    `row_a`, `row_b` identify the whole row (all columns) for joining back."""
    row_a, row_b = row_identity(docs)
    light = docs.select(
        F.col(key).alias("key"), F.col(source).isNull().alias("source_null"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source_name"),
        word_count(text).alias("size"), row_a.alias("row_a"), row_b.alias("row_b"), F.xxhash64(F.lit(seed), F.col(key)).alias("mark"),
    )
    light = stored(light, "sizes")
    histogram = stored(light.groupBy(*GROUP, "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    sizes = histogram.groupBy(*GROUP).agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    goal = stored(targets(sizes, weights, share, cap), "targets")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        lengths, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
        order = np.argsort(lengths, kind="stable")
        whole, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        rounds = int(target // whole) if whole else 0
        take = np.zeros(len(lengths), np.int64)
        take[order] = fit_budget(lengths[order], counts[order], target - rounds * whole) if whole else 0
        return group.assign(rounds=rounds, take=take)[[*GROUP, "size", "n", "source_size", "target", "rounds", "take"]]

    schema = "source_null boolean, source_name string, size long, n long, source_size long, target double, rounds long, take long"
    choice = stored(histogram.join(goal, GROUP).groupBy(*GROUP).applyInPandas(fit, schema), "choice")
    chosen = light.join(choice, [*GROUP, "size"]).withColumn("range", F.shiftrightunsigned("mark", 54))
    chosen = stored(chosen, "chosen")
    open_ = (F.col("take") > 0) & (F.col("take") < F.col("n"))
    some = chosen.filter(open_)
    by_range = some.groupBy(*GROUP, "size", "range").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.partitionBy(*GROUP, "size").orderBy("range")) - F.col("c")
    by_range = stored(by_range.select(*GROUP, "size", "range", before.alias("before")), "ranges")
    rank = F.row_number().over(Window.partitionBy(*GROUP, "size", "range").orderBy("mark", "key", "row_a", "row_b"))
    # Both sides are needed by these keys, so a merge moves nothing twice; ranges grow with the documents and are not broadcast.
    some = some.join(by_range.hint("merge"), [*GROUP, "size", "range"]).withColumn("again", (F.col("before") + rank <= F.col("take")).cast("long"))
    rest = chosen.filter(~open_).withColumn("again", (F.col("take") > 0).cast("long"))
    columns = ["key", "row_a", "row_b", "size", "source_size", "target", "rounds", "again"]
    both = some.select(*columns).unionByName(rest.select(*columns))
    copies = F.when(F.col("size") > 0, F.col("rounds") + F.col("again")).otherwise(0)
    return both.select(F.col("key").alias(key), "row_a", "row_b", "size", "source_size", "target", copies.cast("long").alias("copies"))


@own_names()
def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The mixed documents: rows of `docs`, all columns whatever their names, each as
    often as the plan takes it."""
    row_a, row_b = row_identity(docs)
    plan = mix_plan(docs, weights, share, cap, seed, key, source, text)
    total = plan.groupBy("row_a", "row_b").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    total = stored(total.filter("_copies > 0"), "copies")
    marked = docs.withColumn("row_a", row_a).withColumn("row_b", row_b).join(total, ["row_a", "row_b"])
    even = F.col("_copies") % F.col("_rows") == 0
    each = marked.filter(even).withColumn("_copies", (F.col("_copies") / F.col("_rows")).cast("long"))
    once = marked.filter(~even).dropDuplicates(["row_a", "row_b"])  # repeated rows whose copies don't divide evenly
    repeated = each.unionByName(once).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*docs.columns)


def row_identity(docs: DataFrame) -> tuple[Column, Column]:
    """128 bits that identify the content of a row, nulls included."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in docs.columns])
    return F.xxhash64(nulls, *docs.columns), F.xxhash64(F.lit("row"), nulls, *docs.columns)
