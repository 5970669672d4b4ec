"""Repeatable sampling: rows are ordered by the md5 of seed and key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyscope.constants import BUCKETS
from replyscope.functions.text import has_any_lowered
from replyscope.operators.ordering import first_n, md5_key, split_at, top_per_group
from replyscope.session import cut_lineage


def hash_sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly n rows (all if there are fewer), without replacement."""
    return first_n(df, md5_key(seed, F.col(key)), n)


def hash_shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Reproducible permutation; a range-partitioned sort for the sink."""
    return df.orderBy(md5_key(seed, F.col(key)), key)


def random_split(df: DataFrame, key: str, test_ratio: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a threshold on the hash: one filter each, no shuffle.
    The test share is the ratio in expectation."""
    bucket = F.conv(F.substring(md5_key(seed, F.col(key)), 1, 8), 16, 10).cast("long")
    is_test = bucket < int(test_ratio * (1 << 32))
    return df.filter(~is_test), df.filter(is_test)


def exact_split(df: DataFrame, key: str, test_n: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) with an exact number of test rows."""
    test, train = split_at(df, md5_key(seed, F.col(key)), test_n)
    return train, test


def sample_remainder(df: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been taken yet."""
    return df.join(taken.select(key).distinct(), key, "left_anti")


exclude_existing = sample_remainder


def distinct_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row per key in the given order; copies shrink before the shuffle."""
    return top_per_group(df, [key], [F.col(c) for c in order], 1, "_first").drop("_first")


def stratified_sample(
    threads: DataFrame,
    n: int,
    key: str = "tweet_id",
    text: str = "inbound_text",
    buckets: dict[str, list[str]] = BUCKETS,
    seed: int = 42,
) -> DataFrame:
    """60% uniform, the rest spread over keyword buckets, then filled up.

    Ranks are decided on a narrow table (key, bucket flags) that is written for
    the few passes; whole rows are fetched once at the end. Rows that share a key
    are rows of their own, told apart by their content."""
    source, given = threads, key
    copy = F.row_number().over(Window.partitionBy(given).orderBy(F.md5(F.to_json(F.struct(*threads.columns)))))
    threads = threads.withColumn("_copy", copy)
    key = "_row"
    threads = threads.withColumn(key, F.when(F.col("_copy") == 1, F.col(given).cast("string")).otherwise(F.concat_ws("#", F.col(given), "_copy"))).drop("_copy")
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    names = list(buckets)
    matched = F.filter(
        F.array(*[F.when(has_any_lowered(lowered, buckets[b]), F.lit(i)) for i, b in enumerate(names)]),
        lambda b: b.isNotNull(),
    )
    narrow = threads.select(F.col(key), matched.alias("_buckets"))
    narrow = cut_lineage(narrow)

    def pick(df: DataFrame, count: int, pick_seed: int) -> DataFrame:
        return first_n(df, md5_key(pick_seed, F.col(key)), count)

    n_random = int(n * 0.6)
    n_bucket = n - n_random
    per_bucket = max(1, n_bucket // len(names))
    uniform = pick(narrow, n_random, seed)
    rest = sample_remainder(narrow, uniform, key)
    exploded = rest.select(key, F.explode("_buckets").alias("_bucket")).withColumn("_h", md5_key(seed, F.col(key)))
    boosted = top_per_group(exploded, ["_bucket"], [F.col("_h"), F.col(key)], per_bucket, "_rank")
    boosted = boosted.groupBy(key).agg(F.min(F.struct("_bucket", "_rank")).alias("_at"))
    fill_1 = sample_remainder(rest, boosted, key)
    # Quota left in the boosted part, and after that in the whole sample.
    need_1 = n_bucket - boosted.count()
    parts = [
        uniform.select(key, F.lit(0).alias("_part"), F.lit(0).alias("_bucket"), md5_key(seed, F.col(key)).alias("_h")),
        boosted.select(key, F.lit(1).alias("_part"), F.col("_at._bucket"), md5_key(seed, F.col(key)).alias("_h")),
    ]
    if need_1 > 0:
        parts.append(
            pick(fill_1, need_1, 1).select(
                key, F.lit(2).alias("_part"), F.lit(0).alias("_bucket"), md5_key(1, F.col(key)).alias("_h")
            )
        )
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    place = F.concat_ws(":", F.lpad("_part", 2, "0"), F.lpad("_bucket", 8, "0"), "_h")
    chosen = first_n(chosen, place, n).select(key)
    return threads.join(F.broadcast(chosen) if n <= 100_000 else chosen, key, "left_semi").select(*source.columns)


def cap_majority(
    golden: DataFrame, n: int, classes: list[str], cap: int, key: str = "tweet_id", label: str = "intent", seed: int = 42
) -> DataFrame:
    """While there are more than n rows, trim the named classes in order down
    to the cap, then trim at random. Only per-class counts reach the driver."""
    counts = {r[label]: r["count"] for r in golden.groupBy(label).count().collect()}
    total = sum(counts.values())
    kept = golden
    for name in classes:
        drop = min(max(counts.get(name, 0) - cap, 0), max(total - n, 0))
        if drop > 0:
            inside = golden.filter(F.col(label) == name)
            stay = first_n(inside, md5_key(seed, F.col(key)), counts[name] - drop)
            kept = kept.filter(F.col(label) != name).unionByName(stay)
            total -= drop
    return first_n(kept, md5_key(seed, F.col(key)), n) if total > n else kept


def topup_per_class(
    golden: DataFrame,
    pool: DataFrame,
    classes: list[str],
    min_per_class: int = 15,
    key: str = "tweet_id",
    label: str = "intent",
    predicted: str = "pred_intent",
    seed: int = 42,
) -> DataFrame:
    """Rows of the pool that lift rare classes to the minimum."""
    counts = {r[label]: r["count"] for r in golden.groupBy(label).count().collect()}
    needs = {c: min_per_class - counts.get(c, 0) for c in classes if counts.get(c, 0) < min_per_class}
    if not needs:
        return pool.limit(0)
    need = F.create_map(*[F.lit(v) for item in needs.items() for v in item])
    fresh = exclude_existing(pool.filter(F.col(predicted).isin(list(needs))), golden, key)
    ranked = top_per_group(
        fresh.withColumn("_h", md5_key(seed, F.col(key))), [predicted], [F.col("_h"), F.col(key)], min_per_class, "_rank"
    )
    return ranked.filter(F.col("_rank") <= need[F.col(predicted)]).drop("_h", "_rank")


def fill_to_n(
    golden: DataFrame, pool: DataFrame, n: int, keep: Column, key: str = "tweet_id", seed: int = 1
) -> DataFrame:
    """New rows that fill the set to n: twice the need is sampled, rows passing
    the language test are kept, and the first of them are taken."""
    need = n - golden.count()
    if need <= 0:
        return pool.limit(0)
    drawn = first_n(exclude_existing(pool, golden, key), md5_key(seed, F.col(key)), 2 * need)
    return first_n(drawn.filter(keep), md5_key(seed, F.col(key)), need)
