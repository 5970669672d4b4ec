"""Exact 'first n rows in an order' without sorting or moving the rows.

A sampling or time order is expressed as one fixed-width text key. The n-th
smallest key is found by counting key prefixes level by level (a radix
selection: each level is one grouped count of at most 4,096 groups), and the
answer is then a plain filter on the key. No task ever receives more than the
small last bucket, whatever the distribution of the keys."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyscope.session import cut_lineage

STEP = 3  # hexadecimal digits per level
LAST_BUCKET = 10_000  # rows that may be sorted in one task
SMALL_N = 10_000  # up to here a plain ordered limit is cheaper


def md5_key(seed: int | str, *keys: Column) -> Column:
    """Pseudo-random order of rows that depends only on the seed and the key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws(":", *[k.cast("string") for k in keys])))


def time_key(timestamp: Column, tie: Column) -> Column:
    """Order by time with missing times last; equal times in the order of the
    hashed tie column."""
    micros = F.lpad(F.hex(F.unix_micros(timestamp.cast("timestamp")) + F.lit(1 << 62)), 16, "0")
    return F.concat(F.coalesce(micros, F.lit("f" * 16)), F.md5(tie.cast("string")))


def order_cut(df: DataFrame, key: Column, n: int) -> tuple[str, int] | None:
    """The n-th smallest key and how many rows with exactly this key are within
    the first n. None if there are no more than n rows."""
    keys = df.select(F.lower(key).alias("k")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        low, high, total = keys.agg(F.min("k"), F.max("k"), F.count("k")).first()
        if n >= total:
            return None
        prefix, below, size = _common_prefix(low, high), 0, total
        while size > LAST_BUCKET and len(prefix) < len(low):
            length = min(len(low), len(prefix) + STEP)
            counts = (
                keys.filter(F.col("k").startswith(prefix))
                .groupBy(F.substring("k", 1, length).alias("p"))
                .count()
            )
            upto = counts.withColumn("upto", F.sum("count").over(Window.orderBy("p")))
            row = upto.filter(F.col("upto") >= n - below).orderBy("p").first()
            prefix, size = row["p"], row["count"]
            below += row["upto"] - row["count"]
        inside = keys.filter(F.col("k").startswith(prefix))
        if size > LAST_BUCKET:  # a single key repeated many times
            return prefix, n - below
        cut = inside.orderBy("k").limit(n - below).agg(F.max("k")).first()[0]
        smaller = inside.filter(F.col("k") < cut).count()
        return cut, n - below - smaller
    finally:
        keys.unpersist()


def _common_prefix(low: str, high: str) -> str:
    length = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), len(low))
    return low[:length]


def split_at(df: DataFrame, key: Column, n: int) -> tuple[DataFrame, DataFrame]:
    """The first n rows in key order, and the others. Rows with an equal key at
    the cut are ordered by the hash of their content; rows equal in everything
    are interchangeable."""
    if n <= 0:
        return df.limit(0), df
    cut = order_cut(df, key, n)
    if cut is None:
        return df, df.limit(0)
    value, take = cut
    key = F.lower(key)
    at_cut = df.filter(key == value)
    size = at_cut.count()
    if size == take:
        return df.filter(key <= value), df.filter(key > value)
    content = _content(df)
    low, high = at_cut.agg(F.min(content), F.max(content)).first()
    if low == high:
        inside, outside = at_cut.limit(take), at_cut.limit(size - take)
    else:
        inside, outside = split_at(at_cut, content, take)
    return df.filter(key < value).unionByName(inside), df.filter(key > value).unionByName(outside)


def _content(df: DataFrame) -> Column:
    """Order of rows with an equal key: rows equal in this are equal in everything."""
    return F.md5(F.to_json(F.struct(*df.columns)))


def first_n(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The first n rows in key order; lazy for small n."""
    if n <= SMALL_N:
        return df.orderBy(F.lower(key), _content(df)).limit(max(n, 0))
    return split_at(df, key, n)[0]


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows of every group. Groups may be arbitrarily large: up to 1,000
    rows Spark itself cuts every group before the shuffle; beyond that rows are
    first cut per group and salt, in parallel."""
    final = Window.partitionBy(*group).orderBy(*order)
    if k > 1_000:
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(64)))
        local = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = df.withColumn(rank, F.row_number().over(local)).filter(F.col(rank) <= k).drop("_salt")
    return df.withColumn(rank, F.row_number().over(final)).filter(F.col(rank) <= k)


def dense_positions(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`df` with the 0-based position of every row in a total order."""
    counted = running_total(df.withColumn("_one", F.lit(1).cast("long")), order, "_one", name)
    return counted.withColumn(name, F.col(name) - 1).drop("_one")


def running_total(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """`df` with the sum of `value` over all rows up to this one in a total order.

    The rows are range-partitioned and summed inside their partition; one number
    for each partition gives the offsets. No task sees more than its range."""
    sorted_ = cut_lineage(df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id()))
    sorted_ = sorted_.withColumn("_part", F.shiftright("_mark", 33))
    sums = sorted_.groupBy("_part").agg(F.sum(value).alias("s")).orderBy("_part").collect()  # one row per partition
    offsets, before = [], 0
    for row in sums:
        offsets.append((row["_part"], before))
        before += row["s"] or 0
    small = df.sparkSession.createDataFrame(offsets, "_part long, _before long")
    inside = F.sum(value).over(Window.partitionBy("_part").orderBy("_mark"))
    placed = sorted_.withColumn("_inside", inside).join(F.broadcast(small), "_part")
    return placed.withColumn(name, F.col("_before") + F.col("_inside")).drop("_mark", "_part", "_before", "_inside")
