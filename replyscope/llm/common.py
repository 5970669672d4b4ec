"""Words, hashes and tables shared by the corpus operators.

A word is a run of bytes other than space and \\t\\n\\v\\f\\r; `bytes.split()`
cuts exactly there, and no UTF-8 sequence contains those bytes."""

from __future__ import annotations

import functools
import inspect
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyscope.session import cut_lineage as stored
from replyscope.session import own_scratch

WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 128  # rows that are Python objects at the same time
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted
_INVERSE = pow(_BASE, -1, 1 << 64)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def map_batches(df: DataFrame, fn: Callable[[Iterator[dict]], Iterable[dict]], schema: str) -> DataFrame:
    """mapInArrow with plain columns: `fn` gets dicts of Python lists and yields
    dicts of lists or arrays, one per output batch, in the order of `schema`. Spark
    bounds the bytes of a batch; here it is cut into few rows, since texts may be long."""
    fields = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (small.to_pydict() for batch in batches for small in _cut(batch))
        for out in fn(parts):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, fields)


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, BATCH_ROWS):
        yield batch.slice(at, BATCH_ROWS)


def own_names(*replaced: str) -> Callable:
    """For operators that give the columns of their first argument back: under way
    all of these have names of their own, so that no column clashes with one that the
    operator makes. Columns `replaced` are dropped first; options that name a column
    still find it."""

    def wrap(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        signature = inspect.signature(fn)

        @functools.wraps(fn)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            given = signature.bind(docs, *args, **options)
            given.apply_defaults()
            named = {v for v in given.arguments.values() if isinstance(v, str)}
            docs = docs.drop(*[c for c in docs.columns if c in replaced and c not in named])
            plain = {c: f"column {i}" for i, c in enumerate(docs.columns)}
            for option, value in given.arguments.items():
                if isinstance(value, str):
                    given.arguments[option] = plain.get(value, value)
            given.arguments[next(iter(signature.parameters))] = docs.toDF(*plain.values())
            out = fn(*given.args, **given.kwargs)
            back = {new: c for c, new in plain.items()}
            return out.toDF(*[back.get(c, c) for c in out.columns])

        return run

    return wrap


def as_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text column; they cross to Python without decoding."""
    return F.col(text).cast("string").cast("binary")


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo `modulus`; null keys count as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def split_words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of `size` values, in one pass for any size."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up = np.cumprod(np.full(len(hashes), _BASE, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
    down = np.cumprod(np.full(n, _INVERSE, np.uint64))
    return mix((sums[size:] - sums[:n]) * down)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of n words lie in a window of `size` words that starts at one of `starts`."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:n]) > 0
