"""Packing of token sequences by length patterns.

Only the histogram of lengths decides (Krell and others, "Efficient Sequence
Packing without Cross-contamination", 2021): patterns of at most four length
classes that fill a sequence are enumerated, non-negative least squares gives how
often each is used, and the rounded-down counts are packed. What remains, and the
space that patterns leave, is filled best-fit, largest length first. The histogram
has one number per length, whatever the number of documents; afterwards every
piece finds its place from its length and its rank among equal lengths."""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.llm.common import map_batches, stored

MAX_TOKENS = 2048
CLASSES = 64  # length classes of the pattern search
DEPTH = 4  # documents in a pattern
END = 0  # id behind every document
#: A run of blanks that the splitting pattern of `tiktoken` may give up on.
_LONG_GAP = re.compile(r"\s{1000}")
SPREAD = 1024  # hash ranges that equal lengths are dealt over to be ranked


@lru_cache(maxsize=2)
def encoder(ranks_file: str):
    """Byte-level BPE of a rank file, with the added tokens of the `tokenizers` file
    beside it, if there is one; one per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    added, beside = {}, os.path.splitext(ranks_file)[0] + ".json"
    if os.path.exists(beside):
        with open(beside, "rb") as source:
            tokens = json.load(source)["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
            raise ValueError(f"{beside}: added tokens that look at their neighbours")
        added = {t["content"]: t["id"] for t in tokens}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


@lru_cache(maxsize=2)
def tokenizer(ranks_file: str):
    """The `tokenizers` file beside a rank file."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(os.path.splitext(ranks_file)[0] + ".json")


def token_ids(text: str, ranks_file: str) -> list[int]:
    """Ids of `tokenizers` with the file beside `ranks_file`. `tiktoken` finds the
    same ones several times faster, but for texts with long runs of blanks, which its
    pattern walks back over; these go to `tokenizers` itself."""
    if _LONG_GAP.search(text):
        return tokenizer(ranks_file).encode(text, add_special_tokens=False).ids
    return encoder(ranks_file).encode(text, allowed_special="all")


def pieces(docs: DataFrame, ranks_file: str, max_tokens: int = MAX_TOKENS, keep_ids: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): every document's token ids
    and the end id, cut into pieces of `max_tokens` counted from the end, so that
    only the first piece is shorter. Ids are those of `tokenizers`: an added token
    such as <|endoftext|> in a text is one id. A null text is an empty one: the end id alone.
    Repeated rows and null keys are documents of their own. `ids_crc32` is the
    unsigned crc32 of the piece's ids as little-endian 32-bit numbers."""

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            out = defaultdict(list)
            for name, body in zip(part["key"], part["text"]):
                ids = np.array([*token_ids(body or "", ranks_file), END], "<u4")
                start, piece = 0, 0
                while start < len(ids):
                    stop = len(ids) - (len(ids) - start - 1) // max_tokens * max_tokens
                    cut = ids[start:stop]
                    row = (name, piece, start, len(cut), zlib.crc32(cut.tobytes()), cut.astype(np.int32))
                    for column, value in zip(("key", "piece", "start", "length", "ids_crc32", "ids"), row):
                        out[column].append(value)
                    start, piece = stop, piece + 1
            if out:
                yield out

    schema = "key long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return map_batches(docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")), run, schema)


def patterns(classes: int = CLASSES, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All multisets of at most `depth` length classes that sum to `classes`,
    largest first."""
    found: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], rest: int, largest: int) -> None:
        if rest == 0:
            found.append(head)
        elif len(head) < depth:
            for part in range(min(rest, largest), 0, -1):
                extend((*head, part), rest - part, part)

    extend((), classes, classes)
    return found


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by the active-set method of Lawson and Hanson."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(3 * a.shape[0]):
        slope = a.T @ (b - a @ x)
        slope[used] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        used[best] = True
        while True:
            trial = np.zeros_like(x)
            trial[used] = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            negative = used & (trial <= 0)
            if not negative.any():
                x = trial
                break
            step = (x[negative] / np.maximum(x[negative] - trial[negative], 1e-300)).min()
            x = x + step * (trial - x)
            used &= x > 1e-12
            x[~used] = 0
    return x


def pack_histogram(counts: np.ndarray, max_tokens: int = MAX_TOKENS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of the sequences that hold counts[length] pieces of
    every length up to `max_tokens`.

    A pattern's classes name its pieces, the largest of each class first; its last
    piece is the longest that still fits, so that a class need not be full."""
    left = counts.astype(np.int64).copy()
    width = -(-max_tokens // CLASSES)
    kinds = -(-np.arange(len(left)) // width)
    top = -(-max_tokens // width)
    shapes = patterns(top)
    matrix = np.zeros((top, len(shapes)))
    for column, shape in enumerate(shapes):
        for kind in shape:
            matrix[kind - 1, column] += 1
    target = np.bincount(kinds, weights=left, minlength=top + 1)[1:]
    repeats = np.floor(nonnegative_least_squares(matrix, target) + 1e-6).astype(np.int64)
    by_space: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)

    def put(lengths: tuple[int, ...], times: int) -> None:
        by_space[max_tokens - sum(lengths)].append((lengths, times))

    for shape, times in zip(shapes, repeats):
        while times > 0:
            need: dict[int, int] = defaultdict(int)
            space = max_tokens
            for part, kind in enumerate(shape):
                upper = space if part == len(shape) - 1 else min(space, kind * width)
                length = next((n for n in range(upper, (kind - 1) * width, -1) if left[n] > need[n]), 0)
                if not length:
                    break
                need[length] += 1
                space -= length
            if not length:
                break  # too few pieces of a class are left: they go to the residual
            need = {n: k for n, k in need.items() if k}
            take = min(times, *(int(left[n]) // k for n, k in need.items()))
            for n, k in need.items():
                left[n] -= take * k
            put(tuple(n for n, k in need.items() for _ in range(k)), take)
            times -= take
    for length in range(max_tokens, 0, -1):
        n = int(left[length])
        while n > 0:
            space = min((s for s, open_ in by_space.items() if s >= length and open_), default=None)
            if space is None:
                fit = max_tokens // length
                if n >= fit:
                    put((length,) * fit, n // fit)
                if n % fit:
                    put((length,) * (n % fit), 1)
                break
            lengths, times = by_space[space].pop()
            take = min(n, times)
            if take < times:
                by_space[space].append((lengths, times - take))
            put((*lengths, length), take)
            n -= take
    merged: dict[tuple[int, ...], int] = defaultdict(int)
    for entries in by_space.values():
        for lengths, times in entries:
            merged[lengths] += times
    return sorted(merged.items(), reverse=True)


def pack(pieces_table: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The pieces with sequence_id and offset. Every sequence holds at most
    `max_tokens` tokens and its pieces follow each other without gaps from 0. An
    empty table gives an empty one; columns other than key, piece, start and length
    go through unchanged.

    Rank within a length: lengths are dealt over hash ranges, the ranges' counts
    give each range its first rank, and rows are numbered inside a range only."""
    table = stored(pieces_table, "pieces")
    mark = F.xxhash64("key", "piece", "start", "length")
    table = table.withColumn("_mark", mark).withColumn("_range", F.pmod("_mark", F.lit(SPREAD)))
    counts = stored(table.groupBy("length", "_range").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = np.zeros(max_tokens + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        histogram[row["length"]] = row["n"]
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_range")) - F.col("n")
    ranges = stored(counts.select("length", "_range", before.alias("_before")), "ranges")
    slots = _slots(pack_histogram(histogram, max_tokens))
    within = F.row_number().over(Window.partitionBy("length", "_range").orderBy("_mark", "key", "piece", "start"))
    ranked = table.join(ranges, ["length", "_range"]).withColumn("_rank", F.col("_before") + within - 1)
    kept = pieces_table.columns

    def place(parts: Iterator[dict]) -> Iterator[dict]:
        codes, first, base, offsets = slots
        for part in parts:
            length, rank = np.array(part["length"], np.int64), np.array(part["_rank"], np.int64)
            at = np.searchsorted(codes, (length << 44) + rank, side="right") - 1
            yield {c: part[c] for c in kept} | {"sequence_id": base[at] + rank - first[at], "offset": offsets[at]}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces_table.schema) + ", sequence_id long, offset long"
    return map_batches(ranked.select(*kept, "_rank"), place, schema)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Per (length, first rank): the first rank, the id of the first sequence and
    the offset in it, ordered by (length, rank). Its size depends on the number of
    lengths, not on the number of pieces."""
    used: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], base, offset))
            used[length] += times
            offset += length
        base += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return (table[:, 0] << 44) + table[:, 1], table[:, 1], table[:, 2], table[:, 3]


def pack_documents(docs: DataFrame, ranks_file: str, max_tokens: int = MAX_TOKENS, keep_ids: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenises and packs whole documents; see `pieces` and `pack`."""
    out = pack(pieces(docs, ranks_file, max_tokens, keep_ids, key, text), max_tokens)
    return out.withColumnRenamed("key", key)
