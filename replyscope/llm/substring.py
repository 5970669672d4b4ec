"""Repeated passages by prefix-partitioned suffix trees, truncated at `window` words.

A window (a suffix cut to 50 words) is filed under the prefix group that its text
decides: of its 41 runs of ten words the one with the smallest hash. Equal windows
are in the same group, and neighbouring windows mostly share a group, so that one
row stands for the about twenty suffixes of a span. Groups that one document alone
fills are done. Spans that are repeated word for word are settled by their smallest
document. Only groups with several different spans need a tree: each span comes
once, a task takes whole groups up to its memory, sorts their suffixes and reads
off the inner nodes at full depth, whose leaves are the occurrences of a repeat.
A group with too many spans for a task is divided: its windows are filed again under
prefixes of twice the length, until every group fits one or the prefix is the window.

Adjacent nodes of a document join into maximal repeats, which are removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import as_bytes, map_batches, mix, own_names, own_scratch, signed, split_words, stored, window_hashes, word_hashes

WINDOW = 50
PREFIX = 10  # words that a group is named by
GROUP = 3_000  # different spans of one group that one tree takes: at most 50 MB of suffixes
_ODD = 0xD6E8FEB86659FD93
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


def spans(hashes: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, ...]:
    """Group, content hash, first window and number of windows of the spans of a
    text: maximal runs of windows that share the place of their smallest run."""
    if len(hashes) < window:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    runs = window_hashes(hashes, prefix)
    width = window - prefix + 1
    place = sliding_window_view(runs, width).argmin(axis=1) + np.arange(len(runs) - width + 1)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    count = np.diff(np.r_[first, len(place)])
    up = np.cumprod(np.full(len(hashes), _ODD, np.uint64))
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)]
    down = np.cumprod(np.full(len(hashes), _ODD_INVERSE, np.uint64))
    content = mix((sums[first + count - 1 + window] - sums[first]) * down[first] + count.astype(np.uint64))
    return runs[place[first]], content, first, count


def _all_spans(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            found = [spans(word_hashes(split_words(body)), window, prefix) for body in part["text"]]
            if found:
                group, content, first, count = (np.concatenate(column) for column in zip(*found))
                doc, print_ = (np.repeat(np.array(part[c], np.int64), [len(f[0]) for f in found]) for c in ("doc", "print"))
                yield {"prefix": signed(group), "content": signed(content), "doc": doc, "print": print_, "first": first, "count": count}

    return map_batches(docs, run, "prefix long, content long, doc long, print long, first int, count int")


def deep_nodes(group: np.ndarray, low: np.ndarray, words: list[np.ndarray], window: int) -> list[np.ndarray]:
    """For every span the suffixes (offsets) that also start in a span with a
    smaller document: the suffixes of all spans, led by their group, are sorted,
    and neighbours that agree in all words are leaves of one node."""
    counts = np.array([len(w) - window + 1 for w in words])
    owner = np.repeat(np.arange(len(words)), counts)
    rows = np.empty((len(owner), window + 1), np.int64)
    rows[:, 0] = group[owner]
    np.concatenate([sliding_window_view(w, window) for w in words], out=rows[:, 1:])
    order = rows.view(f"V{8 * (window + 1)}").ravel().argsort(kind="stable")
    ordered = rows[order]
    starts = np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)])
    least = np.minimum.reduceat(low[owner][order], starts)
    smallest = np.empty(len(owner), np.int64)
    smallest[order] = np.repeat(least, np.diff(np.r_[starts, len(order)]))
    again = np.split(smallest < low[owner], np.cumsum(counts)[:-1])
    return [np.flatnonzero(flags).astype(np.int32) for flags in again]


@own_scratch
def repeated_windows(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """(doc, print, from, to): word ranges covered by windows of `docs` (doc, text)
    that also start in a document with a smaller id. Rows with a null id take no part.
    Rows may share an id: `print`, the hash of the text, tells them apart."""
    docs = docs.filter("doc IS NOT NULL").withColumn("print", F.xxhash64("text"))
    table = stored(_all_spans(docs, window, prefix), "spans")
    live = table.groupBy("prefix").agg(F.min("doc").alias("d1"), F.max("doc").alias("d2"), F.min("content").alias("c1"), F.max("content").alias("c2"))
    live = stored(live.filter("d1 <> d2").select("prefix", (F.col("c1") != F.col("c2")).alias("several")), "groups")
    shared = stored(table.join(live, "prefix"), "shared")
    whole = shared.groupBy("prefix", "content").agg(
        F.min("doc").alias("low"), F.min_by(F.struct("first", "print"), "doc").alias("at"), F.first("count").alias("n"), F.first("several").alias("several")
    )
    whole = stored(whole, "contents")
    sizes = stored(whole.filter("several").groupBy("prefix").agg(F.count(F.lit(1)).alias("size")), "sizes")
    wanted = whole.filter("several").join(sizes, "prefix").select("prefix", "content", "low", "at.print", "at.first", "n", (F.col("size") > group).alias("large"))
    per_doc = wanted.groupBy(F.col("low").alias("doc"), "print").agg(F.collect_list(F.struct("prefix", "content", "first", "n", "large")).alias("items"))
    once = docs.dropDuplicates(["doc", "print"])
    texts = stored(_span_words(once.join(per_doc, ["doc", "print"]), window), "suffixes")
    ranges = stored(_trees(texts, window, prefix, group), "ranges")
    copies = shared.join(whole.select("prefix", "content", "low"), ["prefix", "content"])
    later = copies.filter("doc > low").select("doc", "print", F.col("first").alias("from"), (F.col("first") + F.col("count") + (window - 1)).alias("to"))
    own = copies.filter("doc = low").join(ranges, ["prefix", "content"]).select("doc", "print", "first", F.explode("starts").alias("s"))
    own = own.select("doc", "print", (F.col("first") + F.col("s")).alias("from"), (F.col("first") + F.col("s") + window).alias("to"))
    return later.unionByName(own)


def _span_words(docs: DataFrame, window: int) -> DataFrame:
    """(prefix, content, low, large, words): the word hashes of the wanted spans."""

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            out = {c: [] for c in ("prefix", "content", "low", "large", "words")}
            for doc, body, items in zip(part["doc"], part["text"], part["items"]):
                hashes = signed(word_hashes(split_words(body)))
                for item in items:
                    words = hashes[item["first"] : item["first"] + item["n"] - 1 + window]
                    for c, value in zip(out, (item["prefix"], item["content"], doc, item["large"], words)):
                        out[c].append(value)
            yield out

    return map_batches(docs.select("doc", "text", "items"), run, "prefix long, content long, low long, large boolean, words array<long>")


def _small_groups(rows: DataFrame, window: int, group: int) -> DataFrame:
    """(prefix, content, starts) from trees over whole groups of a task."""

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        names = ("prefix", "content", "low", "words")
        held: list[tuple] = []
        for part in parts:
            held += zip(*(part[c] for c in names))
            if len(held) >= group:
                last = next((i for i in range(len(held) - 1, 0, -1) if held[i][0] != held[i - 1][0]), 0)
                if last:
                    yield tree(held[:last])
                    held = held[last:]
        if held:
            yield tree(held)

    def tree(held: list[tuple]) -> dict:
        prefix, content, low, words = zip(*held)
        found = deep_nodes(np.array(prefix, np.int64), np.array(low, np.int64), [np.array(w, np.int64) for w in words], window)
        keep = [i for i, offsets in enumerate(found) if len(offsets)]
        return {
            "prefix": [prefix[i] for i in keep],
            "content": [content[i] for i in keep],
            "starts": [found[i] for i in keep],
        }

    dealt = rows.select("prefix", "content", "low", "words").repartition(F.col("prefix")).sortWithinPartitions("prefix")
    return map_batches(dealt, run, "prefix long, content long, starts array<int>")


def _divided(texts: DataFrame, window: int, prefix: int, group: int) -> DataFrame:
    """(prefix, content, starts) of groups that are too large for a tree: the windows
    of their spans are filed under prefixes of twice the length, up to the whole window,
    where equal windows are equal spans and no tree is needed. `texts` has the spans'
    words; a span stands for the document that it is settled for, `low`."""
    longer = min(window, 2 * prefix)

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            found = [spans(np.array(words, np.int64).view(np.uint64), window, longer) for words in part["words"]]
            if found:
                sub, same, first, count = (np.concatenate(column) for column in zip(*found))
                each = [len(f[0]) for f in found]
                out = {c: np.repeat(np.array(part[c], np.int64), each) for c in ("prefix", "content", "low")}
                yield out | {"sub": signed(sub), "same": signed(same), "first": first, "count": count}

    schema = "prefix long, content long, low long, sub long, same long, first int, count int"
    table = stored(map_batches(texts.select("prefix", "content", "low", "words"), run, schema), "longer")
    live = table.groupBy("sub").agg(F.min("low").alias("d1"), F.max("low").alias("d2"), F.min("same").alias("c1"), F.max("same").alias("c2"))
    live = stored(live.filter("d1 <> d2").select("sub", (F.col("c1") != F.col("c2")).alias("several")), "groups")
    shared = stored(table.join(live, "sub"), "shared")
    whole = shared.groupBy("sub", "same").agg(
        F.min("low").alias("least"), F.min_by(F.struct("prefix", "content", "first"), "low").alias("at"), F.first("count").alias("n"), F.first("several").alias("several")
    )
    whole = stored(whole, "contents")
    copies = shared.join(whole.select("sub", "same", "least"), ["sub", "same"])
    repeated = copies.filter("low > least").select("prefix", "content", F.sequence("first", F.col("first") + F.col("count") - 1).alias("starts"))
    several = stored(whole.filter("several"), "several")
    if not several.isEmpty():
        sizes = several.groupBy("sub").agg((F.count(F.lit(1)) > group).alias("large"))
        wanted = several.join(stored(sizes, "sizes"), "sub").select("sub", "same", "least", "at.*", "n", "large")
        inner = wanted.join(texts.select("prefix", "content", "words"), ["prefix", "content"]).select(
            F.col("sub").alias("prefix"), F.col("same").alias("content"), F.col("least").alias("low"), "large",
            F.slice("words", F.col("first") + 1, F.col("n") + (window - 1)).alias("words"),
        )
        found = _trees(stored(inner, "suffixes"), window, longer, group)
        found = found.select(F.col("prefix").alias("sub"), F.col("content").alias("same"), F.col("starts").alias("inner"))
        own = copies.filter("low = least").join(found, ["sub", "same"])
        own = own.select("prefix", "content", F.transform("inner", lambda x: x + F.col("first")).alias("starts"))
        repeated = repeated.unionByName(own)
    return repeated.groupBy("prefix", "content").agg(F.flatten(F.collect_list("starts")).alias("starts"))  # a span has about forty windows at most


def _trees(texts: DataFrame, window: int, prefix: int, group: int) -> DataFrame:
    """(prefix, content, starts): repeated windows of spans, by trees over the groups
    that fit one, and by longer prefixes for the others."""
    found = _small_groups(texts.filter("NOT large"), window, group)
    large = texts.filter("large")
    return found if large.isEmpty() else found.unionByName(_divided(large, window, prefix, group))


@own_names("n_words", "n_removed")
def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with every repeated passage removed from `text`, and n_words and
    n_removed (long). A word goes if a window of `window` words that covers it also
    starts in a document with a smaller key; windows are judged on the input. Kept
    words are joined by one space. A null text has no words and stays null; texts
    with fewer words than a window and rows with a null key keep all words and
    remove none elsewhere. Equal keys never remove each other's words, and rows of one
    key with different texts keep their own ranges apart. All columns
    are kept; earlier columns n_words and n_removed are replaced."""
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    light = docs.select(F.col(key).cast("long").alias("doc"), as_bytes(text).alias("text"))
    ranges = repeated_windows(light, window, prefix, group)
    per_doc = ranges.groupBy(F.col("doc").alias("_doc"), F.col("print").alias("_print")).agg(F.collect_list(F.struct("from", "to")).alias("_ranges"))
    per_doc = stored(per_doc, "removed")
    wide = docs.select(*columns, F.col(key).cast("long").alias("_doc"), as_bytes(text).alias("_text"))
    wide = wide.withColumn("_print", F.xxhash64("_text")).drop(text).join(per_doc, ["_doc", "_print"], "left")
    rest = [c for c in columns if c != text]

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            out = {c: part[c] for c in rest} | {text: [], "n_words": [], "n_removed": []}
            for body, found in zip(part["_text"], part["_ranges"]):
                words = split_words(body)
                gone = np.zeros(len(words) + 1, np.int64)
                for r in found or ():
                    gone[min(r["from"], len(words))] += 1
                    gone[min(r["to"], len(words))] -= 1
                inside = np.cumsum(gone[:-1]) > 0
                kept = [w for w, x in zip(words, inside.tolist()) if not x] if found else words
                out[text].append(None if body is None else b" ".join(kept).decode("utf-8", "replace"))
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
            yield out

    schema = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest] + [f"`{text}` string", "n_words long", "n_removed long"]
    done = map_batches(wide.select(*rest, "_text", "_ranges"), run, ", ".join(schema))
    return done.select(*columns, "n_words", "n_removed")
