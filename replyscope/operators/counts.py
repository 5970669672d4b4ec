"""Words and grams of texts counted in Arrow batches.

A row per word costs Spark far more than the word. Here the words of a slice of texts are
numbered, a gram is a number made of those of its words, and a sort of (gram, text) inside
the task counts them. A row per gram and slice leaves the task: sums, or the gram's texts.
Spark adds the sums up and joins the lists by term. A slice has a bounded size (more only
if one text has), whatever the partition holds.

Words are those of tokenize_ws and tokenize_word. Texts are cut at blanks byte by byte;
other word characters are looked at once for each different piece."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 23  # bytes of a slice
BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])  # SPACE in one byte
LEADS = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])  # first bytes of the others
OTHER_BLANKS = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NO_WORD = r"[^\p{L}\p{N}_]+"


def lowered(text: Column) -> Column:
    """The text whose words between blanks are counted."""
    return F.lower(F.coalesce(text, F.lit("")))


def lowered_words(text: Column) -> Column:
    """The text whose runs of word characters are counted. Characters that Java does not
    know are none of those in tokenize_word; Arrow may know them, so they become blanks."""
    plain = lowered(text)
    return F.when(F.octet_length(plain) == F.length(plain), plain).otherwise(F.regexp_replace(plain, r"\p{Cn}", " "))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        upto = np.cumsum(pc.binary_length(batch.column("lowered")).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + SLICE, "right")))
            yield batch.slice(start, end - start)
            start = end


def _pieces(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row, piece): what is between blanks, in the order of the texts."""
    texts = texts.cast(pa.string())
    data, ends = _bytes(texts)
    if LEADS[data].any():
        data, ends = _bytes(pc.replace_substring_regex(texts, OTHER_BLANKS, " "))
    inside = ~BLANK[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < len(data)]
    first[heads] = inside[heads]
    at = np.flatnonzero(first)
    held = np.cumsum(inside)
    offsets = np.append(held[at] - 1, held[-1] if len(held) else 0).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    return np.searchsorted(ends, at, "right") - 1, pieces


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last one ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _numbered(pieces: pa.Array) -> tuple[np.ndarray, pa.Array]:
    encoded = pieces.dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def _words(texts: pa.Array, stop_words: frozenset | None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, word, known): the words of texts, numbered by their place in `known`. With
    stop_words, the runs of word characters; without (None), all between blanks."""
    row, pieces = _pieces(texts)
    code, known = _numbered(pieces)
    if stop_words is None:
        return row, code, known
    runs = pc.split_pattern_regex(known, NO_WORD)
    run, names = _numbered(runs.flatten())
    counted = pc.greater_equal(pc.utf8_length(names), 2).to_numpy(zero_copy_only=False)
    if stop_words:
        counted &= ~pc.is_in(names, pa.array(sorted(stop_words), pa.string())).to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(known)), runs.value_lengths().to_numpy())[counted[run]]
    run = run[counted[run]]
    n = np.bincount(of, minlength=len(known))
    begins = np.cumsum(n) - n
    taken = n[code]
    place = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken) + np.repeat(begins[code], taken)
    return np.repeat(row, taken), run[place], names


def _grams(part: pa.RecordBatch, stop_words: frozenset | None, low: int, high: int) -> Iterator[tuple[Callable, np.ndarray, np.ndarray, np.ndarray]]:
    """(names, gram, row, n) of the distinct pairs of a gram and a row, ordered by both,
    for every length of grams; names gives the strings of grams."""
    row, code, known = _words(part.column("lowered"), stop_words)
    start, gram, names = np.arange(len(code)), code, lambda numbers: known.take(pa.array(numbers))
    for length in range(1, high + 1):
        if length > 1:
            first = known
            if length > 2:  # numbered anew, so that numbers stay small
                held, gram = np.unique(gram, return_inverse=True)
                first = names(held)
            keep = np.flatnonzero(start + length - 1 < len(code))
            keep = keep[row[start[keep] + length - 1] == row[start[keep]]]
            start, gram = start[keep], gram[keep] * len(known) + code[start[keep] + length - 1]

            def names(numbers, first=first):
                before, last = np.divmod(numbers, len(known))
                return pc.binary_join_element_wise(first.take(pa.array(before)), known.take(pa.array(last)), " ")

        if length >= low and len(gram):
            pair = np.sort(gram * part.num_rows + row[start])
            at = _starts(pair)
            yield names, pair[at] // part.num_rows, pair[at] % part.num_rows, np.diff(np.append(at, len(pair)))


def _starts(gram: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))


def with_length(texts: DataFrame) -> DataFrame:
    """Texts with the number of their words between blanks, as `length`."""
    names = texts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            n = np.bincount(_pieces(part.column("lowered"))[0], minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(n.astype(np.int64))], [*names, "length"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in texts.dtypes)
    return texts.withColumn("lowered", F.coalesce("text", F.lit(""))).mapInArrow(run, f"{schema}, length long")


def gram_sums(texts: DataFrame, stop_words, low: int = 1, high: int = 1) -> DataFrame:
    """(term, df, n_texts, cf), to be summed by term, of the grams of texts (copies, text)."""
    stop_words = frozenset(stop_words or ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            copies = part.column("copies").to_numpy()
            for names, gram, row, n in _grams(part, stop_words, low, high):
                at = _starts(gram)
                sums = np.add.reduceat(copies[row], at), np.diff(np.append(at, len(gram))), np.add.reduceat(n * copies[row], at)
                yield pa.RecordBatch.from_arrays([names(gram[at]), *map(pa.array, sums)], ["term", "df", "n_texts", "cf"])

    return texts.select("copies", lowered_words(F.col("text")).alias("lowered")).mapInArrow(run, "term string, df long, n_texts long, cf long")


def word_lists(texts: DataFrame) -> DataFrame:
    """(term, df, n_texts, held) of the words of texts (text_key, copies, length, text):
    sums as in gram_sums, and held, the texts of a slice that have the word, as structs
    (text_key, length, tf)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            key, length, copies = (part.column(c).to_numpy() for c in ("text_key", "length", "copies"))
            for names, gram, row, n in _grams(part, None, 1, 1):
                at = _starts(gram)
                ends = np.append(at, len(gram))
                held = pa.StructArray.from_arrays([pa.array(x) for x in (key[row], length[row], n)], ["text_key", "length", "tf"])
                columns = [names(gram[at]), pa.array(np.add.reduceat(copies[row], at)), pa.array(np.diff(ends))]
                columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), held))
                yield pa.RecordBatch.from_arrays(columns, ["term", "df", "n_texts", "held"])

    held = "array<struct<text_key:long,length:long,tf:long>>"
    return texts.select("text_key", "copies", "length", lowered(F.col("text")).alias("lowered")).mapInArrow(run, f"term string, df long, n_texts long, held {held}")


def unit_postings(texts: DataFrame, vocabulary: DataFrame, stop_words, low: int = 1, high: int = 1) -> DataFrame:
    """(term_key, text_key, weight) of the grams of texts (text_key, text) over a vocabulary (term,
    term_key, idf) of bounded size, which is sent to every task; weight is tf * idf,
    scaled to length 1 per text."""
    stop_words = frozenset(stop_words or ())
    rows = vocabulary.select("term", "term_key", "idf").collect()
    shared = texts.sparkSession.sparkContext.broadcast(([r["term"] for r in rows], [r["term_key"] for r in rows], [r["idf"] for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, keys, idf = (pa.array(x, kind) for x, kind in zip(shared.value, (pa.string(), pa.int64(), pa.float64())))
        keys, idf = keys.to_numpy(), idf.to_numpy()
        for part in _slices(batches):
            found = []
            for names, gram, row, n in _grams(part, stop_words, low, high):
                at = _starts(gram)
                term = pc.fill_null(pc.index_in(names(gram[at]), value_set=terms), -1).to_numpy()
                term = np.repeat(term, np.diff(np.append(at, len(gram))))
                found.append((term[term >= 0], row[term >= 0], n[term >= 0]))
            if not found:
                continue
            term, row, n = (np.concatenate(x) for x in zip(*found))
            raw = n * idf[term]
            weight = raw / np.sqrt(np.bincount(row, raw * raw, part.num_rows))[row]
            columns = [keys[term], part.column("text_key").to_numpy()[row], weight]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["term_key", "text_key", "weight"])

    return texts.select("text_key", lowered_words(F.col("text")).alias("lowered")).mapInArrow(run, "term_key long, text_key long, weight double")


def term_lists(texts: DataFrame, vocabulary: list[str], stop_words) -> DataFrame:
    """Texts without `text`, and the words of each over a vocabulary of bounded size: terms,
    by their place in it and in its order, tfs, and a fingerprint of both (null without
    words)."""
    stop_words, names_ = frozenset(stop_words or ()), [c for c in texts.columns if c != "text"]
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.string())
        for part in _slices(batches):
            term, row, tf = (np.zeros(0, np.int64) for _ in range(3))
            for names, gram, row, n in _grams(part, stop_words, 1, 1):
                at = _starts(gram)
                term = pc.fill_null(pc.index_in(names(gram[at]), value_set=known), -1).to_numpy().astype(np.int64)
                term, tf = np.repeat(term, np.diff(np.append(at, len(gram)))), n
            held = np.flatnonzero(term >= 0)
            held = held[np.lexsort((term[held], row[held]))]
            term, tf = term[held].astype(np.int32), tf[held].astype(np.int32)
            ends = np.append(0, np.cumsum(np.bincount(row[held], minlength=part.num_rows)))
            prints = [sha256(term[i:j].tobytes() + tf[i:j].tobytes()).digest() if i < j else None for i, j in zip(ends, ends[1:])]
            lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x)) for x in (term, tf)]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names_], *lists, pa.array(prints, pa.binary())], [*names_, "terms", "tfs", "print"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in texts.dtypes if name != "text")
    return texts.select(*names_, lowered_words(F.col("text")).alias("lowered")).mapInArrow(run, f"{schema}, terms array<int>, tfs array<int>, print binary")
