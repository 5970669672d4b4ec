"""Quality rules by distribution divergence.

A language's reference is its distribution of character classes and of its most
common words over all documents labelled with it. A document is compared with the
reference by Jensen-Shannon distance (the square root of the divergence to base
two, 0 to 1). Short documents are not compared: their histograms say little."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.llm.common import as_bytes, map_batches, own_names, split_words, stored
from replyscope.llm.statistics import CLASSES, base_statistics, byte_counts, class_counts

COMMON_WORDS = 50  # words of a language's reference
MIN_CHARS = 200  # code points below which classes are not compared
MIN_WORDS = 50  # words below which words are not compared
MAX_CLASS_DISTANCE = 0.34
MAX_WORD_DISTANCE = 0.5
MAX_WORD_SHARE = 0.9  # of the distance of a text without a common word
MIN_TOTAL = 20  # words
MAX_REPEATED = 30  # percent of words in repeated windows
FLUSH = 200_000  # distinct words of a task after which its counts are passed on
STRIP = b".,;:!?\"'()"

Reference = tuple[np.ndarray, dict[bytes, int], np.ndarray]


def plain_word(word: bytes) -> bytes:
    """The word without case (A-Z) and outer punctuation."""
    return word.strip(STRIP).lower()


def count_plain(words: list[bytes], into: dict[bytes, int]) -> None:
    """Adds the counts of the plain words that are not empty."""
    for word, n in Counter(words).items():
        if plain := plain_word(word):
            into[plain] = into.get(plain, 0) + n


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> float:
    """Distance of two histograms, 0 if one of them is empty."""
    if p.sum() <= 0 or q.sum() <= 0:
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, min(1.0, parts.sum() / 2))))


def references(docs: DataFrame, common: int = COMMON_WORDS, lang: str = "lang", text: str = "text") -> dict[str | None, Reference]:
    """Per language, and for all documents together under None: the class
    histogram, the places of the `common` most frequent words (ties: smaller word
    first), and their counts followed by the count of all other words. Statistics
    cover all documents; counts are combined in every task before the shuffle. The
    result has `common` words for each language."""

    def count(parts: Iterator[dict]) -> Iterator[dict]:
        classes: dict = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))
        words: dict = defaultdict(dict)
        for part in parts:
            for name, body in zip(part["lang"], part["text"]):
                classes[name] += class_counts(byte_counts(body or b""))
                count_plain(split_words(body), words[name])
            if sum(map(len, words.values())) > FLUSH:
                yield rows([(name, word, None, n) for name, own in words.items() for word, n in own.items()])
                words.clear()
        yield rows([(name, word, None, n) for name, own in words.items() for word, n in own.items()])
        yield rows([(name, None, i, n) for name, c in classes.items() for i, n in enumerate(c.tolist())])

    def rows(found: list[tuple]) -> dict:
        return dict(zip(("lang", "word", "class", "n"), zip(*found))) if found else dict.fromkeys(("lang", "word", "class", "n"), [])

    source = docs.select(F.col(lang).cast("string").alias("lang"), as_bytes(text).alias("text"))
    counted = map_batches(source, count, "lang string, word binary, class int, n long").groupBy("lang", "word", "class").agg(F.sum("n").alias("n"))
    counted = stored(counted, "references")
    overall = counted.groupBy("word", "class").agg(F.sum("n").alias("n")).withColumn("all", F.lit(True))
    both = counted.filter("lang IS NOT NULL").withColumn("all", F.lit(False)).unionByName(overall.withColumn("lang", F.lit(None).cast("string")))
    both = stored(both, "references")
    words = both.filter("word IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("all", "lang").orderBy(F.desc("n"), "word"))
    top = words.withColumn("rank", rank).filter(F.col("rank") <= common).collect()  # `common` rows per language
    total = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    classes = both.filter("word IS NULL").collect()  # ten rows per language
    found: dict[str | None, Reference] = {}
    for language in {r["lang"] for r in classes}:
        histogram = np.zeros(len(CLASSES))
        for r in classes:
            if r["lang"] == language:
                histogram[r["class"]] = r["n"]
        best = sorted((r for r in top if r["lang"] == language), key=lambda r: r["rank"])
        counts = [r["n"] for r in best]
        rest = total.get(language, 0) - sum(counts)
        found[language] = (histogram, {bytes(r["word"]): i for i, r in enumerate(best)}, np.array([*counts, rest], float))
    return found


def distances(counts: np.ndarray, words: list[bytes], reference: Reference, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> tuple[float | None, float | None]:
    """Distance of character classes and of common words from the reference; None
    for a text that is too short to be compared."""
    histogram, places, common = reference
    classes = class_counts(counts)
    by_class = jensen_shannon(classes.astype(float), histogram) if classes.sum() >= min_chars else None
    if len(words) < min_words:
        return by_class, None
    own = [0] * len(common)
    for word, n in Counter(words).items():
        if plain := plain_word(word):
            own[places.get(plain, len(places))] += n
    return by_class, jensen_shannon(np.array(own, float), common)


def word_limit(reference: Reference, most: float = MAX_WORD_DISTANCE, share: float = MAX_WORD_SHARE) -> float:
    """The largest word distance of a text that is kept: `share` of the distance of
    a text without any common word, `most` if that is less. Without common words
    in the reference there is nothing to miss, and `most` holds."""
    common = reference[2]
    nothing = np.zeros(len(common))
    nothing[-1] = 1
    bare = jensen_shannon(nothing, common)
    return min(most, share * bare) if bare > 0 else most


@own_names("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept")
def judge(
    docs: DataFrame,
    found: dict[str | None, Reference],
    max_class: float = MAX_CLASS_DISTANCE,
    max_word: float = MAX_WORD_DISTANCE,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, class_distance, word_distance and kept. base_failed: fewer than 20
    words, or more than 30 percent of them in repeated 8-word windows. kept: the
    base rules hold and no distance exceeds its limit; that of words is at most
    `max_word`, and lower where the reference asks for it (`word_limit`). A null text is an empty one
    and fails; a null or unknown language is compared with all documents together;
    a distance of a text too short for it is null and never rejects. Whole texts
    are read, repeated rows judged alike; earlier columns of these names are
    replaced."""
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept")
    columns = [c for c in docs.columns if c not in new]
    shared = docs.sparkSession.sparkContext.broadcast(found)
    empty: Reference = (np.zeros(len(CLASSES)), {}, np.zeros(1))

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        known = shared.value
        limits = {name: word_limit(reference, max_word) for name, reference in known.items()}
        for part in parts:
            out = {name: [] for name in new}
            for name, body in zip(part["_lang"], part["_text"]):
                counts, words, base = base_statistics(body)
                failed = base["n_words"] < MIN_TOTAL or 100 * base["n_repeat_words"] > MAX_REPEATED * base["n_words"]
                own = name if known.get(name) else None
                by_class, by_word = distances(counts, words, known.get(own) or empty)
                fine = not failed and (by_class or 0.0) <= max_class and (by_word or 0.0) <= limits.get(own, max_word)
                row = base | {"base_failed": failed, "class_distance": by_class, "word_distance": by_word, "kept": fine}
                for column in new:
                    out[column].append(row[column])
            yield {c: part[c] for c in columns} | out

    schema = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    schema += ["n_words long", "word_chars long", "n_symbols long", "n_dup_lines long", "n_repeat_words long"]
    schema += ["base_failed boolean", "class_distance double", "word_distance double", "kept boolean"]
    wide = docs.select(*columns, F.col(lang).cast("string").alias("_lang"), as_bytes(text).alias("_text"))
    return map_batches(wide, run, ", ".join(schema))
