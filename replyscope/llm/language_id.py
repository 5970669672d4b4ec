"""Language identification by multinomial naive Bayes over character n-grams.

Letters are lower-cased, everything else counts as one space. N-grams of one to
three characters are hashed into 2^15 counters; a model is the matrix of smoothed
log-probabilities (counters x languages), which is broadcast: 2^15 x 4 bytes, 128
KB, for each language. Batches of texts are scored in numpy: hashed n-grams look
up their matrix rows, and the rows are summed for every text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import map_batches, own_names

COUNTERS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
SAMPLE = 4_000  # labelled texts of each language that are learned from, about
SLICE = 1 << 18  # characters that are hashed at a time
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # counters x languages
    log_prior: np.ndarray


def _characters(text: str) -> np.ndarray:
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32).copy()
    codes[(codes < 97) | ((codes > 122) & (codes < 170))] = 32
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == 32) & (codes[:-1] == 32)
    return codes[~again].astype(np.uint64)


def _counters(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text, a slice at a time; slices overlap so that every
    n-gram of the whole text is there once."""
    codes = _characters(text)
    for order in ORDERS:
        n = len(codes) - order + 1
        for at in range(0, n, SLICE):
            stop = min(at + SLICE, n)
            h = np.full(stop - at, order, np.uint64)
            for i in range(order):
                h = (h ^ codes[at + i : stop + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            yield (h & np.uint64(COUNTERS - 1)).astype(np.int64)


def train(docs: DataFrame, sample: int = SAMPLE, lang: str = "lang", text: str = "text") -> LanguageModel:
    """Learns from rows with a text and a language. At most about `sample` texts
    of a language are used, chosen by a hash of the text; a language with fewer is
    used whole. Without such rows the model knows no language."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[lang]: r["count"] for r in rows.groupBy(lang).count().collect()}  # one row per language
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((COUNTERS, 0), np.float32), np.zeros(0))
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, sample / sizes[name]))])[F.col(lang)]
    part = F.pmod(F.xxhash64(text), F.lit(1 << 20)) < share * (1 << 20)
    place = {name: i for i, name in enumerate(languages)}

    def count(parts: Iterator[dict]) -> Iterator[dict]:
        table = np.zeros((len(languages), COUNTERS), np.int64)
        for batch in parts:
            for name, body in zip(batch["lang"], batch["text"]):
                for grams in _counters(body):
                    table[place[name]] += np.bincount(grams, minlength=COUNTERS)
        i, c = np.nonzero(table)
        yield {"language": i.astype(np.int32), "counter": c.astype(np.int32), "n": table[i, c]}

    counted = map_batches(rows.filter(part).select(F.col(lang).alias("lang"), F.col(text).alias("text")), count, "language int, counter int, n long")
    total = np.zeros((len(languages), COUNTERS))
    counted = counted.groupBy("language", "counter").agg(F.sum("n").alias("n"))  # at most COUNTERS rows a language
    for r in counted.groupBy("language").agg(F.collect_list(F.struct("counter", "n")).alias("cells")).toLocalIterator():
        np.add.at(total[r["language"]], [c["counter"] for c in r["cells"]], [c["n"] for c in r["cells"]])
    smooth = total + SMOOTHING
    matrix = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)
    weight = np.array([sizes[name] for name in languages], float)
    return LanguageModel(languages, np.ascontiguousarray(matrix), np.log(weight / weight.sum()))


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


@own_names("lang_pred", "score")
def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score, the posterior probability of the language.
    A text that is null or has no letter, and every text if the model knows no
    language, is `und` with score 0. Equal probabilities go to the first language
    in alphabetic order. Whole texts are scored, repeated rows alike; all columns
    are kept, earlier columns lang_pred and score are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_probability, model.log_prior))
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def score(parts: Iterator[dict]) -> Iterator[dict]:
        languages, matrix, prior = shared.value
        for part in parts:
            names, scores = [], []
            for body, letters in zip(part["_text"], part["_letters"]):
                if not letters or not languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = prior + sum(matrix[grams].sum(axis=0, dtype=np.float64) for grams in _counters(body))
                best = int(total.argmax())
                names.append(languages[best])
                scores.append(float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum()))
            yield {c: part[c] for c in columns} | {"lang_pred": names, "score": scores}

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    wide = docs.select(*columns, F.col(text).cast("string").alias("_text"), has_letter(text).alias("_letters"))
    return map_batches(wide, score, f"{schema}{', ' if columns else ''}lang_pred string, score double")

