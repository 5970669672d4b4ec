"""Token counts of whole texts by a two-tier lookup of pre-token lengths.

A text's count is the sum of the token counts of its pre-tokens, and a few thousand
pre-tokens make up most of a corpus. The lengths of the frequent ones are worked out
once, on a bounded sample, and broadcast as one compact table (first tier). What the
table lacks is encoded where it is met and kept in the worker's bounded cache (second
tier). Only texts' counts leave a task: pre-tokens are never shuffled, and the sample
decides nothing but speed."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import map_batches

LIMIT = 2048
SAMPLE = 2_000  # texts that the frequent pre-tokens are looked for in, about
TABLE = 1 << 16  # entries of the broadcast table
CACHE = 1 << 17  # entries of a worker's cache
LONGEST = 64  # characters of a pre-token that either tier holds
PIECE = 1 << 16  # characters of a text that are split at a time, at least

# The parts of a tokenizers file that texts may be cut at blanks for.
LOWER_CASE = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
BLANK = " \\t-\\r\\x85\\xa0"  # what \s is below U+0250

#: Below U+0250 NFC changes nothing and letters have been the same in every Unicode version.
_BEYOND_LATIN = regex.compile("[^\\x00-\\u024f]")
_LATIN_WORDS = regex.compile(WORDS.replace("\\s", BLANK))
_GAP = regex.compile("[ \\t-\\r]")


class PreTokens:
    """Pre-tokens of texts and their token counts, as a `tokenizers` file has them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as source:
            parts = json.load(source)
        self.normalizer, self.pre_tokenizer, self.model = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model
        if self.pre_tokenizer is None or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in parts["added_tokens"]):
            raise ValueError(f"{path}: its texts can't be counted by pre-tokens")
        added = sorted((t["content"] for t in parts["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        steps = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_words = (
            (parts["normalizer"] or {}).get("normalizers") == LOWER_CASE
            and len(steps) == 2
            and steps[0] == {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True}
            and steps[1]["type"] == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        )
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def pieces(self, text: str) -> Iterator[str]:
        """The text in parts that no pre-token crosses; blanks between words are
        never part of one, so that a long text need not be split at once."""
        if not self.by_words or len(text) <= 2 * PIECE:
            yield text
            return
        at = 0
        while at < len(text):
            gap = _GAP.search(text, at + PIECE)
            stop = gap.start() if gap else len(text)
            yield text[at:stop]
            at = stop

    def split(self, text: str) -> list[str]:
        """Keys of the pre-tokens of a text without added tokens."""
        if self.by_words and not _BEYOND_LATIN.search(text):
            return _LATIN_WORDS.findall(text.lower())
        normal = self.normalizer.normalize_str(text) if self.normalizer else text
        found = self.pre_tokenizer.pre_tokenize_str(normal)
        return [normal[a:b] for _, (a, b) in found] if self.by_words else [key for key, _ in found]

    def length(self, key: str) -> int:
        if self.by_words and not (key.isascii() and key.isprintable()):  # visible ASCII stands for itself
            key = "".join(part for part, _ in self.as_bytes.pre_tokenize_str(key))
        return len(self.model.tokenize(key))

    def count(self, text: str, length: Callable[[str], int]) -> int:
        """Tokens of a whole text; every added token in it is one."""
        if self.added is not None and "<" in text:
            parts = self.added.split(text)
        else:
            parts = [text]
        return len(parts) - 1 + sum(sum(map(length, self.split(piece))) for part in parts for piece in self.pieces(part))


class Lookup(dict):
    """The broadcast table; a missing pre-token goes to the worker's cache, a long
    one is encoded each time."""

    def __init__(self, pre_tokens: PreTokens, table: dict[str, int]):
        super().__init__(table)
        self.cached = lru_cache(CACHE)(pre_tokens.length)
        self.encode = pre_tokens.length

    def __missing__(self, key: str) -> int:
        return self.cached(key) if len(key) <= LONGEST else self.encode(key)


@lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


def frequent(docs: DataFrame, path: str, text: str = "text", sample: int = SAMPLE, size: int = TABLE) -> tuple[bytes, bytes]:
    """The compact table: the most frequent pre-tokens of about `sample` texts, drawn
    by the hash of the text, and their token counts, at most `size` of them. The
    pre-tokens are joined by line breaks, the counts are one byte each."""
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(text).cast("string").alias("text"))
    total = rows.count()
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < max(1, (1 << 20) * sample // max(total, 1))
    few = rows.filter(drawn).coalesce(8)

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        own, met = pre_tokens(path), Counter()
        for part in parts:
            for body in part["text"]:
                for piece in own.pieces(body):
                    met.update(key for key in own.split(piece) if len(key) <= LONGEST and "\n" not in key)
        best = met.most_common(size)
        yield {"key": [k for k, _ in best], "n": [n for _, n in best]}

    met: Counter = Counter()
    for row in map_batches(few, run, "key string, n long").toLocalIterator():  # at most 8 tables
        met[row["key"]] += row["n"]
    own = pre_tokens(path)
    best = sorted(met.items(), key=lambda item: (-item[1], item[0]))[:size]
    lengths = [(key, own.length(key)) for key, _ in best]
    lengths = [(key, n) for key, n in lengths if n < 256]
    return "\n".join(key for key, _ in lengths).encode(), np.array([n for _, n in lengths], np.uint8).tobytes()


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for every row of `docs`: UTF-8 bytes and
    tokens of the whole text as `tokenizers` counts them with the file at `path`,
    without tokens around the text, truncation or padding. The strings of added
    tokens inside a text are one token each, the library's default.

    A null text is empty: no bytes, no tokens. Null keys, equal keys and repeated rows
    are rows of their own; other columns are not read. An empty table gives an empty one."""
    table = docs.sparkSession.sparkContext.broadcast(frequent(docs, path, text, sample))

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        own = pre_tokens(path)
        keys, counts = table.value
        tier = Lookup(own, dict(zip(keys.decode().split("\n"), counts)) if counts else {})
        for part in parts:
            n = [own.count(body, tier.__getitem__) if body else 0 for body in part["text"]]
            yield {"key": part["key"], "n_bytes": part["n_bytes"], "n_tokens": n, "over_limit": [x > limit for x in n]}

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("text"))
    counted = map_batches(rows, run, "key long, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("key", key)
