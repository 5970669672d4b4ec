"""Column functions over message text. All are native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyscope.constants import STOP_WORDS

# Character classes with the same meaning in Java and RE2 regular expressions.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
NOT_SPACE = r"[^\s\x0B\x1C-\x1F\x85\p{Z}]"


def clean_text(col: Column) -> Column:
    """Links become [URL], handles become @user, whitespace is collapsed."""
    text = F.coalesce(col, F.lit(""))
    text = F.regexp_replace(text, f"https?://{NOT_SPACE}+", " [URL] ")
    text = F.regexp_replace(text, f"@{WORD}+", " @user ")
    text = F.regexp_replace(text, f"{SPACE}+", " ")
    return F.trim(text)


def strip_text(col: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), f"^{SPACE}+|{SPACE}+$", "")


def has_word(col: Column, words: list[str]) -> Column:
    """True where one of the words occurs as a whole word, in any case."""
    pattern = rf"(^|[^\p{{L}}\p{{N}}_])({'|'.join(words)})($|[^\p{{L}}\p{{N}}_])"
    return F.lower(col).rlike(pattern)


def has_any(col: Column, parts: list[str]) -> Column:
    """True where one of the parts occurs anywhere in the lower-cased text."""
    return has_any_lowered(F.lower(F.coalesce(col, F.lit(""))), parts)


def has_any_lowered(lowered: Column, parts: list[str]) -> Column:
    return lowered.rlike("|".join(rf"\Q{part}\E" for part in parts))


def tokenize_ws(col: Column) -> Column:
    """Lower-cased whitespace tokens."""
    parts = F.split(F.lower(F.coalesce(col, F.lit(""))), f"{SPACE}+")
    return F.filter(parts, lambda token: token != "")


def tokenize_word(col: Column, stop_words=STOP_WORDS) -> Column:
    """Lower-cased runs of two or more word characters without stop words."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(f"{WORD}{{2,}}"), F.lit(0))
    if not stop_words:
        return runs
    return F.filter(runs, lambda token: ~token.isin(list(stop_words)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once for a row. An array that is put into
    several places of an expression is otherwise computed again in each of them."""
    return F.transform(F.array(value), use)[0]


def word_ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """N-grams of an already filtered token array, joined by one blank."""
    return bound(tokens, lambda words: _ngrams(words, low, high))


def _ngrams(tokens: Column, low: int, high: int) -> Column:
    grams = []
    for n in range(low, high + 1):
        count = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
        gram = F.slice(tokens, 1, count)
        for start in range(2, n + 1):
            gram = F.zip_with(gram, F.slice(tokens, start, count), lambda a, b: F.concat(a, F.lit(" "), b))
        grams.append(gram if n > 1 else tokens)
    return F.concat(*grams) if len(grams) > 1 else grams[0]


def long_numbers(col: Column) -> Column:
    """Whole words made of ten or more digits."""
    runs = F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(f"{WORD}+"), F.lit(0))
    return F.filter(runs, lambda run: run.rlike(r"^\p{Nd}{10,}$"))


def pick_field(columns: list[str], available: list[str], default: str) -> Column:
    """First of the present columns whose value is not empty."""
    found = [F.nullif(F.col(name).cast("string"), F.lit("")) for name in columns if name in available]
    return F.coalesce(*found, F.lit(default))


def pick_length(column: str, available: list[str]) -> Column:
    """Thread length, where missing and zero both mean one message."""
    if column not in available:
        return F.lit(1)
    return F.coalesce(F.nullif(F.col(column).cast("int"), F.lit(0)), F.lit(1))


def build_query_text(inbound: Column, prev: Column) -> Column:
    """Retrieval text: the message, followed by the previous turn if any."""
    return F.concat_ws(" ", F.coalesce(inbound, F.lit("")), F.nullif(prev, F.lit("")))


def normalize_inbound(col: Column, dtype: str) -> Column:
    """Truthiness of an inbound flag; a missing value counts as inbound."""
    if dtype == "boolean":
        value = col
    elif dtype == "string":
        value = F.lower(F.trim(col)).isin("true", "1", "t", "yes", "y")
    else:
        value = col != 0
    return F.coalesce(value, F.lit(True))


def parse_created_at(col: Column) -> Column:
    """ISO or social-media timestamps; anything else becomes null."""
    text = col.cast("string")
    # The weekday is cut off: its pattern letter is not allowed in parsing.
    return F.coalesce(
        F.try_to_timestamp(text),
        F.try_to_timestamp(F.substring(text, 5, 100), F.lit("MMM dd HH:mm:ss Z yyyy")),
    )


#: Fixed patterns of personal data and their replacements, in the order of use.
PERSONAL = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"),
    (r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", "[IP]"),
    (r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}", "[CARD]"),
    (r"\+?[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?[ -][0-9]{3,4}[ -]?[0-9]{3,4}", "[PHONE]"),
)


def redact_pii(col: Column) -> Column:
    """Mail and network addresses, card and phone numbers replaced by their kind."""
    for pattern, kind in PERSONAL:
        col = F.regexp_replace(col, pattern, kind)
    return col
