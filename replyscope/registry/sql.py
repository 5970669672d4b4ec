"""SQL building blocks of the checks, written apart from the Spark code.

Only the fixed values (word lists, phrases, texts) are shared."""

from __future__ import annotations

from replyscope import constants as C
from replyscope.sources.tables import PHRASES

SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
NOT_SPACE = r"[^\s\x0B\x1C-\x1F\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strings(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def names(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def clean(x: str) -> str:
    x = f"coalesce({x}, '')"
    x = f"regexp_replace({x}, 'https?://{NOT_SPACE}+', ' [URL] ', 'g')"
    x = f"regexp_replace({x}, '@{WORD}+', ' @user ', 'g')"
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{SPACE}+|{SPACE}+$', '', 'g')"


def tokens_ws(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower(coalesce({x}, '')), '{SPACE}+'), lambda z: z <> '')"


def tokens_word(x: str) -> str:
    runs = f"regexp_extract_all(lower(coalesce({x}, '')), '{WORD}{{2,}}')"
    return f"list_filter({runs}, lambda z: z NOT IN {names(C.STOP_WORDS)})"


def bigrams(tokens: str) -> str:
    pairs = f"list_zip(({tokens})[1:len({tokens})-1], ({tokens})[2:len({tokens})])"
    return f"list_transform({pairs}, lambda z: z[1] || ' ' || z[2])"


def word_test(x: str, words) -> str:
    return f"regexp_matches(lower({x}), '(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(words)})($|[^\\p{{L}}\\p{{N}}_])')"


def any_part(x: str, parts) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), {q(p)})" for p in parts) + ")"


def hits(x: str, intent: str) -> str:
    return "(" + " + ".join(f"contains(lower({x}), {q(k)})::INT" for k in C.LEXICON[intent]) + ")"


def label(x: str) -> str:
    counts = [hits(x, i) for i in C.LEXICON]
    best = f"greatest({', '.join(counts)})"
    cases = " ".join(f"WHEN {h} = {best} THEN {q(i)}" for i, h in zip(C.LEXICON, counts))
    return f"(CASE WHEN {any_part(x, C.LEXICON[C.COMPLAINT])} THEN {q(C.COMPLAINT)} WHEN {best} = 0 THEN 'other' {cases} END)"


def template(intent: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in C.TEMPLATES.items())
    return f"(CASE {intent} {cases} ELSE {q(C.TEMPLATES['other'])} END)"


def route(text: str, intent: str, conf: str, length: str, prev: str) -> list[str]:
    """Expressions for escalate, reason and category."""
    both = f"({text} || ' ' || {prev})"
    rules = [
        (word_test(both, C.HUMAN_WORDS), q(C.REASON_HUMAN), "policy"),
        (f"{intent} = {q(C.COMPLAINT)}", q(C.REASON_COMPLAINT), "high_risk"),
        (
            f"{conf} < 0.55",
            f"printf({q(C.REASON_LOW_CONFIDENCE)}, {conf})",
            "low_confidence",
        ),
        (word_test(both, C.LEGAL_WORDS), q(C.REASON_LEGAL), "policy"),
        (f"({intent} = 'account_access' AND {word_test(both, C.SENSITIVE_WORDS)})", q(C.REASON_SENSITIVE), "sensitive"),
        (f"{length} > 4", f"printf({q(C.REASON_LONG)}, {length})", "repeat"),
        (word_test(both, C.REPEAT_WORDS), q(C.REASON_REPEAT), "repeat"),
    ]
    escalate = "(CASE " + " ".join(f"WHEN {r[0]} THEN true" for r in rules) + " ELSE false END)"
    reason = "(CASE " + " ".join(f"WHEN {r[0]} THEN {r[1]}" for r in rules) + f" ELSE {q(C.REASON_AUTO)} END)"
    category = "(CASE " + " ".join(f"WHEN {r[0]} THEN {q(r[2])}" for r in rules) + " ELSE 'auto' END)"
    return [escalate, reason, category]


def long_numbers(x: str) -> str:
    return f"list_filter(regexp_extract_all(coalesce({x}, ''), '{WORD}+'), lambda z: regexp_full_match(z, '\\p{{Nd}}{{10,}}'))"


MSG = f"""
msg_base AS (
  SELECT conv_id, turn, role, conv_id * 1000 + turn AS rid,
         ({strings(PHRASES)})[(conv_id * 7 + turn * 3) % 24 + 1] || ' ' || coalesce(text, '') AS raw_text
  FROM conversations
), msg AS (
  SELECT CAST(rid AS VARCHAR) AS tweet_id,
         CASE WHEN role = 'user' THEN 'u' || conv_id ELSE 'brand' || (conv_id % 5) END AS author_id,
         role = 'user' AS inbound,
         TIMESTAMP '2017-10-01 00:00:00' + to_minutes(CAST(conv_id * 37 + turn * 3 AS BIGINT)) AS created_at,
         raw_text AS text,
         CASE (conv_id + turn) % 3 WHEN 0 THEN CAST(rid + 1 AS VARCHAR) WHEN 1 THEN ''
              ELSE (rid + 1) || ',' || (rid + 2) END AS response_tweet_id,
         CASE WHEN turn > 0 THEN CAST(rid - 1 AS VARCHAR) ELSE '' END AS in_response_to_tweet_id,
         'brand' || (conv_id % 5) AS brand,
         {clean('raw_text')} AS text_clean,
         rid AS row_ord
  FROM msg_base
)"""

THREADS = f"""{MSG}, by_id AS (
  SELECT tweet_id, arg_max(text_clean, row_ord) AS found FROM msg GROUP BY tweet_id
), answers AS (
  SELECT in_response_to_tweet_id AS tweet_id, arg_min(text_clean, row_ord) AS answer
  FROM msg WHERE NOT inbound AND in_response_to_tweet_id <> '' GROUP BY 1
), joined AS (
  SELECT m.*, coalesce(nullif(r.found, ''), a.answer, '') AS brand_reply, coalesce(p.found, '') AS prev_turn
  FROM msg m
  LEFT JOIN by_id r ON r.tweet_id = trim(split_part(m.response_tweet_id, ',', 1))
  LEFT JOIN answers a ON a.tweet_id = m.tweet_id
  LEFT JOIN by_id p ON p.tweet_id = m.in_response_to_tweet_id
  WHERE m.inbound
), threads AS (
  SELECT tweet_id, author_id, created_at, brand, text_clean AS inbound_text, text AS inbound_raw, brand_reply, prev_turn,
         1 + (brand_reply <> '')::INT + (prev_turn <> '')::INT AS thread_len, true AS inbound, row_ord
  FROM joined
)"""


def with_msg(body: str, *ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join([MSG, *ctes]) + " " + body


def with_threads(body: str, *ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join([THREADS, *ctes]) + " " + body
