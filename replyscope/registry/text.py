"""Queries over text functions, rules and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyscope import constants as C
from replyscope.functions import judging, labels, replies, routing, text
from replyscope.operators.threads import nonempty_docs, raw_as_docs
from replyscope.plans.answer import constant_prediction, keyword_prediction
from replyscope.registry import sql as S
from replyscope.registry.inputs import documents, messages, stamp, table, threads


def _digest(name: str, array):
    return [F.size(array).cast("long").alias("n"), F.md5(F.array_join(array, " ")).alias(name)]


def clean_text(spark, d):
    cleaned = text.clean_text(F.col("text"))
    return documents(spark, d).select("doc_id", F.length(cleaned).cast("long").alias("n"), F.md5(cleaned).alias("cleaned"))


def normalize_inbound(spark, d):
    flags = F.array(*[F.lit(v) for v in ("True", "1", "t", " YES ", "false", "0", "n")], F.lit(None).cast("string"))
    flag = F.element_at(flags, (F.col("row_ord") % 8 + 1).cast("int"))
    return messages(spark, d).select("tweet_id", text.normalize_inbound(flag, "string").alias("inbound"))


def parse_created_at(spark, d):
    iso = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    social = F.date_format("ts", "EEE MMM dd HH:mm:ss Z yyyy")
    kind = F.col("event_id") % 4
    written = F.when(kind == 0, iso).when(kind == 1, social).when(kind == 2, F.lit("not a date"))
    events = table(spark, d, "events").withColumn("written", written)
    parsed = text.parse_created_at(F.col("written"))
    return events.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("created_at"))


def tokenize_ws(spark, d):
    return documents(spark, d).select("doc_id", *_digest("tokens", text.tokenize_ws(F.col("text"))))


def tokenize_word(spark, d):
    return documents(spark, d).select("doc_id", *_digest("tokens", text.tokenize_word(F.col("text"))))


def word_ngrams(spark, d):
    tokens = documents(spark, d).select("doc_id", text.tokenize_word(F.col("text")).alias("t"))
    return tokens.select("doc_id", *_digest("grams", text.word_ngrams(F.col("t"), 1, 2)))


def lexicon_hits(spark, d):
    found = labels.lexicon_hits(F.col("text_clean"))
    return messages(spark, d).select("tweet_id", *[c.cast("long").alias(i) for i, c in found.items()])


def heuristic_label(spark, d):
    plain = labels.heuristic_label(F.col("text_clean"), override=None)
    return messages(spark, d).select(
        "tweet_id", labels.heuristic_label(F.col("text_clean")).alias("intent"), plain.alias("without_override")
    )


def pick_field(spark, d):
    third = F.col("row_ord") % 3
    m = messages(spark, d).select(
        "tweet_id",
        F.when(third == 0, F.col("text_clean")).when(third == 1, F.lit("")).alias("inbound_text"),
        F.when(third != 2, F.col("text")).alias("text"),
        F.when(third == 1, F.lit(0)).when(third == 2, F.lit(7)).alias("thread_len"),
    )
    return m.select(
        "tweet_id",
        F.md5(text.pick_field(["inbound_text", "text", "tweet_text"], m.columns, "none")).alias("picked"),
        text.pick_field(["brand"], m.columns, C.DEFAULT_BRAND).alias("brand"),
        text.pick_length("thread_len", m.columns).cast("long").alias("length"),
    )


def build_query_text(spark, d):
    query = text.build_query_text(F.col("inbound_text"), F.col("prev_turn"))
    return threads(spark, d).select("tweet_id", F.length(query).cast("long").alias("n"), F.md5(query).alias("query"))


def _with_history(spark, d):
    """Threads with a small retrieved list: the reply and the previous turn."""
    hits = F.filter(F.array("brand_reply", "prev_turn"), lambda x: x != "")
    hits = F.when(F.col("row_ord") % 4 == 1, F.array().cast("array<string>")).otherwise(hits)
    history = F.transform(hits, lambda x: F.struct(x.alias("text")))
    return threads(spark, d).withColumn("retrieved", history).withColumn("intent", labels.heuristic_label(F.col("inbound_text")))


HISTORY = """hist AS (
  SELECT *, CASE WHEN row_ord % 4 = 1 THEN [] ELSE list_filter([brand_reply, prev_turn], lambda z: z <> '') END AS hits,
         {label} AS intent FROM threads
), lines AS (
  SELECT *, CASE WHEN len(hits) = 0 THEN NULL ELSE array_to_string(list_transform(hits, lambda z: '- ' || z), chr(10)) END AS bullets
  FROM hist
)""".replace("{label}", S.label("inbound_text"))


def render_prompt(spark, d):
    t = _with_history(spark, d)
    prompt = replies.render_prompt(F.col("brand"), F.col("inbound_text"), F.col("intent"), F.col("retrieved"), F.col("prev_turn"))
    parts = t.select("tweet_id", prompt.alias("p"))
    return parts.select(
        "tweet_id",
        F.array_join(F.transform("p", lambda x: x["role"]), ",").alias("roles"),
        F.md5(F.col("p")[0]["content"]).alias("system"),
        F.md5(F.col("p")[1]["content"]).alias("user"),
    )


def _sql_fill(template: str, fields: dict[str, str]) -> str:
    expression = S.q(template)
    for name, value in fields.items():
        # Marks are replaced one by one; no inserted text contains a mark.
        expression = f"replace({expression}, '{{{name}}}', {value})"
    return expression


def render_rubric(spark, d):
    t = _with_history(spark, d)
    draft = replies.template_reply(F.col("intent"))
    rubric = replies.render_rubric(F.col("retrieved"), F.col("intent"), F.col("inbound_text"), draft)
    return t.select("tweet_id", F.length(rubric).cast("long").alias("n"), F.md5(rubric).alias("rubric"))


def template_reply(spark, d):
    intent = F.when(F.col("row_ord") % 11 == 3, F.lit("unknown")).otherwise(labels.heuristic_label(F.col("text_clean")))
    return messages(spark, d).select("tweet_id", replies.template_reply(intent).alias("reply"))


def ungrounded_numbers(spark, d):
    corpus = F.regexp_replace("text", "[0-9]{12,}", "")
    found = replies.long_numbers(F.col("text"))
    return documents(spark, d).select(
        "doc_id",
        F.size(found).cast("long").alias("numbers"),
        replies.ungrounded_numbers(F.col("text"), corpus).alias("ungrounded"),
    )


def _responses(spark, d):
    """Model answers made of table values: well-formed, partial and broken."""
    k = F.get_json_object("props", "$.k")
    forms = F.array(
        F.concat(F.lit('Sure: {"groundedness": '), k, F.lit(', "helpfulness": 4.7, "brand_voice": "3", "safety": 5, "rationale": "ok"} end')),
        F.concat(F.lit('{"groundedness": {"a": 1}, "helpfulness": '), k, F.lit("}")),
        F.concat(F.lit('{"helpfulness": '), k, F.lit(', "evidence": "'), F.col("event_type"), F.lit('"}')),
        F.concat(F.lit("no scores for "), F.col("event_type"), F.lit(", please dm your order")),
        F.concat(F.lit('{"groundedness": '), k, F.lit(', "safety": "4.5"}')),
        F.concat(F.lit('{"groundedness": '), k, F.lit(', "safety": ')),
    )
    return table(spark, d, "events").select("event_id", F.element_at(forms, (F.col("event_id") % 6 + 1).cast("int")).alias("response"))


def extract_json_scores(spark, d):
    fallback = judging.judge_heuristic(F.col("response"), F.lit(""))
    parsed = _responses(spark, d).select("event_id", judging.extract_json_scores(F.col("response"), fallback).alias("s"))
    return parsed.select(
        "event_id", *[F.col("s")[x].cast("long").alias(x) for x in C.DIMENSIONS], F.col("s.rationale").alias("rationale"), F.col("s.evidence").alias("evidence")
    )


def constant(spark, d):
    return constant_prediction(threads(spark, d)).select(
        "tweet_id", "intent", "intent_confidence", "escalate", "escalate_category", "draft_reply", F.size("retrieved").cast("long").alias("hits")
    )


def keyword(spark, d):
    return keyword_prediction(threads(spark, d)).select(
        "tweet_id", "intent", "intent_confidence", "escalate", "escalate_reason", "escalate_category", "draft_reply", "draft_model"
    )


def scaffold(spark, d):
    length = F.col("row_ord") % 7
    values = labels.scaffold_labels(F.col("inbound_text"), length)
    return threads(spark, d).select("tweet_id", *[v.alias(c) for c, v in values.items()])


def route(spark, d):
    confidence = F.round((F.col("row_ord") % 89) / 89.0, 6)
    t = threads(spark, d).withColumn("confidence", confidence).withColumn("length", F.col("row_ord") % 7)
    decision = routing.route(F.col("inbound_text"), labels.heuristic_label(F.col("inbound_text")), F.col("confidence"), F.col("length"), F.col("prev_turn"))
    return t.select("tweet_id", decision.alias("r")).select("tweet_id", "r.*")


def route_keyword_only(spark, d):
    decision = routing.route_keyword_only(F.col("text_clean"), labels.heuristic_label(F.col("text_clean")))
    return messages(spark, d).select("tweet_id", decision.alias("r")).select("tweet_id", "r.*")


def refine_intent(spark, d):
    confidence = F.round((F.col("row_ord") % 89) / 89.0, 6)
    names = F.array(*[F.lit(i) for i in C.INTENTS])
    model_intent = F.element_at(names, (F.col("row_ord") % 8 + 1).cast("int"))
    refined = routing.refine_intent(
        F.col("inbound_text"), F.col("prev_turn"), model_intent, confidence, labels.heuristic_label(F.col("inbound_text"))
    )
    return threads(spark, d).select("tweet_id", refined.alias("r")).select("tweet_id", "r.intent", "r.confidence")


def language_override(spark, d):
    languages = F.array(*[F.lit(v) for v in ("en", "fr", "unknown", "de", "err")])
    t = threads(spark, d).withColumn("language", F.element_at(languages, (F.col("row_ord") % 5 + 1).cast("int")))
    heuristic = labels.heuristic_label(F.col("inbound_text"))
    t = t.withColumn("r", routing.refine_intent(F.col("inbound_text"), F.col("prev_turn"), None, None, heuristic))
    t = t.withColumn("d", routing.route(F.col("inbound_text"), F.col("r.intent"), F.col("r.confidence"), F.col("thread_len"), F.col("prev_turn")))
    values = routing.language_override(F.col("language"), F.col("r"), F.col("d"))
    return t.select("tweet_id", "language", *[v.alias(c) for c, v in values.items()])


def docs_from_threads(spark, d):
    t = threads(spark, d).withColumn("brand_reply", F.when(F.col("row_ord") % 9 == 2, F.lit(" \t")).otherwise(F.col("brand_reply")))
    return nonempty_docs(t).select("doc_id", F.md5("text").alias("text"))


def docs_from_raw(spark, d):
    return raw_as_docs(messages(spark, d)).select("doc_id", F.md5("text").alias("text"))


def judge_heuristic(spark, d):
    judged = documents(spark, d).select("doc_id", judging.judge_heuristic(F.col("text"), F.regexp_replace("text", "[0-9]{12,}", "")).alias("s"))
    return judged.select("doc_id", *[F.col("s")[x].cast("long").alias(x) for x in C.DIMENSIONS])


def judge_sql(reply: str, corpus: str) -> dict[str, str]:
    numbers = S.long_numbers(f"lower({reply})")
    low = f"lower({reply})"
    found = f"len(list_filter({numbers}, lambda n: contains(lower({corpus}), n)))"
    return {
        "groundedness": f"CAST(CASE WHEN len({numbers}) > 0 AND {found} = 0 THEN 1 WHEN {S.any_part(reply, ['please dm', 'dm your'])} THEN 4 ELSE 3 END AS BIGINT)",
        "helpfulness": f"CAST(CASE WHEN contains({low}, 'dm') AND {S.any_part(reply, ['order', 'details'])} THEN 4 ELSE 2 END AS BIGINT)",
        "brand_voice": f"CAST(CASE WHEN {S.any_part(reply, ['sorry', 'thanks'])} AND length({low}) < 300 THEN 4 ELSE 3 END AS BIGINT)",
        "safety": "CAST(5 AS BIGINT)",
    }


def _select(values: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in values.items())


def _route_sql(text_, intent, conf, length, prev):
    return _select(dict(zip(("escalate", "escalate_reason", "escalate_category"), S.route(text_, intent, conf, length, prev))))


_NGRAMS = f"SELECT doc_id, list_concat(t, {S.bigrams('t')}) AS g FROM (SELECT doc_id, {S.tokens_word('text')} AS t FROM documents)"
_KW = S.word_test("(text_clean || ' ' || " + S.label("text_clean") + ")", C.ESCALATE_WORDS)
_KW_THREAD = S.word_test("(inbound_text || ' ' || " + S.label("inbound_text") + ")", C.ESCALATE_WORDS)
_SCAFFOLD_ESC = f"({S.label('inbound_text')} = 'complaint_escalation' OR contains(lower(inbound_text), 'hacked') OR row_ord % 7 > 4)"
_REFINE_TEXT = "(inbound_text || CASE WHEN prev_turn <> '' THEN ' ' || prev_turn ELSE '' END)"
_REFINE_COMPLAINT = S.any_part(_REFINE_TEXT, C.REFINE_COMPLAINT_WORDS)
_LANGS = "(['en', 'fr', 'unknown', 'de', 'err'])[row_ord % 5 + 1]"
_NUM = S.long_numbers("text")
_K = "json_extract_string(props, '$.k')"
_FORMS = f"""([
  'Sure: {{"groundedness": ' || {_K} || ', "helpfulness": 4.7, "brand_voice": "3", "safety": 5, "rationale": "ok"}} end',
  '{{"groundedness": {{"a": 1}}, "helpfulness": ' || {_K} || '}}',
  '{{"helpfulness": ' || {_K} || ', "evidence": "' || event_type || '"}}',
  'no scores for ' || event_type || ', please dm your order',
  '{{"groundedness": ' || {_K} || ', "safety": "4.5"}}',
  '{{"groundedness": ' || {_K} || ', "safety": '])[event_id % 6 + 1]"""


def _scores_sql() -> str:
    readable = []
    values = {}
    fall = judge_sql("response", "''")
    for x in C.DIMENSIONS:
        kind = f"json_type(body, '$.{x}')"
        number = f"json_extract_string(body, '$.{x}')"
        readable.append(
            f"({kind} IS NULL OR {kind} IN ('UBIGINT', 'BIGINT', 'DOUBLE') OR ({kind} = 'VARCHAR' AND regexp_full_match({number}, '[+-]?[0-9]+')))"
        )
        values[x] = f"CASE WHEN ok THEN CASE WHEN {kind} IS NULL THEN 3 ELSE CAST(trunc(CAST({number} AS DOUBLE)) AS BIGINT) END ELSE {fall[x]} END"
    return f"""
    WITH r AS (SELECT event_id, {_FORMS} AS response FROM events),
    b AS (SELECT *, regexp_extract(response, '(?s)\\{{.*\\}}') AS cut FROM r),
    j AS (SELECT *, CASE WHEN json_valid(cut) THEN cut END AS body FROM b),
    o AS (SELECT *, body IS NOT NULL AND {' AND '.join(readable)} AS ok FROM j)
    SELECT event_id, {_select(values)},
      CASE WHEN ok THEN json_extract_string(body, '$.rationale') ELSE 'heuristic' END AS rationale,
      CASE WHEN ok THEN json_extract_string(body, '$.evidence') ELSE 'heuristic' END AS evidence FROM o"""


def redact_pii(spark, d):
    redacted = text.redact_pii(F.col("text"))
    return documents(spark, d).select("doc_id", F.md5(redacted).alias("redacted"), (redacted != F.col("text")).alias("changed"))


def _redact_sql(x: str) -> str:
    for pattern, kind in text.PERSONAL:
        x = f"regexp_replace({x}, {S.q(pattern)}, {S.q(kind)}, 'g')"
    return x


ENTRIES = {
    "redact_pii": (redact_pii, f"SELECT doc_id, md5({_redact_sql('text')}) AS redacted, {_redact_sql('text')} <> text AS changed FROM documents"),
    "clean_text": (clean_text, f"SELECT doc_id, length(c) AS n, md5(c) AS cleaned FROM (SELECT doc_id, {S.clean('text')} AS c FROM documents)"),
    "normalize_inbound": (
        normalize_inbound,
        S.with_msg("SELECT tweet_id, row_ord % 8 NOT IN (4, 5, 6) AS inbound FROM msg"),
    ),
    "parse_created_at": (
        parse_created_at,
        """WITH w AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
             WHEN 1 THEN strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') WHEN 2 THEN 'not a date' END AS s FROM events)
           SELECT event_id, strftime(coalesce(TRY_CAST(s AS TIMESTAMP), try_strptime(substr(s, 5), '%b %d %H:%M:%S +0000 %Y')), '%Y-%m-%d %H:%M:%S') AS created_at FROM w""",
    ),
    "tokenize_ws": (tokenize_ws, f"SELECT doc_id, len(t) AS n, md5(array_to_string(t, ' ')) AS tokens FROM (SELECT doc_id, {S.tokens_ws('text')} AS t FROM documents)"),
    "tokenize_word": (tokenize_word, f"SELECT doc_id, len(t) AS n, md5(array_to_string(t, ' ')) AS tokens FROM (SELECT doc_id, {S.tokens_word('text')} AS t FROM documents)"),
    "word_ngrams": (word_ngrams, f"SELECT doc_id, len(g) AS n, md5(array_to_string(g, ' ')) AS grams FROM ({_NGRAMS})"),
    "lexicon_hits": (lexicon_hits, S.with_msg("SELECT tweet_id, " + ", ".join(f"CAST({S.hits('text_clean', i)} AS BIGINT) AS {i}" for i in C.LEXICON) + " FROM msg")),
    "heuristic_label": (
        heuristic_label,
        S.with_msg(
            f"SELECT tweet_id, {S.label('text_clean')} AS intent, "
            + S.label("text_clean").replace(f"WHEN {S.any_part('text_clean', C.LEXICON[C.COMPLAINT])} THEN {S.q(C.COMPLAINT)} ", "", 1)
            + " AS without_override FROM msg"
        ),
    ),
    "pick_field": (
        pick_field,
        S.with_msg(
            "SELECT tweet_id, md5(CASE row_ord % 3 WHEN 0 THEN text_clean WHEN 1 THEN text ELSE 'none' END) AS picked, "
            f"{S.q(C.DEFAULT_BRAND)} AS brand, CAST(CASE row_ord % 3 WHEN 2 THEN 7 ELSE 1 END AS BIGINT) AS length FROM msg"
        ),
    ),
    "build_query_text": (
        build_query_text,
        S.with_threads(f"SELECT tweet_id, length({_REFINE_TEXT}) AS n, md5({_REFINE_TEXT}) AS query FROM threads"),
    ),
    "render_prompt": (
        render_prompt,
        S.with_threads(
            "SELECT tweet_id, 'system,user' AS roles, md5("
            + _sql_fill(C.SYSTEM_PROMPT, {"brand": "brand"})
            + ") AS system, md5("
            + _sql_fill(
                C.USER_PROMPT,
                {
                    "intent": "intent",
                    "message": "inbound_text",
                    "prev": "coalesce(nullif(prev_turn, ''), 'none')",
                    "context": f"coalesce(bullets, {S.q(C.NO_CONTEXT)})",
                },
            )
            + ') AS "user" FROM lines',
            HISTORY,
        ),
    ),
    "render_rubric": (
        render_rubric,
        S.with_threads(
            "SELECT tweet_id, length(r) AS n, md5(r) AS rubric FROM (SELECT tweet_id, "
            + _sql_fill(
                C.RUBRIC_PROMPT,
                {
                    "retrieved": f"coalesce(bullets, {S.q(C.NO_HISTORY)})",
                    "intent": "intent",
                    "customer": "inbound_text",
                    "draft": S.template("intent"),
                },
            )
            + " AS r FROM lines)",
            HISTORY,
        ),
    ),
    "template_reply": (
        template_reply,
        S.with_msg(
            "SELECT tweet_id, " + S.template("i") + f" AS reply FROM (SELECT tweet_id, CASE WHEN row_ord % 11 = 3 THEN 'unknown' ELSE {S.label('text_clean')} END AS i FROM msg)"
        ),
    ),
    "ungrounded_numbers": (
        ungrounded_numbers,
        f"SELECT doc_id, len({_NUM}) AS numbers, len(list_filter({_NUM}, lambda n: NOT contains(regexp_replace(text, '[0-9]{{12,}}', '', 'g'), n))) > 0 AS ungrounded FROM documents",
    ),
    "extract_json_scores": (extract_json_scores, _scores_sql()),
    "constant_prediction": (
        constant,
        S.with_threads(
            f"SELECT tweet_id, 'other' AS intent, 1.0::DOUBLE AS intent_confidence, false AS escalate, 'auto' AS escalate_category, {S.q(C.CONSTANT_REPLY)} AS draft_reply, 0::BIGINT AS hits FROM threads"
        ),
    ),
    "keyword_prediction": (
        keyword,
        S.with_threads(
            f"SELECT tweet_id, {S.label('inbound_text')} AS intent, 0.6::DOUBLE AS intent_confidence, {_KW_THREAD} AS escalate, "
            f"CASE WHEN {_KW_THREAD} THEN 'Keyword match' ELSE 'No keyword' END AS escalate_reason, "
            f"CASE WHEN {_KW_THREAD} THEN 'policy' ELSE 'auto' END AS escalate_category, {S.template(S.label('inbound_text'))} AS draft_reply, 'heuristic' AS draft_model FROM threads"
        ),
    ),
    "scaffold_labels": (
        scaffold,
        S.with_threads(
            f"SELECT tweet_id, {S.label('inbound_text')} AS intent, 'heuristic: keyword match ' || {S.label('inbound_text')} AS intent_rationale, {_SCAFFOLD_ESC} AS escalate, "
            f"CASE WHEN {_SCAFFOLD_ESC} THEN 'heuristic: complaint/sensitive/long thread' ELSE 'heuristic: confident auto' END AS escalate_reason, "
            f"CASE WHEN {S.label('inbound_text')} = 'complaint_escalation' THEN 'high_risk' WHEN contains(lower(inbound_text), 'hacked') THEN 'sensitive' ELSE 'auto' END AS escalate_category, "
            "true AS needs_human_review FROM threads"
        ),
    ),
    "route": (
        route,
        S.with_threads(
            "SELECT tweet_id, " + _route_sql("inbound_text", "i", "conf", "(row_ord % 7)", "prev_turn")
            + f" FROM (SELECT *, round((row_ord % 89) / 89.0::DOUBLE, 6) AS conf, {S.label('inbound_text')} AS i FROM threads)"
        ),
    ),
    "route_keyword_only": (
        route_keyword_only,
        S.with_msg(
            f"SELECT tweet_id, {_KW} AS escalate, CASE WHEN {_KW} THEN 'Keyword match' ELSE 'No keyword' END AS escalate_reason, "
            f"CASE WHEN {_KW} THEN 'policy' ELSE 'auto' END AS escalate_category FROM msg"
        ),
    ),
    "refine_intent": (
        refine_intent,
        S.with_threads(
            f"""SELECT tweet_id, CASE WHEN {_REFINE_COMPLAINT} THEN 'complaint_escalation' WHEN conf < 0.5 AND h <> 'other' THEN h ELSE mi END AS intent,
                CASE WHEN {_REFINE_COMPLAINT} THEN 0.85::DOUBLE WHEN conf < 0.5 AND h <> 'other' THEN 0.55::DOUBLE ELSE conf END AS confidence
                FROM (SELECT *, round((row_ord % 89) / 89.0::DOUBLE, 6) AS conf, {S.label('inbound_text')} AS h, ({S.strings(C.INTENTS)})[row_ord % 8 + 1] AS mi FROM threads)"""
        ),
    ),
    "language_override": (
        language_override,
        S.with_threads(
            f"""SELECT tweet_id, lang AS language, CASE WHEN f THEN 'other' ELSE i END AS intent, CASE WHEN f THEN 0.4::DOUBLE ELSE conf END AS intent_confidence_gold,
                f OR escalate AS escalate, CASE WHEN f THEN printf({S.q(C.REASON_LANGUAGE)}, lang) ELSE escalate_reason END AS escalate_reason,
                CASE WHEN f THEN 'policy' ELSE escalate_category END AS escalate_category FROM decided""",
            f"""guess AS (SELECT *, {_LANGS} AS lang, {_LANGS} NOT IN ('en', 'unknown', 'err') AS f,
                 CASE WHEN {_REFINE_COMPLAINT} THEN 'complaint_escalation' ELSE {S.label('inbound_text')} END AS i,
                 CASE WHEN {_REFINE_COMPLAINT} THEN 0.85::DOUBLE ELSE 0.5::DOUBLE END AS conf FROM threads)""",
            "decided AS (SELECT *, " + _route_sql("inbound_text", "i", "conf", "thread_len", "prev_turn") + " FROM guess)",
        ),
    ),
    "nonempty_docs": (
        docs_from_threads,
        S.with_threads(
            "SELECT tweet_id AS doc_id, md5(s) AS text FROM (SELECT tweet_id, "
            + S.strip("coalesce(nullif(CASE WHEN row_ord % 9 = 2 THEN ' ' || chr(9) ELSE brand_reply END, ''), inbound_text)")
            + " AS s FROM threads) WHERE s <> ''"
        ),
    ),
    "raw_as_docs": (
        docs_from_raw,
        S.with_msg("SELECT tweet_id AS doc_id, md5(" + S.strip("text_clean") + ") AS text FROM msg WHERE " + S.strip("text_clean") + " <> ''"),
    ),
    "judge_heuristic": (
        judge_heuristic,
        "SELECT doc_id, " + _select(judge_sql("text", "regexp_replace(text, '[0-9]{12,}', '', 'g')")) + " FROM documents",
    ),
}
