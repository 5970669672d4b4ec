"""Rule branches of the column functions, on frames made by hand."""

import re

import pytest
from pyspark.sql import functions as F

from replyscope import constants as C
from replyscope.functions import judging, labels, replies, routing, text


def values(spark, rows, column, name="t"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {name} string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_clean_text(spark):
    rows = ["see https://a.b/c?d", "@one @zwei hi", "@été ok", "mail __email__ now", "a\t b  c\n", "", None]
    assert values(spark, rows, text.clean_text(F.col("t"))) == [
        "see [URL]", "@user @user hi", "@user ok", "mail __email__ now", "a b c", "", "",
    ]


def test_inbound_and_dates(spark):
    flags = ["True", " yes ", "T", "1", "0", "false", "maybe", None]
    assert values(spark, flags, text.normalize_inbound(F.col("t"), "string")) == [True, True, True, True, False, False, False, True]
    dates = ["2017-10-31 22:10:47", "Tue Oct 31 22:10:47 +0000 2017", "Tue Oct 31 22:10:47 +0200 2017", "soon", None]
    parsed = values(spark, dates, F.date_format(text.parse_created_at(F.col("t")), "dd HH:mm"))
    assert parsed == ["31 22:10", "31 22:10", "31 20:10", None, None]


def plain_label(t):
    low = t.lower()
    counts = {k: sum(w in low for w in words) for k, words in C.LEXICON.items()}
    if any(w in low for w in C.LEXICON[C.COMPLAINT]):
        return C.COMPLAINT
    return max(counts, key=counts.get) if max(counts.values()) else "other"


def test_heuristic_label(spark):
    rows = [
        "nothing", "refund the package", "an issue", "REFUND my charged payment order", "manager refund refund charged billing",
        "login password", "crash and order", "when will it open", "", None,
    ]
    assert values(spark, rows, labels.heuristic_label(F.col("t"))) == [plain_label(r or "") for r in rows]


def test_numbers_and_words(spark):
    rows = ["call 1234567890", "x1234567890", "12345678901 and 99", "٠١٢٣٤٥٦٧٨٩", ""]
    assert values(spark, rows, text.long_numbers(F.col("t"))) == [["1234567890"], [], ["12345678901"], ["٠١٢٣٤٥٦٧٨٩"], []]
    assert values(spark, ["sue!", "issue", "Sue", "a_sue"], text.has_word(F.col("t"), ["sue"])) == [True, False, True, False]
    grams = text.word_ngrams(text.tokenize_word(F.col("t")), 1, 2)
    assert values(spark, ["red the blue, red", "one", ""], grams) == [
        ["red", "blue", "red", "red blue", "blue red"], ["one"], [],
    ]


ROUTES = [
    ("a real person now", "other", 0.9, 1, "", "policy"),
    ("fine", C.COMPLAINT, 0.1, 1, "", "high_risk"),
    ("fine", "other", 0.54, 9, "", "low_confidence"),
    ("police again", "other", 0.55, 9, "", "policy"),
    ("was hacked", "account_access", 0.9, 9, "", "sensitive"),
    ("was hacked", "other", 0.9, 1, "", "auto"),
    ("fine", "other", 0.9, 5, "", "repeat"),
    ("fine", "other", 0.9, 4, "", "auto"),
    ("fine", "other", 0.9, 1, "not again", "repeat"),
    ("issue, againx", "other", 0.9, 1, "", "auto"),
    ("manager", "other", 0.9, 1, "", "auto"),
    ("inhuman", "other", 0.9, 1, "", "auto"),
]


def test_route(spark):
    df = spark.createDataFrame([(i, *r[:5]) for i, r in enumerate(ROUTES)], "i int, t string, intent string, conf double, n int, prev string")
    decision = routing.route(F.col("t"), F.col("intent"), F.col("conf"), F.col("n"), F.col("prev"))
    rows = df.orderBy("i").select(decision.alias("d")).collect()
    assert [r.d.escalate_category for r in rows] == [r[5] for r in ROUTES]
    assert rows[2].d.escalate_reason.startswith("Low intent confidence (0.54 < 0.55)")
    assert rows[6].d.escalate_reason.startswith("Long thread (len 5 >4)")


def test_json_scores(spark):
    rows = [
        'Here: {"groundedness": 4.7, "helpfulness": "2", "brand_voice": 1, "safety": 5, "rationale": "r"} done',
        '{"groundedness": {"x": 1}}', '{"helpfulness": 1}', '{"safety": "4.5"}', '{"safety": null}', "{broken", "please dm your order",
    ]
    fallback = judging.judge_heuristic(F.col("t"), F.lit(""))
    scores = values(spark, rows, judging.extract_json_scores(F.col("t"), fallback))
    assert [tuple(s[d] for d in C.DIMENSIONS) for s in scores] == [
        (4, 2, 1, 5), (3, 2, 3, 5), (3, 1, 3, 3), (3, 2, 3, 5), (3, 2, 3, 5), (3, 2, 3, 5), (4, 4, 3, 5),
    ]
    assert scores[0].rationale == "r" and scores[1].rationale == "heuristic"


def test_number_rules_differ(spark):
    reply = "see 1111111111 or 2222222222"
    df = spark.createDataFrame([(reply, "1111111111"), (reply, "none")], "t string, corpus string")
    rows = df.select(
        replies.ungrounded_numbers(F.col("t"), F.col("corpus")).alias("any_missing"),
        judging.judge_heuristic(F.col("t"), F.col("corpus"))["groundedness"].alias("g"),
    ).collect()
    assert [(r.any_missing, r.g) for r in rows] == [(True, 3), (True, 1)]


def test_prompts(spark):
    history = F.array(F.struct(F.lit("first").alias("text")), F.struct(F.lit("second").alias("text")))
    df = spark.range(1)
    prompt = df.select(replies.render_prompt(F.lit("ACME"), F.lit("hi"), F.lit("other"), history, F.lit("")).alias("p")).first().p
    assert "support agent for ACME" in prompt[0].content
    assert "Previous turn (if any): none" in prompt[1].content and "- first\n- second\n" in prompt[1].content
    rubric = df.select(replies.render_rubric(F.array().cast("array<struct<text:string>>"), F.lit("x"), F.lit("y"), F.lit("z")).alias("p")).first().p
    assert "Retrieved history:\nNo history\n" in rubric and '{"groundedness": int' in rubric
    assert not re.search(r"\{(retrieved|intent|customer|draft)\}", rubric)


@pytest.mark.parametrize("intent,expected", [("refund_billing", "charge"), ("unknown", "reaching out"), (None, "reaching out")])
def test_template(spark, intent, expected):
    row = spark.createDataFrame([(intent,)], "i string").select(replies.template_reply(F.col("i")).alias("r")).first()
    assert expected in row.r
