"""Clashing names, odd rows, long runs of blanks, and whole-row brute force of learned operators."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from replyscope.llm import embedding, language_id, line_dedup, mixing, packing, quality_classifier, quality_rules, substring

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CLASHES = ["_host", "_lines", "_kept", "_copies", "_rows", "_copy", "row_a", "row_b", "_doc", "_ranges", "_print", "_text", "_letters", "_lang", "share_digit", "a.b", "doc", "column 3"]


def crowded(spark, rows):
    """Documents (doc_id, text, lang, source) with columns of internal names."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.toDF("doc_id", "text", "lang", "source").select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


def plain_docs(seed=2, n=120):
    rng = random.Random(seed)
    words = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(150)] for lang, letters in (("en", "abcdeth"), ("fr", "éèaçuxq"))}
    out = []
    for i in range(n):
        lang = rng.choice(["en", "fr"])
        body = rng.choice([" ", " ", "\n"]).join(rng.choices(words[lang], k=rng.choice([0, 3, 30, 90, 400])))
        out.append((i, f"menu line\n{body}", rng.choice([lang, lang, None]), rng.choice(["a.com", "b.com", None])))
    out += [(n, None, "en", "a.com"), (None, "menu line\nx y z", "fr", "b.com"), (3, "", None, None), (n + 1, "12 34 !!", "en", "a.com")]
    return out


def test_clashing_columns_change_nothing(spark):
    rows = plain_docs()
    alone = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    wide = crowded(spark, rows)
    model, references = language_id.train(alone), quality_rules.references(alone)
    rules = quality_classifier.RuleModel(0.1, (quality_classifier.Rule((("share_digit", True, 0.1),), 2.0),))
    runs = {
        "line_dedup": lambda df: line_dedup.drop_boilerplate(df),
        "line_dedup salted": lambda df: line_dedup.drop_boilerplate(df, broadcast_lines=0),
        "mix": lambda df: mixing.mix(df.filter("doc_id IS NOT NULL")),
        "repeats": lambda df: substring.remove_repeats(df, window=4, prefix=2),
        "language": lambda df: language_id.identify(df, model),
        "rules": lambda df: quality_rules.judge(df, references),
        "classifier": lambda df: quality_classifier.score(df, rules),
    }
    for name, run in runs.items():
        small, large = run(alone), run(wide)
        assert [c for c in large.columns if c not in CLASHES] == small.columns, name
        assert set(CLASHES) <= set(large.columns), name
        shown = lambda df: sorted(map(str, (tuple(r[c] for c in small.columns) for r in df.collect())))
        if name != "mix":  # which of equal lengths is taken may depend on the row
            assert shown(small) == shown(large), name
        kept = large.select(*[F.col(f"`{c}`") for c in CLASHES]).distinct().collect()
        assert [tuple(r) for r in kept] == [tuple(range(len(CLASHES)))], name
    assert mixing.mix(wide).count() > 0


def test_columns_named_like_results_are_replaced(spark):
    df = spark.createDataFrame([(1, "one two", "x", 9, 9)], "doc_id long, text string, source string, n_removed int, score int")
    out = substring.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "source", "score", "n_words", "n_removed"] and out.first()["n_removed"] == 0
    scored = quality_classifier.score(df, quality_classifier.RuleModel(0.0, ()))
    assert scored.columns == ["doc_id", "source", "n_removed", "score", "predicted"] and scored.first()["score"] == 0.5


@pytest.mark.parametrize("text", ["a" + " " * 1_100_000 + "b", "\n" * 1_100_000, "x" * 300_000, "one <|endoftext|> two" + "\t" * 2_000, " \n" * 600])
def test_packing_ids_are_those_of_tokenizers(spark, text):
    want = [*Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids, 0]
    assert [*packing.token_ids(text, RANKS), 0] == want
    rows = packing.pieces(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS, keep_ids=True).orderBy("piece").collect()
    assert [x for r in rows for x in r["ids"]] == want and max(r["length"] for r in rows) <= packing.MAX_TOKENS


def test_repeats_with_two_texts_of_one_key(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(70)) for x in "ab")
    for rows in ([(3, a), (5, a), (5, b)], [(3, a), (5, b), (5, a), (5, f"{b} tail"), (9, b)], [(5, a), (5, b), (7, f"{a} {b}")]):
        got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
        n = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in got.collect()}
        words = {text: text.split() for _, text in rows}
        want = set()
        for doc, text in rows:
            earlier = {tuple(words[t][i : i + 50]) for d, t in rows if d < doc for i in range(len(words[t]) - 49)}
            gone = {j for i in range(len(words[text]) - 49) if tuple(words[text][i : i + 50]) in earlier for j in range(i, i + 50)}
            want.add((doc, len(words[text]), len(gone)))
        assert n == want


def test_budgets_of_long_documents_are_fitted_exactly():
    fit = lambda lengths, budget, counts=None: int((mixing.fit_budget(np.array(lengths), np.array(counts or [1] * len(lengths)), budget) * lengths).sum())
    assert fit([70_000, 80_000, 90_000], 160_000) == 160_000
    rng = random.Random(1)
    for _ in range(20):
        lengths = sorted(rng.sample(range(50_000, 90_000), 7))
        sums = {sum(x for i, x in enumerate(lengths) if bits >> i & 1) for bits in range(128)}
        budget = rng.randrange(sum(lengths))
        near = min(abs(s - budget) for s in sums)
        room = max(mixing.LARGEST_SUM, 4 * lengths[-1])
        if budget <= room:  # nothing is taken by share
            assert abs(fit(lengths, budget) - budget) <= max(near, max(0, budget - max(s for s in sums if s <= budget)))


def test_vectors_of_other_lengths_are_linked_with_nothing(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.vstack([base, base * 2]))] + [(100, [1.0, 2.0]), (101, [1.0, 2.0]), (102, None), (103, [])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(got[i] == (0, i) for i in (100, 101, 102, 103)) and len(got) == len(rows)
    assert all(got[i][0] >= 1 and got[i + 30][1] == got[i][1] for i in range(30))


def test_labels_other_than_one_count_as_zero(spark):
    docs = spark.createDataFrame([(i, "good words here " * 20 if i % 3 == 1 else "#$ 1 2 3 " * 9) for i in range(90)], "doc_id long, text string")
    for values in ((0, 1, 2), (0, 2, 2), (7, 1, -1)):
        labels = docs.select("doc_id", F.element_at(F.array(*map(F.lit, values)), (F.col("doc_id") % 3 + 1).cast("int")).alias("quality"))
        model = quality_classifier.train(docs, quality_classifier.learnable(labels, F.lit(False)))
        got = {r["doc_id"] % 3: r["predicted"] for r in quality_classifier.score(docs, model).collect()}
        assert got == {0: 0, 1: int(values[1] == 1), 2: 0}


def test_language_equals_brute_force(spark):
    """Counts, smoothing and posteriors in plain Python integers and dictionaries."""
    rows = plain_docs(5)
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for df in [spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")] for r in language_id.identify(df, language_id.train(df)).collect()}

    def grams(text):
        plain = re.sub(" +", " ", "".join(c if "a" <= c <= "z" or ord(c) >= 170 else " " for c in f" {text.lower()} "))
        for order in (1, 2, 3):
            for i in range(len(plain) - order + 1):
                h = order
                for c in plain[i : i + order]:
                    h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 % 2**64
                    h ^= h >> 29
                yield h % 2**15

    counts, texts = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        if text is not None and lang is not None:
            counts[lang].update(grams(text))
            texts[lang] += 1
    for doc, text, _, _ in rows:
        name, score = got[doc, text]
        if text is None or not re.search(r"[^\W\d_]", text):
            assert (name, score) == ("und", 0.0)
            continue
        logs = {lang: math.log(texts[lang] / texts.total()) + sum(math.log((counts[lang][g] + 0.5) / (counts[lang].total() + 0.5 * 2**15)) for g in grams(text)) for lang in counts}
        best = max(sorted(logs), key=logs.get)
        assert name == best and abs(score - 1 / sum(math.exp(max(x - logs[best], -700)) for x in logs.values())) < 1e-4


def test_compiled_rules_equal_rules_applied_in_python(spark):
    rng = random.Random(3)
    names = list(quality_classifier.FEATURES)
    rows = plain_docs(8)
    table = quality_classifier.statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    rules = []
    for _ in range(40):
        tests = []
        for name in rng.sample(names, rng.randint(1, 3)):
            tests.append((name, rng.random() < 0.5, rng.choice(table)[name]))
        rules.append(quality_classifier.Rule(tuple(tests), rng.uniform(-2, 2)))
    model = quality_classifier.RuleModel(-0.3, tuple(rules))
    got = quality_classifier.score(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), model).collect()
    want = []
    for row in table:
        total = model.intercept
        for rule in rules:
            if all((row[name] > limit) == above for name, above, limit in rule.tests):
                total += rule.weight
        want.append(round(1 / (1 + math.exp(-total)), 9))
    assert sorted(round(r["score"], 9) for r in got) == sorted(want)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_rule_statistics_equal_plain_python(spark):
    for _, text, _, _ in plain_docs(9):
        words = (text or "").split()
        row = dict(zip(quality_classifier.FEATURES, quality_classifier._statistics((text or "").encode())))
        assert row["share_digit"] == pytest.approx(sum(c in "0123456789" for c in text or "") / max(len(text or ""), 1))
        assert row["share_lower"] == pytest.approx(sum("a" <= c <= "z" for c in text or "") / max(len(text or ""), 1))
        values = quality_classifier._statistics((text or "").encode())[-7:]
        assert values[0] == pytest.approx(math.log1p(len(words))) and values[2] == pytest.approx(len(set(words)) / max(len(words), 1))


def test_quality_verdicts_equal_brute_force(spark):
    rows = plain_docs(11, 200)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {(r["doc_id"], r["text"]): r for r in quality_rules.judge(df, quality_rules.references(df)).collect()}
    kinds = [("lower", lambda c: "a" <= c <= "z"), ("upper", lambda c: "A" <= c <= "Z"), ("letter", lambda c: ord(c) >= 0xC0), ("digit", lambda c: c in "0123456789"),
             ("space", lambda c: c in " \t\v\f\r"), ("newline", lambda c: c == "\n"), ("stop", lambda c: c in ".,;:"), ("symbol", lambda c: c in "#*$%&|<>"),
             ("punctuation", lambda c: c in "!\"'()-/?@[\\]^_`{}~+=")]
    classes = lambda text: Counter(next((k for k, f in kinds if f(c)), "other") for c in text or "")
    plain = lambda text: [w for x in (text or "").split() if (w := x.strip(".,;:!?\"'()").lower())]
    by_class, by_word = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, _ in rows:
        for name in {lang, None}:
            by_class[name].update(classes(text))
            by_word[name].update(plain(text))

    def distance(p, q):
        if not p.total() or not q.total():
            return 0.0
        parts = 0.0
        for k in {*p, *q}:
            a, b = p[k] / p.total(), q[k] / q.total()
            parts += sum(x * math.log2(2 * x / (a + b)) for x in (a, b) if x > 0)
        return math.sqrt(max(0.0, parts / 2))

    for doc, text, lang, _ in rows:
        row = got[doc, text]
        words = (text or "").split()
        common = [w for w, _ in sorted(by_word[lang].items(), key=lambda x: (-x[1], x[0].encode()))[:50]]
        shared = lambda c: Counter({w: n for w, n in c.items() if w in common} | {None: sum(n for w, n in c.items() if w not in common)})  # noqa: E731, B023
        far_class = distance(classes(text), by_class[lang]) if len(text or "") >= quality_rules.MIN_CHARS else None
        far_word = distance(shared(Counter(plain(text))), shared(by_word[lang])) if len(words) >= quality_rules.MIN_WORDS else None
        for name, want in (("class_distance", far_class), ("word_distance", far_word)):
            assert (row[name] is None) == (want is None) and (want is None or row[name] == pytest.approx(want, abs=1e-7)), (name, lang)
        bare = distance(Counter({None: 1}), shared(by_word[lang]))
        most = min(quality_rules.MAX_WORD_DISTANCE, quality_rules.MAX_WORD_SHARE * bare) if bare > 0 else quality_rules.MAX_WORD_DISTANCE
        edge = min(abs((far_word or 0) - most), abs((far_class or 0) - quality_rules.MAX_CLASS_DISTANCE)) < 1e-6
        fine = not row["base_failed"] and (far_class or 0) <= quality_rules.MAX_CLASS_DISTANCE and (far_word or 0) <= most
        assert row["kept"] == fine or edge
    assert len({r["kept"] for r in got.values()}) == 2


def test_host_of_pages(spark):
    pages = spark.createDataFrame([(f"https://News.example.org/p/{i}", f"Footer\npage {i}") for i in range(8)] + [("no address", "Footer\nx"), (None, "Footer")], "url string, html string")
    out = line_dedup.drop_boilerplate(pages.withColumn("host", line_dedup.host_of("url")), host="host", text="html")
    assert {r["html"] for r in out.filter("host = 'news.example.org'").collect()} == {f"page {i}" for i in range(8)}
    assert {r["html"] for r in out.filter("host IS NULL").collect()} == {"Footer\nx", "Footer"}


@pytest.mark.parametrize("group", [1, 3, 40])
def test_repeats_with_groups_divided_by_longer_prefixes(spark, group):
    """One common run of words in many different texts fills a group."""
    rng = random.Random(group)
    common, words = [f"c{i}" for i in range(14)], [f"w{i}" for i in range(9)]
    shared = [rng.choice(words) for _ in range(26)]
    rows = []
    for i in range(60):
        head, tail = rng.choices(words, k=rng.randint(0, 12)), rng.choices(words, k=rng.randint(0, 12))
        rows.append((i, " ".join([*head, *common, *(shared[: rng.choice([0, 12, 26])]), *tail])))
    rows += [(60, rows[5][1]), (61, rows[7][1] + " " + rows[9][1]), (7, rows[30][1])]
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=20, prefix=4, group=group).collect()}
    want = set()
    for doc, text in rows:
        w = text.split()
        earlier = {tuple(o.split()[i : i + 20]) for d, o in rows if d < doc for i in range(len(o.split()) - 19)}
        gone = {j for i in range(len(w) - 19) if tuple(w[i : i + 20]) in earlier for j in range(i, i + 20)}
        want.add((doc, len(w), len(gone)))
    assert got == want and sum(n for _, _, n in want) > 100
