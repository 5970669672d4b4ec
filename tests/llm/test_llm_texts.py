"""Near-duplicates, repeated passages, boilerplate lines and quality rules next to brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_brute as brute
from replyscope.llm import line_dedup, minhash, quality_rules, substring
from replyscope.llm.common import window_hashes, word_hashes
from replyscope.llm.components import components

SF = "/root/testdata/sf0.001"


def corpus(seed=1):
    """Texts with exact and near copies, shared passages, ties, tiny and very long ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 20, 80, 300]))] for _ in range(40)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    out = [*base, [*base[6]], [*base[9]]]
    for _ in range(60):
        copy = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(copy) // 12))):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        at = rng.randrange(len(copy) + 1)
        out.append(copy[:at] + passage[: rng.choice([0, 0, 49, 50, 70])] + copy[at:])
    texts = [rng.choice([" ", "\n", "\t "]).join(w) for w in out]
    texts += ["", "   ", None, "word", "WORD", "Word word", "x " * 30_000, "x " * 120, "É é", "é É"]
    rng.shuffle(texts)
    return list(enumerate(texts, start=3))


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    rows = corpus(size)
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], "doc_id long, text string, key string, component int").repartition(7)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, shingle=size, block=300).collect()}
    want = brute.near_duplicates(rows, size)
    assert got == {k: (n, c, c == k) for k, (n, c) in want.items()}


def test_near_duplicates_null_keys_repeats_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (9, text), (7, None), (5, "another text")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in minhash.near_duplicates(df).collect())
    assert got == [("5", 1, "5", True), ("5", 36, "5", True), ("5", 36, "5", True), ("7", 0, "7", True), ("9", 36, "5", False), ("None", 36, "None", True)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_registers_are_those_of_the_bucket_minimum():
    rng = np.random.default_rng(3)
    for n in (1, 3, 100, 5_000):
        s = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        got = minhash.registers(s)
        lows = {}
        for x in s.tolist():
            bucket, low = x >> 57, x & ((1 << 57) - 1)
            lows[bucket] = min(low, lows.get(bucket, low))
        for bucket, low in lows.items():
            length = low.bit_length()
            mantissa = (low >> (length - 11) if length >= 11 else low << (11 - length)) & 1023 if length else 0
            assert got[bucket] == ((57 - length) << 10 | mantissa)
        assert set(got.tolist()) <= {int(got[b]) for b in lows}


def test_estimate_is_close_and_corrected():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 64, 60_000, dtype=np.uint64)
    for share in (0.0, 0.5, 0.8, 1.0):
        n = 10_000
        common = int(round(2 * n * share / (1 + share)))
        a, b = np.unique(pool[:n]), np.unique(pool[n - common : 2 * n - common])
        equal = (minhash.registers(a) == minhash.registers(b)).sum()
        assert abs(minhash.estimate(np.array([equal]), np.array([n]), np.array([n]))[0] - share) < 0.2


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (160, 100)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("window,prefix,group", [(50, 10, 400), (50, 10, 2), (6, 3, 1)])
def test_repeats_equal_brute_force(spark, window, prefix, group):
    rows = corpus(window + group)
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, prefix string").repartition(5)
    out = substring.remove_repeats(df, window, prefix, group)
    assert out.columns == ["doc_id", "text", "prefix", "n_words", "n_removed"]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"] or "") for r in out.collect()}
    assert got == brute.remove_repeats(rows, window)


def test_repeats_with_null_and_repeated_keys_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, text), (4, text), (4, text), (8, text), (9, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_removed"], r["text"] is None) for r in substring.remove_repeats(df).collect())
    assert got == [("4", 0, False), ("4", 0, False), ("8", 60, False), ("9", 0, True), ("None", 0, False)]
    assert substring.remove_repeats(df.limit(0)).count() == 0


def test_window_hashes_depend_on_order_and_content():
    w = word_hashes([b"a", b"b", b"a", b"b", b"b", b"a"])
    h = window_hashes(w, 2)
    assert h[0] == h[2] and len(set(h.tolist())) == 3 and len(window_hashes(w, 7)) == 0


@pytest.mark.parametrize("limit", [100_000, 0])
def test_line_dedup_equals_brute_force(spark, limit):
    rng = random.Random(4)
    rows = []
    for i in range(200):
        lines = [rng.choice(["menu", "footer |", "", "  ", "Überschrift", f"own {i}", "rare"]) for _ in range(rng.randint(1, 6))]
        rows.append((i, rng.choice(["a", "a", "a", "b", None, "once"]), "\n".join(lines)))
    rows += [(900, "a", None), (901, "c", ""), (902, "d", "menu\nmenu")]
    df = spark.createDataFrame([(k, s, t, 5) for k, s, t in rows], "doc_id long, source string, text string, n_lines int")
    out = line_dedup.drop_boilerplate(df, ratio=0.3, broadcast_lines=limit)
    assert out.columns == ["doc_id", "source", "text", "n_lines", "n_removed"]
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in out.collect()} == brute.drop_lines(rows, 0.3, 5)
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


def test_base_rules_equal_brute_force(spark):
    rows = corpus(9) + [(900, "a b c d e f g h " * 3 + "| # $"), (901, "L1 x\nL1 x\n\n\nL2\nL1 x"), (902, "ÀÉ 漢字 <b>&amp;</b> " * 6)]
    df = spark.createDataFrame([(k, t, "en", "clash") for k, t in rows], "doc_id long, text string, lang string, kept string")
    found = quality_rules.references(df)
    out = quality_rules.judge(df, found)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in out.collect()} == {k: brute.base_rules(t) for k, t in rows}
    assert out.filter("base_failed AND kept").isEmpty()
    assert quality_rules.judge(df.limit(0), quality_rules.references(df.limit(0))).count() == 0


def test_references_cover_all_documents_and_distance_is_jensen_shannon(spark):
    df = spark.createDataFrame([(1, "the cat. The dog", "en"), (2, "le chat", "fr"), (3, "the", None), (4, None, "en")], "doc_id long, text string, lang string")
    found = quality_rules.references(df, common=2)
    assert list(found["en"][1]) == [b"the", b"cat"] and found["en"][2].tolist() == [2, 1, 1]
    assert list(found[None][1])[0] == b"the" and found[None][2].sum() == 7
    p, q = np.array([1.0, 1.0]), np.array([1.0, 0.0])
    m = np.array([0.75, 0.25])
    want = np.sqrt((0.5 * np.log2(0.5 / m[0]) + 0.5 * np.log2(0.5 / m[1]) + np.log2(1 / m[0])) / 2)
    assert abs(quality_rules.jensen_shannon(p, q) - want) < 1e-12
    assert quality_rules.jensen_shannon(p, 3 * p) == 0 and quality_rules.jensen_shannon(p, np.zeros(2)) == 0


def test_quality_rules_reject_junk_and_keep_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality_rules.judge(docs, quality_rules.references(docs)).filter("NOT base_failed").join(labels, "doc_id")
    rates = {r["quality"]: r["kept"] for r in out.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert rates[1] > 0.98 and rates[0] < 0.2


def test_word_rule_rejects_other_languages_and_gibberish(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1")
    found = quality_rules.references(docs)
    good = docs.join(labels, "doc_id").select("doc_id", "text", "lang")
    good = quality_rules.judge(good, found).filter("kept AND n_words >= 50").select("doc_id", "text", "lang").collect()
    rng, letters = random.Random(5), "abcdefghijklmnopqrstuvwxyz"
    swapped = [(1, r["text"], "en" if r["lang"] != "en" else "de") for r in good]
    noise = [(2, " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(200)), lang) for lang in ("en", "de", "fr", "es")]
    out = quality_rules.judge(spark.createDataFrame(swapped + noise, "doc_id long, text string, lang string"), found)
    limits = {name: quality_rules.word_limit(reference) for name, reference in found.items()}
    rejected = [(r["doc_id"], r["word_distance"] > limits[r["lang"]]) for r in out.collect()]
    assert all(bad for k, bad in rejected if k == 2)
    assert sum(bad for k, bad in rejected if k == 1) > 0.95 * len(swapped)
