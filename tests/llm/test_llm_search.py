"""Prefix tries, token counts and ranked search next to brute force."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import llm_brute as brute
from replyscope.llm import conversation_trie, lexical_search, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
TURNS = "conv_id long, turn long, role string, text string, depth int, head_a string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def talks(seed, n=260):
    """Conversations with few different turns, copies, hot beginnings and long ones."""
    rng = random.Random(seed)
    said = [("user", "hi"), ("assistant", "héllo"), ("user", ""), (None, "x"), ("user", None), ("system", "be kind")]
    out = []
    for conv in range(n):
        turns = [said[0]] * rng.randint(0, 2) + [rng.choice(said) for _ in range(rng.choice([1, 1, 2, 3, 5, 9]))]
        if conv % 50 == 7:
            turns = [said[1]] * 30 + turns
        out += [(conv + 95, turn if turn else None, *t, 1, "clash") for turn, t in enumerate(turns)]
    out += [(-5, 1, "user", "hi", 1, ""), (-5, 1, "user", "hi", 1, ""), (-5, 1, "assistant", "a", 1, ""), (None, 1, "user", "lost", 1, "")]
    rng.shuffle(out)
    return out


def nodes(spark, rows, regrown=True, **options):
    turns = conversation_trie.turns_of(spark.createDataFrame(rows, TURNS).repartition(5))
    if regrown:
        found, convs = conversation_trie.regrown(turns)
    else:
        found, convs = turns.withColumn("depth", turns["at"] + 1), turns.groupBy("conv").count().withColumnRenamed("count", "n")
    got = conversation_trie.prefix_trie(found, convs, **options)
    return sorted(map(str, (tuple(r[c] for c in COLUMNS) for r in got.collect())))


@pytest.mark.parametrize("segment, container", [(64, 4096), (4, 6), (1, 3)])
def test_trie_equals_brute_force(spark, segment, container):
    rows = talks(segment)
    want = brute.trie(brute.regrow([r[:4] for r in rows]))
    assert nodes(spark, rows, segment=segment, container=container) == sorted(map(str, want))


def test_trie_of_copies_turnless_and_no_conversations(spark):
    copies = [(c, t, "user", f"turn {t}", 0, "") for c in range(300) for t in range(6)]
    plain = {c: [("user", f"turn {t}") for t in range(6)] for c in range(300)}
    assert nodes(spark, copies, False, segment=4, container=2) == sorted(map(str, brute.trie(plain)))
    alone = [(109, 0, "user", "cut away", 0, "")]  # no conversation 100, and h is not 0
    assert brute.regrow([r[:4] for r in alone]) == {109: []}
    assert nodes(spark, alone) == sorted(map(str, brute.trie({109: []})))
    assert nodes(spark, [r for r in alone if r[0] is None]) == []


def test_token_counts_equal_the_library(spark):
    tokenizer = Tokenizer.from_file(WORDS)
    texts = ["", None, "Hello, WORLD's end", "<|endoftext|> a<|startoftext|>", "Straße Élan ñandú ½ ²", "漢字 かな 한국어 😀😀", "İI ŉ ΑΣ ς", "a\x1cb\x85c\xa0d",
             "word " * 60_000, "x" * 200_000, " " * 300_000, "\n" * 200_000, "é" * 70_000 + " end", "the the the", "the the the"]
    rows = [(i if i != 3 else None, t, 1, "n") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, key string").repartition(4)
    got = sorted(map(str, (tuple(r) for r in token_counts.count_tokens(df, WORDS).collect())))
    count = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    want = [(i, len((t or "").encode()), count(t), count(t) > 2048) for i, t, _, _ in rows]
    assert got == sorted(map(str, want))
    assert token_counts.count_tokens(df.limit(0), WORDS).count() == 0
    assert sorted(map(str, (tuple(r) for r in token_counts.count_tokens(df, WORDS, sample=0).collect()))) == sorted(map(str, want))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("ab'sTl 1²Éß\n\x85<|>̇İ"))), max_size=40))
def test_token_counts_of_random_text(text):
    own = token_counts.pre_tokens(WORDS)
    assert own.count(text, own.length) == len(Tokenizer_.encode(text, add_special_tokens=False).ids)


Tokenizer_ = Tokenizer.from_file(WORDS)


def test_long_texts_are_cut_at_blanks_only(monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE", 5)
    own = token_counts.pre_tokens(WORDS)
    for text in ("it's a long  text, isn't it?\tyes\nno", "abcdefghijklmnop'll", "é" * 50 + " " + "漢" * 40 + "<|endoftext|>x y z" * 5):
        assert own.count(text, own.length) == len(Tokenizer_.encode(text, add_special_tokens=False).ids)
        assert "".join(own.pieces(text)) == text


def library(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "naïve", "漢字", "X9", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [rng.choice([" ", ", ", "\n", "-"]).join(rng.choices(words, weights, k=rng.choice([0, 1, 2, 5, 30, 200]))) for _ in range(n)]
    texts += [texts[5]] * 40 + [None, "", " .,!", "w1 " * 20_000, "W1", "w1"]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 12, 40])))) for i in range(25)]
    items += [(3, "w1 w1 w5"), (None, "w2"), (50, None), (51, "..."), (52, "nowhere"), (53, texts[5]), (53, texts[5])]
    docs = [(i if i % 90 else None, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, "w50 w51")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("block, shard, seeds, probes", [(32, 8_192, 5_000, 3), (2, 50, 0, 1), (4, 100, 30, 2)])
def test_search_equals_brute_force(spark, monkeypatch, block, shard, seeds, probes):
    for name, value in (("BLOCK", block), ("SHARD", shard), ("SEEDS", seeds), ("PROBES", probes), ("PAIRS", 5_000), ("ROWS", 64)):
        monkeypatch.setattr(lexical_search, name, value)
    docs, items = library(block)
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, row int, terms string").repartition(6)
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, item int")
    got = lexical_search.search(df, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute.search(docs, items)))


def test_search_in_several_blocks_of_items_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "ITEMS", 6)
    docs, items = library(9, 60)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(str, map(tuple, lexical_search.search(df, asked, k=3).collect()))) == sorted(map(str, brute.search(docs, items, 3)))
    assert lexical_search.search(df.limit(0), asked).count() == lexical_search.search(df, asked.limit(0)).count() == 0
    assert lexical_search.search(df.filter("text IS NULL"), asked).count() == 0


def test_search_skips_blocks(spark, monkeypatch):
    """Once the best blocks are scored, most others can't hold a better document."""
    monkeypatch.setattr(lexical_search, "BLOCK", 8)
    monkeypatch.setattr(lexical_search, "SEEDS", 0)  # no floor from rare terms
    rng = random.Random(4)
    whole = lambda i: " ".join(f"t{i % 20}_{n}" for n in range(4))
    docs = [(i, whole(i) if i < 300 else f"t{i % 20}_{rng.randrange(4)} " + " ".join(f"n{rng.randrange(50)}" for _ in range(30))) for i in range(2_000)]
    items = [(j, whole(j)) for j in range(20)]
    bounds, scored, reached, read = lexical_search._bounds, lexical_search._scored, [], []

    def all_bounds(*args):
        reached.append(bounds(*args).count())
        return bounds(*args)

    def some_scored(asked, *args):
        read.append(asked.count())
        return scored(asked, *args)

    monkeypatch.setattr(lexical_search, "_bounds", all_bounds)
    monkeypatch.setattr(lexical_search, "_scored", some_scored)
    got = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute.search(docs, items)))
    assert 0 < sum(read) < 0.6 * sum(reached)
