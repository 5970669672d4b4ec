"""Packing, mixing, language, archives, vectors, classifier and pipeline."""

import base64
import glob
import inspect
import gzip
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import llm_brute as brute
from replyscope.llm import embedding, language_id, line_dedup, minhash, mixing, packing, quality_classifier, warc
from replyscope.llm.common import remainder
from replyscope.llm.queries import ENTRIES

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def byte_bpe():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected_pieces(rows, limit):
    tokenizer, out = byte_bpe(), []
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        count = -(-len(ids) // limit)
        first = len(ids) - limit * (count - 1)
        bounds = [0, *range(first, len(ids) + 1, limit)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            out.append((key, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    return out


def check_layout(rows, limit):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in places.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= limit
    return len(places)


def test_packing_keeps_added_tokens(spark):
    rows = [(1, "one <|endoftext|> two"), (2, "<|endoftext|><|endoftext|>x"), (3, "a <|endoftext|"), (4, " \n<|endoftext|>\n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pieces(df, RANKS, keep_ids=True).collect()
    want = {k: [*byte_bpe().encode(text, add_special_tokens=False).ids, packing.END] for k, text in rows}
    assert {r["key"]: r["ids"] for r in got} == want and want[1][:-1] == [505, 220, 50256, 734]


@pytest.mark.parametrize("limit", [2048, 64])
def test_packing_equals_the_tokenizer_and_has_no_gaps(spark, limit):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = [(None, "null key"), (7_000, None), (7_001, ""), (7_002, "same"), (7_002, "same"), (7_003, " \n\t ünï 漢字 🙂 'll 1234 "), (7_004, "x" * 50_000)]
    df = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string")).withColumn("length", F.lit("clash"))
    got = packing.pack_documents(df, RANKS, limit, keep_ids=True).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + odd
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(expected_pieces(rows, limit), key=key)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    bound = -(-sum(r["length"] for r in got) // limit)
    assert check_layout(got, limit) <= bound * 1.03 + 2
    assert packing.pack_documents(df.limit(0), RANKS, limit).count() == 0


def test_tokenizers_agree_on_random_text():
    rng, plain, fast = random.Random(2), byte_bpe(), packing.encoder(RANKS)
    alphabet = [*"abc ABC 019.,'!?\n\t\r\v\f", "'s", "é", "ß", "漢", "🙂", " ", "​", "　", "﻿", "²", "ǅ", "́"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert fast.encode_ordinary(text) == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_pack_histogram_places_every_length():
    rng = np.random.default_rng(1)
    for case in range(6):
        counts = np.zeros(513, np.int64)
        counts[1:] = rng.integers(0, 40, 512) * (rng.random(512) < (0.1, 0.5, 1.0)[case % 3])
        if case > 3:
            counts[300:] = 0
        plan, seen = packing.pack_histogram(counts, 512), np.zeros(513, np.int64)
        for lengths, times in plan:
            assert sum(lengths) <= 512 and times > 0
            for n in lengths:
                seen[n] += times
        assert (seen == counts).all()


def test_least_squares_is_nonnegative_and_optimal():
    rng = np.random.default_rng(2)
    a, b = rng.random((6, 15)), rng.standard_normal(6) + 1
    x = packing.nonnegative_least_squares(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and (slope <= 1e-6).all() and np.abs(slope[x > 0]).max(initial=0) < 1e-6


def test_subset_sum_finds_the_largest_reachable_sum():
    rng = random.Random(3)
    for _ in range(60):
        lengths = np.array(rng.sample(range(1, 40), 5))
        counts = np.array([rng.randint(0, 3) for _ in lengths])
        budget = rng.randint(0, 120)
        reach = {0}
        for n, c in zip(lengths.tolist(), counts.tolist()):
            reach = {s + n * k for s in reach for k in range(c + 1)}
        take = mixing.subset_sum(lengths, counts, budget)
        assert (take <= counts).all() and (take * lengths).sum() == max(s for s in reach if s <= budget)


def mix_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", F.when(F.col("source") != "src3", F.col("source")).alias("source"))
    odd = [(None, "a b", "src1"), (9_001, None, "src1"), (9_002, " ", "zero"), (9_003, "x y z", "ünder"), (9_004, "same row", "src2"), (9_004, "same row", "src2")]
    return docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, source string")).withColumn("size", F.lit("clash"))


def test_mixing_meets_targets_and_repeats(spark):
    df = mix_rows(spark)
    rows = [(r["doc_id"], len(brute.words(r["text"])), r["source"]) for r in df.collect()]
    sizes = {}
    for _, n, source in rows:
        sizes[source] = sizes.get(source, 0) + n
    want = brute.targets(sizes)
    plan = mixing.mix_plan(df).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in plan) == sorted((str(k), n) for k, n, _ in rows)
    source_of = {r["doc_id"]: r["source"] for r in df.collect()}
    taken = {}
    for r in plan:
        source = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[source] and abs(r["target"] - want[source]) < 1e-6 * (1 + want[source])
        assert 0 <= r["copies"] <= 2 and (r["size"] or not r["copies"])
        taken[source] = taken.get(source, 0) + r["size"] * r["copies"]
    for source, total in sizes.items():
        assert abs(taken[source] - want[source]) <= max(2, 0.01 * total), source
    again = mixing.mix_plan(df.repartition(13)).collect()
    line = lambda r: (str(r["doc_id"]), r["size"], r["copies"])
    assert sorted(map(line, again)) == sorted(map(line, plan))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert sum(len(brute.words(r["text"])) for r in mixed.collect()) == sum(taken.values())
    assert mixing.mix_plan(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0


def test_language_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", remainder("doc_id", 4) == 2)
    model = language_id.train(docs.filter("NOT held_out"))
    assert set(model.languages) == {"de", "en", "es", "fr"}
    share = language_id.identify(docs, model).filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.97
    odd = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "123 ²½ !?", 9), (4, "the and of", 9), (4, "the and of", 9), (None, "der die das " * 200_000, 9)], "doc_id long, text string, score int")
    got = language_id.identify(odd, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    answers = [(r["doc_id"], r["lang_pred"], r["score"]) for r in got.collect()]
    assert answers[:3] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert [a[1] for a in answers[3:]] == ["en", "en", "de"] and all(0 <= a[2] <= 1 for a in answers)
    none = language_id.train(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language_id.identify(odd, none).collect()} == {"und"}


def test_language_score_is_the_posterior_and_slices_do_not_matter(spark, monkeypatch):
    docs = spark.createDataFrame([("aa bb", "x"), ("bb cc", "y"), ("cc dd", "y")], "text string, lang string")
    model = language_id.train(docs)
    text = "aa bb cc"
    total = model.log_prior + sum(model.log_probability[g].sum(axis=0, dtype=np.float64) for g in language_id._counters(text))
    want = np.exp(total - np.logaddexp.reduce(total))
    row = language_id.identify(spark.createDataFrame([(text,)], "text string"), model).first()
    assert row["lang_pred"] == model.languages[int(want.argmax())] and abs(row["score"] - want.max()) < 1e-9
    whole = np.sort(np.concatenate(list(language_id._counters(text * 50))))
    monkeypatch.setattr(language_id, "SLICE", 7)
    assert (np.sort(np.concatenate(list(language_id._counters(text * 50)))) == whole).all()


PAGES = [(1, "http://a/x y\r\nz", "<p>ä</p>"), (2, None, None), (3, "http://b", "<p>ä</p>"), (4, "u", ""), (5, "big", "é" * 700_000), (6, "u", "\r\n\r\nWARC/1.1"), (3, "http://b", "<p>ä</p>")]


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, tmp_path, least):
    df = spark.createDataFrame([*[(k, u, h, "clash") for k, u, h in PAGES], (None, "n", "<p>ä</p>", "clash")], "page_id long, url string, html string, refers_to string").repartition(3)
    written = warc.write_archives(warc.plan_records(df, least), str(tmp_path))
    got = warc.read_archives(written).collect()
    largest = {}
    for key, _, html in PAGES:
        largest[html or ""] = max(key, largest.get(html or "", 0))
    want = []
    for key, _, html in [*PAGES, (None, "n", "<p>ä</p>")]:
        payload = (html or "").encode()
        top = largest[html or ""]
        revisit = len(payload) >= least and key != top
        want.append((str(key), len(payload), brute.sha1_base32(payload), "revisit" if revisit else "response", top if revisit else None))
    fields = ("payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(str, ((str(r["page_id"]), *(r[f] for f in fields)) for r in got))) == sorted(map(str, want))
    by_key = {r["page_id"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert all(by_key[k].decode() == (h or "") for k, _, h in PAGES if k in by_key)
    names = [r["path"] for r in written.collect()]
    assert sum(gzip.open(n).read().count(b"WARC/1.1\r\nWARC-Type") for n in names) == len(want)
    assert warc.archive(df.limit(0), str(tmp_path / "none")).count() == 0


def test_warc_reader_refuses_damage(tmp_path):
    record = warc.record(1, "u", b"payload", brute.sha1_base32(b"payload"), None)
    whole = gzip.decompress(record)
    assert warc.parse(whole)[1] == b"payload"
    for damaged in (whole.replace(b"payload\r\n", b"paYload\r\n"), whole[:-5], whole.replace(b"Content-Length: 9", b"Content-Length: 8"), b"no record"):
        if damaged != whole:
            with pytest.raises((ValueError, KeyError)):
                warc.parse(damaged)
    path = tmp_path / "cut"
    path.write_bytes(record + record[:-9])
    with open(path, "rb") as stream, pytest.raises(ValueError):
        list(warc.members(stream))


def vectors(seed=1, clique=150):
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(16) for _ in range(300)]
    out += [out[i] + 0.1 * rng.standard_normal(16) for i in range(40)] + [out[3] * 7, out[3], out[5]]
    centre = rng.standard_normal(16)
    out += [centre + 0.12 * rng.standard_normal(16) for _ in range(clique)]
    return [(i * 3 + 1, v.tolist(), 1) for i, v in enumerate(out)]


def brute_links(rows):
    ids = [k for k, _, _ in rows]
    m = np.array([v for _, v, _ in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    link = m @ m.T >= 0.9
    np.fill_diagonal(link, False)
    groups = brute.Groups(ids)
    for a, b in zip(*np.nonzero(link)):
        groups.join(ids[a], ids[b])
    return {k: (int(link[i].sum()), groups.root(k)) for i, k in enumerate(ids)}


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 40)
    rows = vectors()
    odd = [(9_001, None, 1), (9_002, [0.0] * 16, 1), (9_003, [float("nan")] * 16, 1), (9_004, [float("inf")] + [1.0] * 15, 1), (9_005, [None] + [1.0] * 15, 1), (None, rows[0][1], 1)]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>, component int").repartition(5)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding.near_duplicates(df).collect()}
    want = {k: (n, c, c == k) for k, (n, c) in brute_links(rows).items()}
    assert got == want | {k: (0, k, True) for k, _, _ in odd}


def test_vectors_link_groups_larger_than_the_lists(spark):
    """Groups of 100 at cosine 0.92: no list of 64 leaves its group. In the last
    two only the outermost vectors are linked, not the leaders."""
    rng, eye, rows = np.random.default_rng(8), np.eye(16), []

    def group(centre, n, noise):
        for _ in range(n):
            v = centre + noise * rng.standard_normal(16)
            rows.append((len(rows), v.tolist(), 1))

    beside = 0.92 * eye[0] + np.sqrt(1 - 0.92**2) * eye[1]
    group(eye[0], 100, 1e-4), group(beside, 100, 1e-4)
    group(eye[4], 100, 0), group(0.92 * eye[4] + np.sqrt(1 - 0.92**2) * eye[5], 100, 0)
    for turn in (0.0, 0.53):  # two arcs of 0.1, between 0.43 and 0.63 apart; 0.451 is the angle of the threshold
        for at in np.linspace(turn, turn + 0.1, 100):
            group(np.cos(at) * eye[8] + np.sin(at) * eye[9], 1, 0)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int").repartition(5)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding.near_duplicates(df).collect()}
    want = brute_links(rows)
    assert {c for _, c in want.values()} == {0, 200, 400}
    assert got == {k: (n, c, c == k) for k, (n, c) in want.items()}


def test_vectors_audit_sees_lost_pairs_beside_a_large_group(spark):
    rng = np.random.default_rng(2)
    group = [np.eye(64)[0] + 1e-3 * rng.standard_normal(64) for _ in range(400)]
    pairs = [x for c in rng.standard_normal((60, 64)) for x in (c, c + 1e-3 * rng.standard_normal(64))]
    rows = [(i, (x / np.linalg.norm(x)).tolist()) for i, x in enumerate([*group, *pairs])]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    right = [(i, 0 if i < 400 else i - i % 2) for i, _ in rows]

    def audit(comp):
        return embedding._recall(df, spark.createDataFrame(comp, "node long, component long"), 0.9, len(rows))

    assert audit(right) == 1.0
    assert audit(right[:400]) == 0.0
    assert audit(right[:490]) < 0.9


def test_vectors_start_does_not_weaken_with_size():
    for count in (10**3, 10**5, 10**7, 10**8):
        shared = (1 - np.arccos(0.9) / np.pi) ** embedding._bits(count)
        assert 1 - (1 - shared) ** embedding.tables_needed(count, 0.9) >= 0.95


def test_vectors_empty_and_all_unusable(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in embedding.near_duplicates(df).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert embedding.near_duplicates(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in embedding.near_duplicates(one).collect()] == [(1, 0, 1, True)]


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept_back = remainder("doc_id", 3) == 1
    model = quality_classifier.train(docs, quality_classifier.learnable(labels, kept_back))
    assert 0 < len(model.rules) < 200
    out = quality_classifier.score(docs, model).join(labels.filter(kept_back), "doc_id")
    assert out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.95
    odd = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (None, "a " * 300_000, "c"), (2, "", "c")], "doc_id long, text string, score string")
    rows = quality_classifier.score(odd, model).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert rows[0]["score"] == rows[1]["score"] == rows[3]["score"]
    one_class = quality_classifier.learnable(labels.filter("quality = 1"), kept_back)
    assert quality_classifier.score(odd, quality_classifier.train(docs, one_class)).filter("predicted = 0").isEmpty()
    none = quality_classifier.train(docs, quality_classifier.learnable(labels.limit(0), kept_back))
    assert {r["score"] for r in quality_classifier.score(odd, none).collect()} == {0.5}


def test_pipeline_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(90_001, None, None, "src0", 0), (90_002, "12 34", None, None, 5)], docs.schema)
    docs = docs.unionByName(extra)
    stage = {name: fn for name, fn in corpus_pipeline.STAGES}
    assert list(stage) == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    first = stage["language_id"](spark, docs, SF).cache()
    assert first.columns == corpus_pipeline.COLUMNS and first.filter("doc_id > 90000").isEmpty()
    assert first.count() >= 0.98 * (docs.count() - 2)
    second = stage["line_dedup"](spark, first, SF).cache()
    want = brute.drop_lines([(r["doc_id"], r["source"], r["text"]) for r in first.collect()], line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in second.collect()} == {k: (t, len(t)) for k, (_, _, t) in want.items()}
    third = stage["near_dedup"](spark, second, SF).cache()
    groups = brute.near_duplicates([(r["doc_id"], r["text"]) for r in second.collect()], 5)
    assert {r["doc_id"] for r in third.collect()} == {k for k, (_, c) in groups.items() if c == k}
    fourth = stage["mixing"](spark, third, SF).cache()
    assert fourth.columns == corpus_pipeline.COLUMNS
    size = lambda df: sum(len(brute.words(r["text"])) for r in df.collect())
    assert abs(size(fourth) - 1.5 * size(third)) < 0.05 * size(third)
    last = stage["packing"](spark, fourth, SF).collect()
    pieces = sorted(expected_pieces([(r["doc_id"], r["text"]) for r in fourth.collect()], packing.MAX_TOKENS))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in last) == pieces
    check_layout(last, packing.MAX_TOKENS)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in ENTRIES if n.startswith("op")) == list(range(1, 14)) and "pipeline" in ENTRIES


def test_near_dedup_uses_the_stated_defaults():
    stated = inspect.signature(minhash.near_duplicates).parameters
    assert (stated["shingle"].default, stated["percent"].default) == (5, 80)
    assert base64.b32decode(brute.sha1_base32(b"")) and not glob.glob("/root/repo/**/*.warc.gz", recursive=True)
