"""Threads, orders, splits and samples on edge cases."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from replyscope.operators import brands, metrics, ordering, sampling, splits
from replyscope.operators.chains import reply_chain_depth
from replyscope.operators.threads import build_threads
from replyscope.schemas import GOLDEN
from replyscope.sources import raw as R

RAW = "tweet_id string, author_id string, inbound boolean, created_at timestamp, text string, response_tweet_id string, in_response_to_tweet_id string, row_ord long"


def raw_frame(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RAW.replace("created_at timestamp", "created_at string"))
    return df.withColumn("created_at", F.try_to_timestamp("created_at")).withColumn("text_clean", F.coalesce("text", F.lit(""))).withColumn("brand", F.lit("b"))


def test_build_threads(spark):
    rows = [
        ("1", "u", True, "2017-01-01", "ask", "2,3", ""),
        ("2", "b", False, "2017-01-02", "reply two", "", "1"),
        ("3", "b", False, "2017-01-02", "reply three", "", "1"),
        ("4", "u", True, "2017-01-03", "no list", "", "2"),
        ("5", "u2", True, "2017-01-03", "customer answers", "", "4"),
        ("6", "b", False, "2017-01-04", "first outbound", "", "4"),
        ("7", "b", False, "2017-01-04", "second outbound", "", "4"),
        ("8", "u", True, None, "unknown list", "99", "77"),
        ("9", "b", False, "2017-01-05", "", "", "10"),
        ("10", "u", True, "2017-01-05", "empty reply", "9", ""),
        ("2", "b", False, "2017-01-06", "reply two, again", "", "1"),
        ("11", "u", True, "2017-01-06", "listed customer", " 5 ", ""),
    ]
    got = {r.tweet_id: (r.brand_reply, r.prev_turn, r.thread_len) for r in build_threads(raw_frame(spark, rows)).collect()}
    assert got == {
        "1": ("reply two, again", "", 2),
        "4": ("first outbound", "reply two, again", 3),
        "5": ("", "no list", 2),
        "8": ("", "", 1),
        "10": ("", "", 1),
        "11": ("customer answers", "", 2),
    }


def test_chain_depth(spark):
    rows = [(str(i), "u", True, None, "x", "", str(i - 1) if i else "") for i in range(37)]
    rows += [("a", "u", True, None, "x", "", "b"), ("b", "u", True, None, "x", "", "a"), ("z", "u", True, None, "x", "", "gone")]
    got = {r.tweet_id: r.depth for r in reply_chain_depth(raw_frame(spark, rows)).collect()}
    assert got == {**{str(i): i + 1 for i in range(37)}, "z": 1, "a": None, "b": None}


@pytest.mark.parametrize("n", [0, 1, 7, 150, 299, 300, 900])
def test_order_cut_is_exact(spark, monkeypatch, n):
    """A third of the rows has one and the same time."""
    monkeypatch.setattr(ordering, "LAST_BUCKET", 5)
    monkeypatch.setattr(ordering, "SMALL_N", 0)
    rng = random.Random(5)
    rows = [(str(i), 1_500_000_000 if i % 3 == 0 else 1_500_000_000 + rng.randrange(-9000, 9000)) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, s long").withColumn("created_at", F.timestamp_seconds("s"))
    first, rest = ordering.split_at(df, ordering.time_key(F.col("created_at"), F.col("id")), n)
    order = sorted(rows, key=lambda r: (r[1], hashlib.md5(r[0].encode()).hexdigest()))
    assert {r.id for r in first.collect()} == {r[0] for r in order[:n]}
    assert {r.id for r in rest.collect()} == {r[0] for r in order[n:]}


def test_order_cut_with_equal_keys(spark, monkeypatch):
    monkeypatch.setattr(ordering, "LAST_BUCKET", 2)
    df = spark.createDataFrame([("k", i % 4) for i in range(40)] + [("k", 9)] * 5, "k string, v int")
    first, rest = ordering.split_at(df, F.md5("k"), 13)
    assert first.count() == 13 and rest.count() == 32
    assert sorted(r.v for r in first.unionByName(rest).collect()) == sorted(r.v for r in df.collect())


def test_cutoff_split(spark):
    df = spark.createDataFrame([(str(i), f"2017-0{1 + i % 9}-01" if i % 5 else None) for i in range(50)], "tweet_id string, d string")
    df = df.withColumn("created_at", F.try_to_timestamp("d"))
    train, test = splits.time_split_cutoff(df, "2017-06-01", 0.2, min_test=5)
    assert train.filter("d >= '2017-06-01'").count() == 0 and test.filter("d < '2017-06-01'").count() == 0
    assert train.count() + test.count() == 40
    assert splits.time_split_cutoff(df, "2017-06-01", 0.2, min_test=5, null_dates="test")[1].filter("d is null").count() == 10
    train, test = splits.time_split_cutoff(df, "2017-06-01", 0.2, min_test=500)
    assert (train.count(), test.count()) == (40, 10) and test.filter("d is null").count() == 10
    train, test = splits.time_split_cutoff(df.withColumn("created_at", F.lit(None).cast("timestamp")), "2017-06-01", 0.21)
    assert (train.count(), test.count()) == (39, 11)


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_samples_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(500).select(F.col("id").cast("string").alias("tweet_id"), F.lit("order refund").alias("inbound_text"))
    expected = sorted((str(i) for i in range(500)), key=lambda k: hashlib.md5(f"3:{k}".encode()).hexdigest())[:40]
    got = [r.tweet_id for r in sampling.hash_sample_n(df.repartition(partitions), "tweet_id", 40, 3).collect()]
    assert sorted(got) == sorted(expected)
    picked = sampling.stratified_sample(df.repartition(partitions), 50)
    assert picked.count() == 50 and picked.select("tweet_id").distinct().count() == 50
    synth = R.synth_messages(spark, 300, 9, partitions).orderBy("tweet_id")
    assert [tuple(r) for r in synth.collect()] == [tuple(r) for r in R.synth_messages(spark, 300, 9, 3).orderBy("tweet_id").collect()]


def test_top_per_group_beyond_spark_limit(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).alias("g"), "id")
    got = ordering.top_per_group(df, ["g"], [F.desc("id")], 1200)
    assert got.groupBy("g").count().filter("count = 1200").count() == 2
    assert got.filter("g").agg(F.min("id")).first()[0] == 4998 - 3 * 1199


def test_brand_subset_without_targets(spark):
    rows = [("1", "u", True, None, "x", "", ""), ("2", "acme", False, None, "x", "", ""), ("3", "u", True, None, "x", "", "")]
    df = raw_frame(spark, rows)
    assert sorted(r.tweet_id for r in brands.brand_subset(df, "acme", 2).collect())[-1] in ("2", "3")
    assert brands.brand_subset(df, "acme", 3).count() == 3
    assert brands.brand_subset(df, "nobody", 2).count() == 2
    assert {r.brand for r in brands.brand_subset(df, None, 2).collect()} == {"mixed"}


def test_read_raw_defaults(spark, tmp_path):
    (tmp_path / "a.csv").write_text('tweet_id,text\n1,"hi @you, ""quoted"" https://x.y\nnext line"\n2,\n')
    rows = {r.tweet_id: r for r in R.read_raw(spark, str(tmp_path / "a.csv")).collect()}
    assert rows["1"].text_clean == 'hi @user , "quoted" [URL] next line'
    assert rows["2"].text_clean == "" and rows["2"].inbound and rows["2"].brand == "AmazonHelp"
    assert str(rows["2"].created_at).startswith("2017-01-01")


def test_jsonl_round_trip(spark, tmp_path):
    source = tmp_path / "g.jsonl"
    source.write_text('{"tweet_id": "1", "inbound_text": "größer", "thread_len": 2}\n\n{"tweet_id": "2", "escalate": true}\n', encoding="utf-8")
    golden = R.read_jsonl(spark, str(source), GOLDEN)
    assert golden.count() == 2
    R.write_jsonl(golden.coalesce(1), str(tmp_path / "out"))
    written = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("*.json"))
    assert "größer" in written


def test_alignment(spark):
    gold = spark.createDataFrame([("1", 1, "a"), ("2", 2, "b"), ("2", 3, "c")], "tweet_id string, row_ord int, intent string")
    pred = spark.createDataFrame([("2", 1, "x"), ("9", 2, "y")], "tweet_id string, row_ord int, intent string")
    assert [(r.gold_intent, r.pred_intent) for r in metrics.align_predictions(gold, pred).collect()] == [("c", "x")]
    other = pred.withColumn("tweet_id", F.concat(F.lit("p"), "tweet_id"))
    by_position = metrics.align_predictions(gold, other).orderBy("position").collect()
    assert [(r.gold_intent, r.pred_intent) for r in by_position] == [("a", "x"), ("b", "y")]
