import random

import pytest
from pyspark.sql import functions as F

from threadlens.operators import brands, splits, threads
from threadlens.plans.skew import skew_lookup

SCHEMA = "tweet_id string, author_id string, inbound boolean, created_at timestamp, text string, in_response_to_tweet_id string, ingest_seq long"


def messages(spark, rows):
    """rows of (id, author, inbound, parent)"""
    return spark.createDataFrame(
        [(i, a, b, None, f"text {i}", p, n) for n, (i, a, b, p) in enumerate(rows)], SCHEMA)


MINI = [("0", "brand", False, None), ("1", "cust", True, "0"), ("2", "brand", False, "1"), ("3", "cust", True, "0"),
        ("4", "brand", False, "3")]


def test_mini_thread(spark):
    m = messages(spark, MINI)
    pairs = threads.conversation_pairs(m, "brand").orderBy("customer_tweet_id").collect()
    assert [(p.customer_tweet_id, p.brand_tweet_id, p.conversation_id, p.turn) for p in pairs] == [("1", "2", "0", 1), ("3", "4", "0", 1)]
    assert threads.brand_inbound(m, "brand").count() == 2
    assert threads.conversation_pairs(m, "nobody").count() == 0
    bad = messages(spark, [("0", "brand", False, "not-an-id")] + MINI[1:])
    assert threads.conversation_pairs(bad, "brand").count() == 2


def test_first_reply_and_first_copy_win(spark):
    m = messages(spark, [("1", "c", True, None), ("2", "b", False, "1"), ("3", "b", False, "1"), ("1", "c", True, "2")])
    rows = threads.conversation_pairs(m).collect()
    assert [(r.customer_tweet_id, r.brand_tweet_id, r.conversation_id) for r in rows] == [("1", "2", "1")]


def climb(parents, start):
    cur = start
    for _ in range(5):
        p = parents.get(cur)
        if p is None or not p.isdigit() or p not in parents:
            return cur
        cur = p
    return cur


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_roots_match_brute_force(spark, hot_rows):
    rng = random.Random(7)
    parents = {str(i): (None if i == 1 or rng.random() < .1 else "x" if rng.random() < .05
                        else str(1 if rng.random() < .4 else rng.randrange(max(1, i - 6), i + 3))) for i in range(1, 200)}
    m = messages(spark, [(i, "a", True, p) for i, p in parents.items()])
    got = {r[0]: r[1] for r in threads.thread_roots(m, hot_rows=hot_rows).collect()}
    assert got == {i: climb(parents, i) for i in parents}


def test_skew_lookup_matches_plain_join(spark):
    facts = spark.range(3000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 7 == 0, F.lit("gone")).when(F.col("id") % 5 != 0, F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
    dim = spark.range(40).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")) \
        .union(spark.createDataFrame([("hot", -1)], "k string, v long"))
    for how in ("left", "inner"):
        want = facts.join(dim, facts.key == dim.k, how).select("row", "key", "v")
        for hot in (None, 100, 10**9):
            got = skew_lookup(facts, dim, "key", "k", spread="row", how=how, hot_rows=hot, max_hot=2)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hot_rows_are_spread(spark):
    """A third of the rows under one key, a third under null: no shuffled key exceeds a small share."""
    facts = spark.range(3000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 3 == 1, F.concat(F.lit("k"), "id")).alias("key"))
    dim = facts.where("key is not null").select(F.col("key").alias("k")).distinct().withColumn("v", F.lit(1))
    out = skew_lookup(facts, dim, "key", "k", spread="row", hot_rows=500)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = skew_lookup(facts, dim, "key", "k", spread="row", hot_rows=500)
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        keys = [x for x in plan.splitlines() if "hashpartitioning(struct(" in x or "hashpartitioning(named_struct(" in x]
        assert keys and any("salt" in x for x in keys), plan  # rows are dealt out by key and salt together
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.where("key = 'hot' and v = 1").count() == 1000 and out.where("key is null and v is null").count() == 1000


def test_brand_table_and_scores(spark):
    rows = MINI + [("5", "other", False, None), ("6", "c2", True, "5"), ("6", "c2", True, "5"), ("7", "c3", True, "99")]
    m = messages(spark, rows)
    table = {r.brand: (r.outbound_tweets, r.inbound_msgs, r.conversations) for r in brands.brand_table(m).collect()}
    assert table == {"brand": (3, 2, 1), "other": (1, 2, 1)}
    full = brands.usable_pairs(m, brands.brand_table(m))
    got = {r.brand: (r.usable_pairs, r.reply_rate) for r in full.collect()}
    assert got == {"brand": (2, 1.0), "other": (0, 0.0)}
    scored = brands.brand_scores(full, min_inbound=1)
    assert brands.select_brand(scored).first().brand == "brand"
    with pytest.raises(Exception, match="No brands"):
        brands.select_brand(brands.brand_scores(full, min_inbound=1000)).collect()


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = threads.dedup_keep_first(messages(spark, MINI))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_observed_drop(spark):
    from pyspark.sql import Observation
    df = spark.createDataFrame([("",), ("abc",), ("abcdef",)], "clean_text string")
    assert [r[0] for r in splits.drop_empty(df, 5, "dropping").collect()] == ["abcdef"]
    assert Observation  # names are resolved by listeners; the rows are what matters here


def test_wide_hot_rows_take_the_shuffle_path(spark):
    facts = spark.range(100).select(F.col("id").alias("row"), F.lit("hot").alias("key"))
    dim = spark.createDataFrame([("hot", "x" * 100_000)], "k string, v string")
    got = skew_lookup(facts, dim, "key", "k", spread="row", hot_rows=10)
    assert got.where(F.length("v") == 100_000).count() == 100


def test_looser_inbound_variant_and_preparation(spark):
    rows = MINI + [("1", "cust", True, "0"), ("9", "brand", True, None), ("10", "cust", True, "9")]
    m = messages(spark, rows)
    assert threads.brand_inbound(m, "brand").count() == 2
    assert threads.brand_inbound(m, "brand", dedup=False, outbound_only=False).count() == 4
    inbound = threads.conversation_proxy(threads.brand_inbound(m))
    prepared = splits.prepare_splits(inbound, sample_n=10)
    assert {r.tweet_id for r in prepared.collect()} == {"1", "3"}
    assert prepared.columns == ["tweet_id", "clean_text", "intent", "conversation_id", "split"]
