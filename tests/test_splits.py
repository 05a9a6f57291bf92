import hashlib

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from threadlens.operators import splits
from threadlens.plans.hash_order import cut_keys, hash_sample


def order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


def test_split_sizes_and_membership(spark):
    keys = [f"c{i}" for i in range(137)]
    rows = spark.createDataFrame([(k, n) for k in keys for n in range(3)] + [("c0", 9)] * 500, "conversation_id string, n int")
    out = splits.conversation_split(rows, width=1)
    got = {}
    for r in out.select("conversation_id", "split").distinct().collect():
        assert r[0] not in got, "a conversation sits in two splits"
        got[r[0]] = r[1]
    n_train, n_val = int(137 * .7), int(137 * .15)
    ranked = order(keys)
    assert got == {k: "train" if i < n_train else "validation" if i < n_train + n_val else "test" for i, k in enumerate(ranked)}
    assert out.count() == rows.count()


def test_sample_matches_full_sort(spark):
    ids = [str(i) for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids], "tweet_id string")
    for n in (0, 1, 77, 500, 900):
        got = {r[0] for r in hash_sample(df, n, "tweet_id").collect()}
        assert got == set(order(ids)[:n])
    assert splits.reproducible_sample(df, 5, clamp=(50, 60)).count() == 50


def test_cut_of_empty_table(spark):
    empty = spark.createDataFrame([], "tweet_id string")
    assert cut_keys(empty, "tweet_id", {"last": lambda n: 3}) == {"last": None}
    assert hash_sample(empty, 3, "tweet_id").count() == 0


def test_cuts_refine_until_few_keys_are_left(spark):
    """A million keys: no task ranks more than a few thousand, whatever the first bucket holds."""
    keys = spark.range(1_000_000).select(F.col("id").cast("string").alias("k"))
    ranked = order(str(k) for k in range(1_000_000))
    places = {"a": 1, "b": 700_000, "c": 999_999, "d": 2_000_000}
    for width, most in ((1, 500), (3, 4096)):
        sizes = []
        cuts = cut_keys(keys, "k", {n: (lambda total, p=p: p) for n, p in places.items()}, width=width, most=most, sizes=sizes)
        assert {n: k for n, (_, k) in cuts.items()} == {n: ranked[min(p, 1_000_000) - 1] for n, p in places.items()}
        assert max(sizes) <= most


def test_dropped_rows_are_counted_by_the_job(spark):
    rows = spark.createDataFrame([("hello there",), ("hi",), ("",), (None,)], "clean_text string")
    counts = Observation()
    assert splits.drop_empty(rows, 5, counts).count() == 1
    assert counts.get == {"kept": 1, "dropped": 3}
    again = Observation("labelled")
    assert splits.label_messages(rows.withColumnRenamed("clean_text", "text"), 1, again).count() == 2
    assert again.get == {"kept": 2, "dropped": 2}


def test_leaks_are_named_and_end_the_build(spark):
    rows = spark.createDataFrame([("a", "train", "same text"), ("b", "train", "x"), ("c", "validation", "same text"), ("d", "test", "y"), ("b", "test", "x"), (None, "test", None)],
                                 "conversation_id string, split string, clean_text string")
    pairs = spark.createDataFrame([("a", 1), ("d", 2)], "conversation_id string, n int")
    gold = spark.createDataFrame([("a",), ("",)], "conversation_id string")
    assert {tuple(r) for r in splits.leaked_conversations(pairs, rows, gold).collect()} == {
        ("train_test_overlap", "b"), ("indexed_test_overlap", "d"), ("indexed_golden_overlap", "a")}
    assert {tuple(r)[1:] for r in splits.shared_texts(rows).collect()} == {(1, 1, 0, 2), (1, 0, 1, 1)}
    with pytest.raises(Exception, match="leakage: "):
        splits.leakage_audit(pairs, pairs, rows, gold, fail=True).collect()
    clean = rows.where("conversation_id in ('a', 'c')")
    assert splits.leakage_audit(pairs, pairs.where("n = 1"), clean, fail=True).count() == 7


def test_evidence_and_audit(spark):
    rows = spark.createDataFrame([("a", "train"), ("b", "train"), ("c", "validation"), ("d", "test")], "conversation_id string, split string")
    pairs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), ("d", 5), ("z", 6)], "conversation_id string, n int")
    gold = spark.createDataFrame([("b",), ("",)], "conversation_id string")
    indexed = splits.evidence_candidates(pairs, rows, gold, key="n", hot_rows=2)
    assert sorted(r.n for r in indexed.collect()) == [1, 2]
    audit = {r.check_name: (r.n, r.passed) for r in splits.leakage_audit(pairs, indexed, rows, gold).collect()}
    assert audit["pairs_in_train"][0] == 3 and audit["pairs_excluded"][0] == 3 and audit["pairs_indexed"][0] == 2
    assert all(ok for _, ok in audit.values())
    leaky = {r.check_name: r.passed for r in splits.leakage_audit(pairs, pairs, rows, gold).collect()}
    assert not leaky["indexed_test_overlap"] and not leaky["indexed_golden_overlap"]


def test_sample_is_complete_with_null_keys(spark):
    df = spark.createDataFrame([(str(k),) for k in range(10)] + [(None,)] * 3, "tweet_id string")
    for n in (2, 3, 10, 12):
        got = [r[0] for r in hash_sample(df, n, "tweet_id").collect()]
        assert len(got) == min(n, 10) and None not in got


def test_golden_size_follows_target(spark):
    from threadlens.operators.golden import golden_sample
    rows = spark.range(5000).selectExpr("cast(id as string) as tweet_id", "cast(id as string) as conversation_id",
                                        "repeat('x', cast(id % 97 as int) + 5) as clean_text", "'other' as intent")
    assert golden_sample(rows, target=1000).count() > 900
