"""Labelled rows, conversation-level splits, evidence candidates and the leakage audit."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from threadlens.functions.text import clean_text, label_intent
from threadlens.plans.hash_order import WIDTH, at_or_before, cut_keys, hash_sample
from threadlens.plans.skew import HOT_ROWS, skew_lookup
from threadlens.schema import MIN_CLEAN_LENGTH, SEED, TRAIN_RATIO, VAL_RATIO


def drop_empty(messages: DataFrame, min_length: int = 0, counts: Observation | None = None) -> DataFrame:
    """Keep rows whose clean_text is longer than ``min_length``.

    ``counts`` is an observation of the caller's own: once a job over the result has run, its ``get`` holds how many
    rows were ``kept`` and ``dropped``, gathered by that job rather than by a second pass.  Nulls are dropped.
    """
    keep = F.coalesce(F.length("clean_text") > min_length, F.lit(False))
    if counts is not None:
        messages = messages.observe(counts, F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped"))
    return messages.where(keep)


def label_messages(messages: DataFrame, min_length: int = MIN_CLEAN_LENGTH, counts: Observation | None = None) -> DataFrame:
    """Clean, drop short texts (counted in ``counts``), attach the rule intent."""
    cleaned = drop_empty(messages.withColumn("clean_text", clean_text(F.col("text"))), min_length, counts)
    return cleaned.withColumn("intent", label_intent(F.col("clean_text")))


def intent_distribution(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("intent").agg(F.count(F.lit(1)).alias("n"))


def conversation_split(labelled: DataFrame, *, train: float = TRAIN_RATIO, val: float = VAL_RATIO,
                       seed: int = SEED, key: str = "conversation_id", width: int = WIDTH) -> DataFrame:
    """Add ``split``: the first int(train*n) conversations in hash order train, the next
    int(val*n) validation, the rest test.  Every row follows its conversation.

    The split of a row is a comparison of its conversation's hash with two cut keys.
    Null conversations stay out of every split.
    """
    known = labelled.where(F.col(key).isNotNull())
    cuts = cut_keys(known.select(key).distinct(), key, {
        "train": lambda n: math.floor(n * train),
        "val": lambda n: math.floor(n * train) + math.floor(n * val),
    }, seed=seed, width=width)
    return known.withColumn("split", F.when(at_or_before(F.col(key), cuts["train"], seed), "train")
                            .when(at_or_before(F.col(key), cuts["val"], seed), "validation")
                            .otherwise("test"))


def prepare_splits(inbound: DataFrame, sample_n: int | None = 20000, *, seed: int = SEED) -> DataFrame:
    """Brand inbound rows -> sampled, cleaned, labelled and split training rows.

    ``inbound`` must be unique on tweet_id; it needs a conversation_id column.
    """
    rows = hash_sample(inbound, sample_n, "tweet_id", seed=seed) if sample_n else inbound
    return conversation_split(label_messages(rows), seed=seed) \
        .select("tweet_id", "clean_text", "intent", "conversation_id", "split")


def exclusion_set(splits: DataFrame, golden: DataFrame | None = None) -> DataFrame:
    """Distinct conversation ids that must never reach the evidence store."""
    ids = splits.where(F.col("split").isin("test", "validation")).select(F.col("conversation_id").cast("string"))
    if golden is not None:
        ids = ids.union(golden.where(F.col("conversation_id") != "").select(F.col("conversation_id").cast("string")))
    return ids.where(F.col("conversation_id").isNotNull()).distinct()


def evidence_candidates(pairs: DataFrame, splits: DataFrame, golden: DataFrame | None = None, *,
                        key: str = "customer_tweet_id", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Pairs whose conversation is in train and not in test, validation or golden.

    The allowed ids are settled first on the distinct id side (one row per
    conversation), then pairs look their conversation up; one thread may hold very
    many pairs, hence the skew-aware lookup.
    """
    train = splits.where("split = 'train'").select(F.col("conversation_id").cast("string")).distinct()
    allowed = train.join(exclusion_set(splits, golden), "conversation_id", "left_anti")
    typed = pairs.withColumn("conversation_id", F.col("conversation_id").cast("string"))
    return skew_lookup(typed, allowed.select(F.col("conversation_id").alias("__c"), F.lit(True).alias("__in")),
                       "conversation_id", "__c", spread=key, how="inner", hot_rows=hot_rows).drop("__in")


SOURCES = ["train", "validation", "test", "golden", "pair", "indexed"]
OVERLAPS = {"train_test_overlap": ("train", "test"), "validation_test_overlap": ("validation", "test"),
            "indexed_test_overlap": ("indexed", "test"), "indexed_golden_overlap": ("indexed", "golden")}


def conversation_flags(splits: DataFrame, golden: DataFrame | None, pairs: DataFrame | None, indexed: DataFrame | None) -> DataFrame:
    """(c, rows in each of SOURCES): every id source is tagged and collapsed to one row per conversation."""
    def tag(df, name):
        return df.select(F.col("conversation_id").cast("string").alias("c"), F.lit(name).alias("tag"))

    tagged = splits.select(F.col("conversation_id").cast("string").alias("c"), F.col("split").alias("tag"))
    for df, name in ((pairs, "pair"), (indexed, "indexed")):
        tagged = tagged if df is None else tagged.union(tag(df, name))
    if golden is not None:
        tagged = tagged.union(tag(golden.where(F.col("conversation_id") != ""), "golden"))
    return tagged.where(F.col("c").isNotNull()).groupBy("c").agg(*[F.count_if(F.col("tag") == t).alias(t) for t in SOURCES])


def leaked_conversations(indexed: DataFrame | None, splits: DataFrame, golden: DataFrame | None = None) -> DataFrame:
    """(check_name, conversation_id): every conversation that one of the overlap checks finds."""
    flags = conversation_flags(splits, golden, None, indexed)
    hits = F.array(*[F.when((F.col(a) > 0) & (F.col(b) > 0), F.lit(name)) for name, (a, b) in OVERLAPS.items()])
    return flags.select(F.explode(F.array_compact(hits)).alias("check_name"), F.col("c").alias("conversation_id"))


def shared_texts(splits: DataFrame, text: str = "clean_text") -> DataFrame:
    """(text_md5, train, validation, test, conversations): texts that stand in more than one split, with their rows in each.

    Equal texts of different conversations may be independent messages, so they are reported, never failed.
    """
    names = ["train", "validation", "test"]
    groups = splits.where(F.col(text).isNotNull()).groupBy(F.md5(F.col(text).cast("binary")).alias("text_md5")).agg(
        *[F.count_if(F.col("split") == n).alias(n) for n in names], F.count_distinct("conversation_id").alias("conversations"))
    return groups.where(sum(F.when(F.col(n) > 0, 1).otherwise(0) for n in names) > 1)


def leakage_audit(pairs: DataFrame, indexed: DataFrame, splits: DataFrame,
                  golden: DataFrame | None = None, *, fail: bool = False) -> DataFrame:
    """(check_name, n, must_be_zero, passed) rows of the leakage checks.

    All overlaps are counts over one row per conversation.  With ``fail`` the job that reads the
    result ends with an error that names the first failed check.
    """
    flags = conversation_flags(splits, golden, pairs, indexed)
    has = {t: F.col(t) > 0 for t in SOURCES}
    excluded = has["test"] | has["validation"] | has["golden"]
    counts = flags.agg(
        *[F.count_if(has[a] & has[b]).alias(name) for name, (a, b) in OVERLAPS.items()],
        F.coalesce(F.sum(F.when(has["train"], F.col("pair"))), F.lit(0)).alias("pairs_in_train"),
        F.coalesce(F.sum(F.when(excluded, F.col("pair"))), F.lit(0)).alias("pairs_excluded"),
        F.coalesce(F.sum("indexed"), F.lit(0)).alias("pairs_indexed"),
    )
    zero = [c for c in counts.columns if c.endswith("overlap")]
    entries = F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("n"),
                                 F.lit(c in zero).alias("must_be_zero")) for c in counts.columns])
    passed = ~F.col("must_be_zero") | (F.col("n") == 0)
    if fail:
        passed = F.when(passed, True).otherwise(F.raise_error(F.concat(F.lit("leakage: "), "check_name", F.lit(" = "), F.col("n").cast("string"))).cast("boolean"))
    return counts.select(F.inline(entries)).withColumn("passed", passed)


def reproducible_sample(df: DataFrame, n: int, key: str = "tweet_id", *, seed: int = SEED,
                        clamp: tuple[int, int] | None = None) -> DataFrame:
    """Fixed-size sample in hash order, with an optional clamp of the size (e.g. 500..1000)."""
    if clamp:
        n = max(clamp[0], min(clamp[1], n))
    return hash_sample(df, n, key, seed=seed)
