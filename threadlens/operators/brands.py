"""Brand profiling and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.numeric import half_even
from threadlens.operators.threads import PARENT, brand_owner
from threadlens.schema import MIN_BRAND_VOLUME

METRICS = ["inbound_msgs", "conversations", "usable_pairs", "reply_rate"]


def brand_table(messages: DataFrame) -> DataFrame:
    """Per brand: outbound tweets, inbound messages, distinct parent tweets answered.

    Inbound rows are counted per parent first.  That makes the join to the parent's
    author one-to-one (no hot parent), and since a parent has one author, distinct
    parents per brand become a plain count.
    """
    outbound = messages.where(~F.col("inbound") & F.col("author_id").isNotNull()) \
        .groupBy(F.col("author_id").alias("brand")).agg(F.count("tweet_id").alias("outbound_tweets"))
    per_parent = messages.where(F.col("inbound") & F.col(PARENT).isNotNull()) \
        .groupBy(F.col(PARENT).alias("tweet_id")).agg(F.count("tweet_id").alias("n"))
    inbound = per_parent.join(brand_owner(messages), "tweet_id").where(F.col("brand").isNotNull()) \
        .groupBy("brand").agg(F.sum("n").alias("inbound_msgs"), F.count(F.lit(1)).alias("conversations"))
    return outbound.join(inbound, "brand", "full_outer") \
        .select("brand", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                           for c in ("outbound_tweets", "inbound_msgs", "conversations")])


def usable_pairs(messages: DataFrame, brands: DataFrame) -> DataFrame:
    """Add usable_pairs (inbound messages that any outbound tweet answers) and reply_rate."""
    replied = messages.where(~F.col("inbound") & F.col(PARENT).isNotNull()) \
        .select(F.col(PARENT).alias("tweet_id")).distinct().withColumn("got", F.lit(1))
    # (id, parent) counts first: repeated copies of a message collapse map-side
    inbound = messages.where(F.col("inbound") & F.col(PARENT).isNotNull()) \
        .groupBy("tweet_id", PARENT).agg(F.count("tweet_id").alias("n"), F.count(F.lit(1)).alias("rows"))
    per_parent = inbound.join(replied, "tweet_id", "left") \
        .groupBy(F.col(PARENT).alias("tweet_id")) \
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("got") == 1, F.col("rows")).otherwise(0)).alias("usable"))
    per_brand = per_parent.join(brand_owner(messages), "tweet_id").where(F.col("brand").isNotNull()) \
        .groupBy("brand").agg(F.sum("usable").alias("usable_pairs"), F.sum("n").alias("total"))
    rate = half_even(F.col("usable_pairs") / F.when(F.col("total") != 0, F.col("total")), 3)
    return brands.join(per_brand, "brand", "left").select(
        *brands.columns, F.coalesce("usable_pairs", F.lit(0)).cast("long").alias("usable_pairs"),
        F.coalesce(rate, F.lit(0.0)).alias("reply_rate"))


def brand_scores(brands: DataFrame, min_inbound: int = MIN_BRAND_VOLUME) -> DataFrame:
    """Min-max normalise the metrics over brands of sufficient volume and average them.

    The extremes are one aggregate row read as a scalar subquery, so no global
    window or cross join is involved.
    """
    metrics = [m for m in METRICS if m in brands.columns]
    big = brands.where(F.col("inbound_msgs") >= min_inbound)
    extremes = big.agg(F.struct(*[f(m).alias(f"{n}_{m}") for m in metrics
                                  for n, f in (("lo", F.min), ("hi", F.max))]).alias("s"))
    out = big.withColumn("__x", extremes.scalar())
    for m in metrics:
        lo, hi = F.col(f"__x.lo_{m}"), F.col(f"__x.hi_{m}")
        out = out.withColumn(f"{m}_norm", F.when(
            hi > lo, (F.col(m) - lo).cast("double") / (hi - lo).cast("double")).otherwise(F.lit(0.0)))
    total = sum((F.col(f"{m}_norm") for m in metrics[1:]), F.col(f"{metrics[0]}_norm"))
    return out.drop("__x").withColumn("composite_score", total / F.lit(float(len(metrics))))


def select_brand(scored: DataFrame) -> DataFrame:
    """The best brand, one row; fails if no brand qualifies.  Ties go to the smaller name."""
    best = scored.agg(F.min_by(F.struct("brand", "composite_score"),
                               F.struct(-F.col("composite_score"), F.col("brand"))).alias("b"))
    return best.select(
        F.coalesce(F.col("b.brand"), F.raise_error(F.lit("No brands with sufficient data found.")).cast("string")).alias("brand"),
        F.col("b.composite_score").alias("composite_score"))


def top_brands(brands: DataFrame, n: int = 20) -> DataFrame:
    return brands.orderBy(F.desc("inbound_msgs"), "brand").limit(n)
