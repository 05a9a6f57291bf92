"""Dataset profile: summary measures and length histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.numeric import half_even


def dataset_summary(messages: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """One row with the 16 measures.

    Three scans: the measures of all rows, the authors, and one digest per row.  Rows are counted by (id, digest)
    and those counts by id, so copies of rows and of ids both follow from one shuffle of digests.
    """
    data_cols = [c for c in messages.columns if c != order]
    rid = F.coalesce(F.concat(F.lit("="), F.col("tweet_id").cast("string")), F.lit(""))  # null ids count as copies of each other
    digest = F.md5(F.to_json(F.struct(*data_cols)).cast("binary"))
    per_row = messages.groupBy(rid.alias("id"), digest.alias("row")).agg(F.count(F.lit(1)).alias("n"))
    per_id = per_row.groupBy("id").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("extra"))
    repeats = per_id.agg(F.struct(F.coalesce(F.sum("extra"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("ids")))
    length = F.length("text")
    # exact percentiles: the buffer is one counter per distinct text length
    base = messages.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("inbound").alias("inbound_rows"),
        F.count_if(~F.col("inbound")).alias("outbound_rows"),
        half_even(F.count_if("inbound") * 100 / F.count(F.lit(1)), 2).alias("inbound_pct"),
        F.count_if(F.col("text").isNull()).alias("missing_text"),
        F.count_if(F.col("response_tweet_id").isNull()).alias("missing_response_id"),
        F.min("created_at").alias("date_min"), F.max("created_at").alias("date_max"),
        half_even(F.avg(length), 1).alias("text_len_mean"),
        half_even(F.percentile(length, 0.5), 1).alias("text_len_median"),
        F.min(length).alias("text_len_min"), F.max(length).alias("text_len_max"),
        half_even(F.percentile(length, 0.95), 1).alias("text_len_p95"),
    )
    authors = messages.where(F.col("author_id").isNotNull()).select("author_id").distinct().agg(F.count(F.lit(1)))
    return base.withColumn("__r", repeats.scalar()).select(
        *base.columns, F.col("__r.rows").alias("duplicate_rows"), F.col("__r.ids").alias("duplicate_tweet_ids"), authors.scalar().alias("unique_authors"))


def length_histogram(messages: DataFrame, bins: int = 60, clip: int = 300) -> DataFrame:
    """Equal-width bins over the clipped text lengths, with the unclipped median.

    Rows collapse to one per distinct length first.  The bin of a length is integer
    arithmetic on the observed range; the last bin is closed, empty bins are kept.
    """
    raw = messages.where(F.col("text").isNotNull()).groupBy(F.length("text").alias("len")) \
        .agg(F.count(F.lit(1)).alias("n"))
    clipped = F.least("len", F.lit(clip))
    stats = raw.agg(F.min(clipped).alias("lo"), F.max(clipped).alias("hi"),
                    F.percentile("len", 0.5, F.col("n")).alias("median"))
    grid = stats.where(F.col("lo").isNotNull()).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    span = F.col("hi") - F.col("lo")
    idx = F.when(span == 0, F.lit(bins // 2)).otherwise(F.least(
        F.lit(bins - 1), F.expr(f"((least(len, {clip}) - lo) * {bins}) div greatest(hi - lo, 1)")))
    counted = raw.withColumn("s", stats.select(F.struct("lo", "hi")).scalar()) \
        .select("len", "n", "s.lo", "s.hi").groupBy(idx.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    lo = F.when(span == 0, F.col("lo") - 0.5).otherwise(F.col("lo").cast("double"))
    width = F.when(span == 0, F.lit(1.0)).otherwise(span.cast("double")) / F.lit(float(bins))
    return grid.join(counted, "bin", "left").select(
        "bin", half_even(lo + width * F.col("bin"), 4).alias("bin_start"),
        half_even(lo + width * (F.col("bin") + 1), 4).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"), F.col("median").alias("median_length"))
