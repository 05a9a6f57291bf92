"""Lookup join that stays balanced when one key, or null, dominates the fact side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000      # a key with this many fact rows is split out
MAX_HOT = 1_000           # at most this many keys are broadcast ...
MAX_ROW_BYTES = 65_536    # ... with at most this much payload each; others take the shuffle path
SALT = 1024
TRACKED = 10_000          # keys that the sketch of frequent keys follows


def hot_keys(facts: DataFrame, key: str, hot_rows: int = HOT_ROWS, max_hot: int = MAX_HOT) -> DataFrame:
    """The most frequent non-null keys with about ``hot_rows`` rows or more, at most ``max_hot``.

    Counted by a sketch of at most TRACKED keys a task, so only one small row of each task is shuffled; which keys
    it finds decides no result.
    """
    top = facts.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {max_hot}, {max(TRACKED, max_hot)})").alias("t"))
    return top.select(F.explode("t").alias("t")).where(F.col("t.count") >= hot_rows).select(F.col("t.item").alias("__hk"))


def skew_lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, *,
                spread: str, how: str = "left", hot_rows: int | None = HOT_ROWS,
                max_hot: int = MAX_HOT) -> DataFrame:
    """Join ``facts`` to ``dim`` (unique on ``dim_key``), adding dim's other columns.

    * Rows with a hot key are answered map-side from a broadcast of at most
      ``max_hot`` dim rows of at most MAX_ROW_BYTES each, and rows with a null key need no answer.  Both get a salt
      that no dim row carries, so the shuffle spreads them instead of piling them up.
    * Everything else is an ordinary shuffled equi-join on (key, salt 0).

    The result is exact: the bound on hot keys only decides which path a key takes.
    ``spread`` is a fact column with many values (an id) used for the salt;
    ``hot_rows=None`` skips hot-key detection.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    values = [c for c in dim.columns if c != dim_key]
    packed = dim.where(F.col(dim_key).isNotNull()).select(
        F.col(dim_key).alias("__dk"), F.struct(F.lit(True).alias("__hit"), *values).alias("__cold"))
    work = facts.where(F.col(fact_key).isNotNull()) if how == "inner" else facts
    needs_salt = F.col(fact_key).isNull()
    if hot_rows is not None:
        hot = hot_keys(facts, fact_key, hot_rows, max_hot)
        known = packed.join(F.broadcast(hot), F.col("__dk") == F.col("__hk"), "left_semi")
        # hot keys with no dim row are kept too (null answer), so that they are salted
        answers = (hot.select("__hk", F.lit(None).cast(packed.schema["__cold"].dataType).alias("__hot"))
                   .unionByName(known.select(F.col("__dk").alias("__hk"), F.col("__cold").alias("__hot")))
                   .groupBy("__hk").agg(F.first("__hot", ignorenulls=True).alias("__hot"))
                   .where(F.col("__hot").isNull() | (F.octet_length(F.to_json("__hot")) <= MAX_ROW_BYTES)))
        work = work.join(F.broadcast(answers), F.col(fact_key) == F.col("__hk"), "left")
        needs_salt = needs_salt | F.col("__hk").isNotNull()
    work = work.withColumn("__salt", F.when(
        needs_salt, F.lit(1) + F.pmod(F.xxhash64(spread), F.lit(SALT)).cast("int")).otherwise(F.lit(0)))
    # one struct key: a separate literal salt would be folded out of the join key, and rows shuffled by the raw key
    joined = work.join(packed, F.struct(F.col(fact_key).alias("k"), F.col("__salt").alias("s"))
                       == F.struct(F.col("__dk").alias("k"), F.lit(0).alias("s")), "left")
    answer = F.coalesce("__hot", "__cold") if hot_rows is not None else F.col("__cold")
    joined = joined.withColumn("__ans", answer)
    if how == "inner":
        joined = joined.where(F.col("__ans.__hit"))
    return joined.select(*facts.columns, *[F.col("__ans")[v].alias(v) for v in values])
