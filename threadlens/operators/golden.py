"""Golden-set sampling, rater templates and backfill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.functions.prompts import JUDGE_DIMENSIONS
from threadlens.functions.text import is_blank
from threadlens.plans.hash_order import hash_key
from threadlens.schema import DOUBLE_LABEL_N, GOLDEN_SIZE, SEED


def length_quartiles(rows: DataFrame, *, text: str = "clean_text", group: str = "intent") -> DataFrame:
    """Add text_len and len_quartile (0-based) from per-intent quantile edges.

    Bins are right-closed, equal edges merge, a single-valued group is bin 0.  The
    edges are one row per intent; the percentile buffer is one counter per length.
    """
    sized = rows.withColumn("text_len", F.length(text))
    edges = sized.groupBy(F.col(group).alias("__g")).agg(
        F.percentile("text_len", F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)])).alias("__e"))
    inner = F.filter(F.array_distinct("__e"), lambda e, i: (i > 0) & (e < F.col("text_len")))
    # one row per intent label; Spark sees its size and broadcasts it by itself
    return sized.join(edges, F.col(group).eqNullSafe(F.col("__g"))) \
        .withColumn("len_quartile", F.size(inner)).drop("__g", "__e")


def stratified_pick(rows: DataFrame, *, per_intent: int | None = None, target: int = GOLDEN_SIZE, seed: int = SEED) -> DataFrame:
    """The first n rows in hash order of every (intent, quartile) stratum.

    n is per_intent//4, or by default max(15, target//number of intents)//4, at least 1;
    a target under the default size still draws from strata of the default size.
    The ceiling in the filter, n for a single intent, makes Spark trim each stratum to that many
    rows before the shuffle, so the dominant intent never lands in one task.
    """
    picked = length_quartiles(rows).withColumn("__h", hash_key(F.col("tweet_id"), seed))
    w = Window.partitionBy("intent", "len_quartile").orderBy("__h", "tweet_id")
    picked = picked.withColumn("__rn", F.row_number().over(w))
    if per_intent is not None:
        return picked.where(F.col("__rn") <= max(1, per_intent // 4))
    target = max(target, GOLDEN_SIZE)
    intents = rows.agg(F.count_distinct("intent"))
    n = F.greatest(F.lit(1), F.floor(F.greatest(F.lit(15), F.floor(F.lit(target) / intents.scalar())) / 4))
    ceiling = target // 4  # no stratum can ask for more
    return picked.where((F.col("__rn") <= ceiling) & (F.col("__rn") <= n))


def golden_sample(test: DataFrame, *, target: int = GOLDEN_SIZE, per_intent: int | None = None,
                  double_label: int = DOUBLE_LABEL_N, seed: int = SEED) -> DataFrame:
    """Annotation queue: stratified rows, one per tweet_id, at most ``target``, numbered
    in hash order, gold columns blank.

    Numbering runs over at most ``target`` rows.
    """
    picked = stratified_pick(test, per_intent=per_intent, target=target, seed=seed)
    once = Window.partitionBy("tweet_id").orderBy("intent", "len_quartile")
    top = picked.withColumn("__d", F.row_number().over(once)).where("__d = 1").orderBy("__h", "tweet_id").limit(target)
    blank = F.lit("")
    return top.withColumn("id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("__h", "tweet_id"))).select(
        "id", F.col("tweet_id").cast("string").alias("tweet_id"),
        F.col("conversation_id").cast("string").alias("conversation_id"), F.col("clean_text").alias("text"),
        F.col("intent").alias("auto_intent"), blank.alias("gold_intent"), blank.alias("should_escalate"),
        blank.alias("gold_reply_quality"),
        F.when(F.col("id") <= double_label, "YES").otherwise("NO").alias("double_label"), blank.alias("notes"))


def golden_set(test: DataFrame, *, target: int = GOLDEN_SIZE, per_intent: int = 25, seed: int = SEED) -> DataFrame:
    """The labelling table with the columns of the evaluation module: at most per_intent // 4 rows a stratum, no second rater.

    Its gold columns are those that ``golden_backfill`` fills.
    """
    blank = F.lit("")
    return golden_sample(test, target=target, per_intent=per_intent, seed=seed).select(
        "id", "tweet_id", "conversation_id", "text", "auto_intent", *[blank.alias(c) for c in ("gold_intent", "gold_reply_quality_label", "gold_escalation_label", "notes")])


def double_label_subset(golden: DataFrame, n: int = DOUBLE_LABEL_N, order: str = "id") -> DataFrame:
    """First n rows with separate blank columns for two raters."""
    raters = [F.lit("").alias(f"human_{r}_{c}") for c in ("intent", "escalation", "notes") for r in ("a", "b")]
    return golden.orderBy(order).limit(n).select("id", "text", "auto_intent", *raters, "notes")


def calibration_template(rows: DataFrame, n: int = 30, *, seed: int = SEED,
                         dimensions: Sequence[str] = JUDGE_DIMENSIONS) -> DataFrame:
    """n rows in hash order with blank rubric columns."""
    have = rows.columns
    intent = F.coalesce(*[F.col(c).cast("string") for c in ("intent", "auto_intent") if c in have][:1], F.lit(""))
    reply = F.col("generated_reply") if "generated_reply" in have else F.lit("")
    return rows.orderBy(hash_key(F.col("id"), seed), "id").limit(n).select(
        "id", "text", intent.alias("intent"), reply.alias("generated_reply"), F.lit("").alias("notes"),
        *[F.lit("").alias(d) for d in dimensions])


# gold column -> column of the legacy table
LEGACY_FIELDS = {"gold_intent": "gold_intent", "gold_escalation_label": "should_escalate",
                 "gold_reply_quality_label": "gold_reply_quality", "notes": "notes"}


def golden_backfill(golden: DataFrame, legacy: DataFrame, order: str) -> DataFrame:
    """Fill blank gold fields from a legacy table (first row per tweet_id in ``order``)."""
    fields = {g: s for g, s in LEGACY_FIELDS.items() if g in golden.columns and s in legacy.columns}
    w = Window.partitionBy("tweet_id").orderBy(order)
    source = legacy.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").select(
        F.col("tweet_id").cast("string").alias("__key"), F.lit(True).alias("__hit"),
        *[F.col(s).alias(f"__{g}") for g, s in fields.items()])
    joined = golden.join(source, F.col("tweet_id").cast("string") == F.col("__key"), "left")
    return joined.select(*[
        F.when(is_blank(F.col(c)) & F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c)
        if c in fields else F.col(c) for c in golden.columns])
