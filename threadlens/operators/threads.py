"""Reply threads: de-duplication, thread roots, customer/brand pairs, brand inbound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.functions.text import clean_text, is_valid_id
from threadlens.plans.skew import HOT_ROWS, skew_lookup
from threadlens.schema import MIN_CLEAN_LENGTH
from threadlens.sources.scratch import materialize

PARENT = "in_response_to_tweet_id"


def dedup_keep_first(messages: DataFrame, key: str = "tweet_id", order: str = "ingest_seq") -> DataFrame:
    """First row per id in ingest order.

    The ``= 1`` filter lets Spark cut every group to one row before the shuffle
    (WindowGroupLimit), so an id repeated a billion times costs one row per task.
    """
    w = Window.partitionBy(key).orderBy(order)
    return messages.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def valid_reply_ids(messages: DataFrame) -> DataFrame:
    """Flag replies whose parent id is a digit string."""
    return messages.withColumn("valid_parent", is_valid_id(F.col(PARENT)))


def thread_roots(messages: DataFrame, *, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(tweet_id, conversation_id): the ancestor reached after at most five hops.

    Climbing stops where the parent id is malformed or absent from the table.  Three
    lookups of a slim edge table suffice: each one confirms the next unconfirmed
    ancestor and at the same time brings in what that ancestor already knows.  The
    id-only tables between the lookups are written out, since each is read both as
    the climbing side and as the looked-up side.

    ``messages`` must be unique on tweet_id.
    """
    up = F.when(is_valid_id(F.col(PARENT)), F.col(PARENT))

    def confirm(facts, dim, key):
        return skew_lookup(facts, dim, key, "k", spread="tweet_id", hot_rows=hot_rows)

    # a<i>: confirmed i-th ancestor, p<i>: i-th ancestor not yet known to exist
    e1 = materialize(messages.where(F.col("tweet_id").isNotNull()).select("tweet_id", up.alias("p1")), "edges")
    dim1 = e1.select(F.col("tweet_id").alias("k"), F.lit(True).alias("ok"), F.col("p1").alias("nxt"))
    e2 = materialize(confirm(e1, dim1, "p1").select(
        "tweet_id", F.when(F.col("ok"), F.col("p1")).alias("a1"), F.col("nxt").alias("p2")), "edges")
    dim2 = e2.select(F.col("tweet_id").alias("k"), F.lit(True).alias("ok"),
                     F.col("a1").alias("n1"), F.col("p2").alias("n2"))
    e3 = materialize(confirm(e2, dim2, "p2").select(
        "tweet_id", "a1", F.when(F.col("ok"), F.col("p2")).alias("a2"),
        F.col("n1").alias("a3"), F.col("n2").alias("p4")), "edges")
    dim3 = e2.select(F.col("tweet_id").alias("k"), F.lit(True).alias("ok"), F.col("a1").alias("n1"))
    return confirm(e3, dim3, "p4").select("tweet_id", F.coalesce(
        "n1", F.when(F.col("ok"), F.col("p4")), "a3", "a2", "a1", "tweet_id").alias("conversation_id"))


def first_reply(messages: DataFrame, brand: str | None = None) -> DataFrame:
    """First brand reply per customer tweet (per brand when no brand is named)."""
    replies = messages.where(~F.col("inbound") & is_valid_id(F.col(PARENT)))
    if brand is not None:
        replies = replies.where(F.col("author_id") == brand)
    w = Window.partitionBy("author_id", PARENT).orderBy("ingest_seq")
    return (replies.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
            .select(F.col(PARENT).alias("customer_tweet_id"), F.col("author_id").alias("brand"),
                    F.col("tweet_id").alias("brand_tweet_id"), F.col("text").alias("brand_text")))


def conversation_pairs(messages: DataFrame, brand: str | None = None, *, dedup: bool = True,
                       roots: DataFrame | None = None, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(customer message, first brand reply) pairs with their thread root.

    With ``brand=None`` every brand is paired in one job.  Replies are cut to one per
    customer tweet before the join, so the join is one-to-one per brand.  Pass
    ``dedup=False`` for a table de-duplicated at ingestion, and ``roots`` if the
    (tweet_id, conversation_id) table exists already.
    """
    unique = dedup_keep_first(messages) if dedup else messages
    customers = unique.where("inbound").select(
        F.col("tweet_id").alias("customer_tweet_id"), F.col("text").alias("customer_text"), "created_at")
    if roots is None:
        roots = thread_roots(unique.select("tweet_id", PARENT), hot_rows=hot_rows)
    roots = roots.select(F.col("tweet_id").alias("customer_tweet_id"), "conversation_id")
    return (first_reply(unique, brand).join(customers, "customer_tweet_id").join(roots, "customer_tweet_id")
            .select("conversation_id", "customer_tweet_id", "customer_text", "brand_tweet_id",
                    "brand_text", "created_at", F.lit(1).alias("turn"), "brand"))


def clean_pairs(pairs: DataFrame, min_length: int = MIN_CLEAN_LENGTH) -> DataFrame:
    """Add cleaned texts, drop pairs whose customer side is too short."""
    return (pairs.withColumn("customer_clean", clean_text(F.col("customer_text")))
            .withColumn("brand_clean", clean_text(F.col("brand_text")))
            .where(F.length("customer_clean") > min_length))


def brand_owner(messages: DataFrame) -> DataFrame:
    """(tweet_id, brand) of outbound tweets, first occurrence per id."""
    out = messages.where(~F.col("inbound") & F.col("tweet_id").isNotNull()) \
        .select("tweet_id", F.col("author_id").alias("brand"), "ingest_seq")
    return dedup_keep_first(out).drop("ingest_seq")


def attribute_brand(messages: DataFrame, *, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Inbound messages with the brand that wrote their parent; others are dropped."""
    inbound = messages.where(F.col("inbound") & F.col(PARENT).isNotNull())
    return skew_lookup(inbound, brand_owner(messages), PARENT, "tweet_id", spread="tweet_id",
                       how="inner", hot_rows=hot_rows).where(F.col("brand").isNotNull())


def brand_inbound(messages: DataFrame, brand: str | None = None, *, dedup: bool = True,
                  outbound_only: bool = True, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Inbound messages that answer a tweet of the brand (of any brand when None).

    ``dedup=False, outbound_only=False`` is the looser variant that neither drops
    repeated ids nor checks that the parent is outbound.

    First occurrences are settled on ids and flags alone; texts are shuffled only of rows that can
    qualify, to be met by the ids that do.  ``ingest_seq`` tells rows of one id apart.
    """
    slim = messages.select("tweet_id", "author_id", "inbound", PARENT, "ingest_seq") if dedup else messages
    base = dedup_keep_first(slim) if dedup else messages
    parents = base.where(F.col("tweet_id").isNotNull())
    if outbound_only:
        parents = parents.where(~F.col("inbound"))
    if brand is not None:
        parents = parents.where(F.col("author_id") == brand)
    ids = parents.select("tweet_id").distinct()
    answers = F.col("inbound") & F.col(PARENT).isNotNull()
    found = skew_lookup(base.where(answers), ids.withColumn("__in", F.lit(True)), PARENT, "tweet_id",
                        spread="tweet_id", how="inner", hot_rows=hot_rows).drop("__in")
    if not dedup:
        return found
    first = found.select(F.col("tweet_id").alias("__id"), F.col("ingest_seq").alias("__seq"))
    return messages.where(answers).join(first, F.col("tweet_id").eqNullSafe(F.col("__id")) & F.col("ingest_seq").eqNullSafe(F.col("__seq")), "left_semi")


def conversation_proxy(messages: DataFrame) -> DataFrame:
    """conversation_id = parent id, or the own id where there is none."""
    return messages.withColumn("conversation_id", F.coalesce(PARENT, "tweet_id"))
