"""Shapes of plans that scale rests on."""

import re

import pytest
from pyspark.sql import functions as F

from threadlens.functions.text import clean_text, label_intent
from threadlens.operators import brands, features, metrics, splits, threads
from threadlens.sources.scratch import shared_folder
from workload import fixtures as fx
from workload import queries as registered

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString(mode))


def exchanges(df):
    """Every shuffle of the plan with the columns it moves."""
    return [part for part in plan(df).split("\n\n") if re.match(r"\(\d+\) Exchange", part.strip())]


@pytest.fixture(scope="module")
def messages(spark):
    path = shared_folder(spark, "messages")
    fx.tweets(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_row_wise_work_shuffles_nothing_and_reads_its_columns(messages):
    df = messages.select("tweet_id", label_intent(clean_text(F.col("text"))).alias("intent"))
    assert not exchanges(df) and "Python" not in plan(df)
    schema = re.search(r"ReadSchema: (.*)", plan(df))[1]
    assert "text" in schema and "author_id" not in schema


def test_filters_reach_the_scan(messages):
    assert re.search(r"PushedFilters: \[.*IsNotNull\(in_response_to_tweet_id\)", plan(threads.attribute_brand(messages, hot_rows=None)))


def test_first_rows_are_cut_before_the_shuffle(messages):
    text = plan(threads.dedup_keep_first(messages), "simple")
    assert text.index("WindowGroupLimit") < text.rindex("Exchange") < text.rindex("WindowGroupLimit")


def test_inbound_texts_are_shuffled_once(messages):
    """Settling first occurrences moves ids and flags only."""
    moved = exchanges(threads.brand_inbound(messages, hot_rows=None))
    assert sum(bool(re.search(r"\btext#", e)) for e in moved) == 1 < len(moved)


def test_aggregates_combine_before_the_shuffle(messages):
    for df in (brands.brand_table(messages), splits.intent_distribution(splits.label_messages(messages)),
               metrics.confusion_cells(messages.select(F.col("author_id").alias("y_true"), F.col("inbound").cast("string").alias("y_pred")))):
        assert "partial_count" in plan(df)


def test_membership_of_splits_is_a_comparison(messages):
    rows = messages.select("tweet_id", F.col("author_id").alias("conversation_id"))
    text = plan(splits.conversation_split(rows))
    assert not re.search("Window|Sort|Join|Exchange", text)


def test_vocabulary_counts_places_without_grouping_documents(messages):
    df = features.term_totals(messages.select("text"))
    assert len(exchanges(df)) == 1 and not re.search(r"\btext#", exchanges(df)[0])


@pytest.mark.parametrize("name", ["conversation_pairs", "thread_roots", "brand_inbound", "brand_table", "usable_pairs", "evidence_candidates", "leakage_audit",
                                  "leaked_conversations", "classifier_metrics", "bootstrap_ci", "threshold_grid", "topk_similar", "ann_topk", "tfidf_features", "golden_sample"])
def test_no_query_joins_everything_with_everything(spark, name):
    """Joins without a key occur only against one broadcast row."""
    text = plan(registered.Q[name](spark, SF), "simple")
    assert "CartesianProduct" not in text and "BatchEvalPython" not in text and "BroadcastNestedLoopJoin" not in text


def test_judge_prompts_move_what_they_show(spark):
    """Examples are cut to the characters shown before they are joined to the messages."""
    evidence = registered.prompt_rows(spark, SF, shown=20).select(F.explode("evidence").alias("e")).agg(F.max(F.length("e.customer_text"))).first()[0]
    assert evidence == 20
