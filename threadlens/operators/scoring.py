"""End-to-end scoring of messages: clean, classify, retrieve, reply, decide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.prompts import template_reply
from threadlens.functions.text import clean_text
from threadlens.operators.decision import escalation_gates
from threadlens.operators.models import IntentModel
from threadlens.operators.retrieval import add_evidence
from threadlens.operators.vector_index import TileIndex, vector_key
from threadlens.schema import DEFAULT_BRAND, ESCALATE, EVIDENCE_TYPE, TOP_K

OUTPUT = ["brand", "customer_message", "clean_message", "intent", "confidence", "intent_proba", "evidence",
          "evidence_score", "reply", "grounded", "backend", "decision", "decision_reason", "gate_triggered",
          "composite_risk", "classifier_used"]


def score_messages(messages: DataFrame, model: IntentModel, store: DataFrame | TileIndex, *, key: str = "tweet_id",
                   store_id: str = "store_id", brand: str = DEFAULT_BRAND, k: int = TOP_K,
                   vector: str = "embedding") -> DataFrame:
    """One output row per message (unique ``key``, ``text``, ``embedding``).

    Messages that are empty after cleaning are escalated without a classification.
    The store is expected to hold cleaned customer texts' vectors next to metadata; an index of it
    (``build_evidence_index``) is read in the tiles that the messages need only.
    """
    cleaned = messages.withColumn("clean_text", clean_text(F.col("text")))
    usable = cleaned.where(F.col("clean_text") != "")
    keyed = usable.withColumn("__vk", vector_key(F.col(vector)))
    predicted = model.predict(keyed if model.source == vector else keyed.drop(vector))  # vectors stay behind
    joined = add_evidence(usable, store, k, key=key, store_id=store_id, vector=vector, texts_of=predicted) \
        .withColumn("evidence", F.coalesce("evidence", F.array().cast(EVIDENCE_TYPE))) \
        .withColumn("n_evidence", F.coalesce("n_evidence", F.lit(0))) \
        .withColumn("evidence_score", F.coalesce("evidence_score", F.lit(0.0)))
    decided = escalation_gates(joined, intent="prediction")
    scored = decided.select(
        key, F.lit(brand).alias("brand"), F.col("text").alias("customer_message"),
        F.col("clean_text").alias("clean_message"), F.col("prediction").alias("intent"), "confidence",
        F.col("proba").alias("intent_proba"), "evidence", "evidence_score",
        template_reply(F.col("prediction"), F.col("evidence")).alias("reply"),
        (F.col("n_evidence") > 0).alias("grounded"), F.lit("template").alias("backend"), "decision",
        F.col("reason").alias("decision_reason"), "gate_triggered", "composite_risk",
        F.lit(model.kind).alias("classifier_used"))
    blank = cleaned.where(F.col("clean_text") == "").select(
        key, F.lit(brand).alias("brand"), F.col("text").alias("customer_message"),
        F.col("clean_text").alias("clean_message"), F.lit(ESCALATE).alias("decision"),
        F.lit("Empty or unreadable message.").alias("decision_reason"))
    return scored.unionByName(blank, allowMissingColumns=True).select(key, *OUTPUT)
