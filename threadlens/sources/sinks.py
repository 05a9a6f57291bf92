"""Tables and report files written by the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.text import clean_text

SPLIT_COLUMNS = ["tweet_id", "clean_text", "intent", "conversation_id", "split"]


def write_splits(splits: DataFrame, path: str) -> DataFrame:
    """Split rows partitioned by ``split``, so that reading one split reads only its files."""
    splits.select(*SPLIT_COLUMNS).write.mode("overwrite").partitionBy("split").parquet(path)
    return splits.sparkSession.read.parquet(path)


def write_evidence_store(store: DataFrame, path: str, vector: str = "embedding") -> DataFrame:
    """Evidence rows with unit-length float vectors next to their metadata."""
    wide = F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x))
    unit = F.when(norm > 0, F.transform(wide, lambda x: (x / norm).cast("float"))).otherwise(F.col(vector))
    store.withColumn(vector, unit.cast("array<float>")).write.mode("overwrite").parquet(path)
    return load_evidence_store(store.sparkSession, path)


def load_evidence_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def evidence_rows(pairs: DataFrame, vectors: DataFrame, key: str = "customer_tweet_id") -> DataFrame:
    """Pairs joined with the vectors of their customer texts, as an evidence store."""
    return pairs.join(vectors, key).select(
        F.col(key).alias("store_id"), "customer_text", clean_text(F.col("customer_text")).alias("customer_clean"),
        "brand_text", "conversation_id", "created_at", "embedding")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metric rows as JSON (a handful of rows: one file)."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def confusion_matrix_wide(matrix: DataFrame, labels: list[str]) -> DataFrame:
    """Matrix form: one row per true label, one column per predicted label."""
    return matrix.groupBy("y_true").pivot("y_pred", labels).agg(F.sum("n"))


def write_confusion_matrix(matrix: DataFrame, labels: list[str], path: str) -> None:
    confusion_matrix_wide(matrix, labels).orderBy("y_true").coalesce(1) \
        .write.mode("overwrite").option("header", True).csv(path)


def write_table_csv(table: DataFrame, path: str) -> None:
    """Report table (comparison, ranked brands, error list) as CSV, written in parallel."""
    table.write.mode("overwrite").option("header", True).csv(path)
