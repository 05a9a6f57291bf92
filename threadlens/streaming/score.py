"""Scoring a stream of messages in micro-batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadlens.operators.models import IntentModel
from threadlens.operators.scoring import score_messages
from threadlens.operators.vector_index import TileIndex

FILES_PER_BATCH = 64
COMMIT = "batch_id long, attempt string, rows long"


def message_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Parquet files of messages as a stream; a batch takes at most ``files_per_batch`` of them, so its size is bounded."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def committed(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(COMMIT).parquet(f"{out}/commits")


def read_scored(spark: SparkSession, out: str) -> DataFrame:
    """The rows of committed batches; what a failed attempt left behind is never read."""
    commits = committed(spark, out)
    rows = spark.read.parquet(f"{out}/data")
    return rows.join(commits.select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi")


def score_batch(batch: DataFrame, batch_id: int, model: IntentModel, store: DataFrame | TileIndex, out: str, **params) -> bool:
    """Score and commit one batch; False if it is committed already.

    Rows go to a folder of this attempt.  The commit row that names the attempt is written last, as one file,
    so a reader sees a batch whole or not at all, and a batch that comes again changes nothing.
    """
    spark = batch.sparkSession
    if not committed(spark, out).where(F.col("batch_id") == batch_id).isEmpty():
        return False
    attempt = uuid.uuid4().hex
    batch.persist()  # read by the classifier, the retrieval and the final join
    try:
        place = f"{out}/data/batch_id={batch_id}/attempt={attempt}"
        score_messages(batch, model, store, **params).write.option("compression", "zstd").parquet(place)
        rows = spark.read.parquet(place).count()
    finally:
        batch.unpersist()
    spark.createDataFrame([(batch_id, attempt, rows)], COMMIT).coalesce(1).write.mode("append").parquet(f"{out}/commits")
    return True


def score_stream(messages: DataFrame, model: IntentModel, store: DataFrame | TileIndex, *, out: str, checkpoint: str,
                 trigger: dict | None = None, **params) -> StreamingQuery:
    """Start a stateless query that scores each micro-batch against a static store, best an index of it: a batch then
    reads the tiles that its messages need.  ``read_scored`` reads what is committed.
    """
    spark = messages.sparkSession
    spark.createDataFrame([], COMMIT).write.mode("append").parquet(f"{out}/commits")

    def write(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch, batch_id, model, store, out, **params)

    return (messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
