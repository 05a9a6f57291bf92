"""Annotation tables from JSON arrays or CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.sources.messages import by_name, with_file_order

ANNOTATION_COLUMNS = ["id", "tweet_id", "conversation_id", "text", "auto_intent", "gold_intent", "should_escalate",
                      "gold_reply_quality", "double_label", "notes"]


def read_annotations(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All-string rows with ``row_no`` in file order; blank cells stay ''.

    CSV columns are taken by header name, a missing one is an error.  ``row_no`` increases along each
    file and from file to file by path; with one file it counts 1, 2, 3, …
    """
    wanted = columns or ANNOTATION_COLUMNS
    schema = T.StructType([T.StructField(c, T.StringType()) for c in wanted])
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "json":
        raw = spark.read.schema(schema).option("multiLine", True).json(path)
        df = raw.select("*", "_metadata")
    elif suffix == "csv":
        raw = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
               .option("nullValue", "\u0000").option("emptyValue", "").csv(path))
        df = by_name(raw, wanted).na.fill("", wanted)
    else:
        raise ValueError("Annotation file must be JSON or CSV.")
    return with_file_order(raw, df).withColumn("row_no", F.col("ingest_seq") + 1).drop("_metadata", "ingest_seq")
