"""Message ingestion."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.text import strip
from threadlens.schema import ID_COLUMNS, RAW_MESSAGE_SCHEMA

# Fixed value: the data set's own date form, without its weekday, which Spark does not parse.
NATIVE_DATE = "MMM dd HH:mm:ss Z yyyy"


def with_file_order(raw: DataFrame, named: DataFrame) -> DataFrame:
    """``named`` (with ``_metadata``) plus ``ingest_seq``, a long that grows along each file, and from file to file by path.

    Every file is read by one task; tasks may hold several files in any order.  Files are numbered in a small table
    that is joined by path; Spark broadcasts it below its own size limit and shuffles beyond.
    """
    paths = sorted({re.sub("^file:/+", "file:/", f) for f in raw.inputFiles()})  # the two forms of a local path
    files = raw.sparkSession.createDataFrame([(f, k) for k, f in enumerate(paths)], "__file string, __number long")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    marked = named.withColumn("__row", row).withColumn("__path", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/"))
    return marked.join(files, F.col("__path") == F.col("__file")) \
        .withColumn("ingest_seq", F.shiftleft("__number", 33) + F.col("__row")).drop("__row", "__path", "__file", "__number")


def by_name(raw: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns by header name; a missing one is an error, further ones are dropped."""
    missing = [c for c in wanted if c not in raw.columns]
    if missing:
        raise ValueError(f"columns missing in the file: {', '.join(missing)}")
    return raw.select(*wanted, "_metadata")


def read_messages_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw CSV strings, columns by header name, plus ``ingest_seq`` (order of files by path, then of rows).

    Texts contain newlines, so a CSV file cannot be split between tasks: convert once
    with ``ingest_messages`` and work on the Parquet table from then on.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    named = by_name(raw, RAW_MESSAGE_SCHEMA.fieldNames())
    return with_file_order(raw, named).drop("_metadata")


def normalize_messages(raw: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """Typed messages: trimmed ids ("nan" and "" become null), boolean inbound, timestamps.

    ``inbound`` is true only for the word true in any case; null is false.  Dates that the format (by
    default ISO) does not fit are tried in the data set's own form, ``Tue Oct 31 22:10:47 +0000 2017``.
    """
    out = raw
    for c in ID_COLUMNS:
        if c in raw.columns:
            value = strip(F.col(c).cast("string"))
            out = out.withColumn(c, F.when(~value.isin("nan", ""), value))
    flag = F.lower(strip(F.col("inbound").cast("string"))) == "true"
    fmt = [F.lit(timestamp_format)] if timestamp_format else []
    return out.withColumn("inbound", F.coalesce(flag, F.lit(False))) \
        .withColumn("created_at", F.coalesce(
            F.try_to_timestamp(F.col("created_at").cast("string"), *fmt),
            F.try_to_timestamp(F.regexp_replace(F.col("created_at").cast("string"), "^[A-Za-z]{3} ", ""), F.lit(NATIVE_DATE))))


def load_messages(spark: SparkSession, path: str, timestamp_format: str | None = None) -> DataFrame:
    return normalize_messages(read_messages_csv(spark, path), timestamp_format)


def ingest_messages(spark: SparkSession, csv_path: str, table_path: str,
                    timestamp_format: str | None = None) -> DataFrame:
    """CSV -> splittable Parquet table, keeping file order in ``ingest_seq``."""
    load_messages(spark, csv_path, timestamp_format).write.mode("overwrite").parquet(table_path)
    return spark.read.parquet(table_path)
