"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the run-time half of the scaling story: partition
# coalescing after aggregations and splitting of skewed sort-merge partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def build_session(app: str = "threadlens", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the defaults above.

    On a cluster leave ``master`` and ``shuffle_partitions`` to spark-submit.
    ``conf`` keys use ``__`` for dots, e.g. ``spark__ui__enabled="false"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
