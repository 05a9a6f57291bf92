"""Token counts as delta-maintained rollups.

Totals (documents, tokens) by source, language and tokenizer version are never recomputed: a batch of signed
changes - inserts (+), deletes (-), revisions (- old, + new) - is summed up by key and appended as one small
delta, and totals are the sum of committed deltas.  A delta counts only if the commit table names its attempt;
the commit row is written last.  A batch whose id is committed is skipped, an attempt that died half-way is never
read, and of two racing attempts of one batch the smaller name counts: replays change nothing.

Null source, language or tokenizer is a key of its own.  Null texts have 0 tokens but are documents.  An empty
batch commits and adds nothing.  Repeated documents count each.  Keys whose totals return to 0 documents and
0 tokens are dropped from the totals.  ``compact`` folds all committed deltas into one; every compaction has a batch id of
its own (``compacted-...``, which no batch may use) and leaves those of earlier compactions behind.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.bpe import read_ranks
from threadlens.llm.common import slices

KEYS = ["source", "lang", "tokenizer"]
COMPACTED = "compacted-"
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch_id string, attempt string"
COMMIT = "batch_id string, attempt string"


@lru_cache(maxsize=4)
def counter(path: str, pattern: str):
    import tiktoken
    return tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def count_tokens(text: Column, ranks_path: str, pattern: str) -> Column:
    """Tokens of a whole text in a byte-level vocabulary; 0 for null."""

    @F.arrow_udf(T.LongType())
    def count(texts: pa.Array) -> pa.Array:
        model = counter(ranks_path, pattern)
        return pa.array([len(model.encode_ordinary(t)) if t else 0 for start, stop in slices(texts)
                         for t in texts.slice(start, stop - start).to_pylist()], pa.int64())

    return count(text.cast("string"))


def signed(rows: DataFrame, sign: int, count_col: str, tokenizer: str) -> DataFrame:
    """Inserts (sign 1) or deletes (sign -1) of counted documents as changes."""
    return rows.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"),
                       (F.coalesce(F.col(count_col), F.lit(0)) * sign).cast("long").alias("n_tokens"))


class Rollup:
    """Totals below one shared folder; one writer at a time is expected, replays and crashes are safe."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.deltas, self.commits = spark, f"{path}/deltas", f"{path}/commits"
        for schema, place in ((DELTA, self.deltas), (COMMIT, self.commits)):
            spark.createDataFrame([], schema).write.mode("append").parquet(place)

    def committed(self) -> DataFrame:
        return self.spark.read.schema(COMMIT).parquet(self.commits).groupBy("batch_id").agg(F.min("attempt").alias("attempt"))

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of signed changes; False if it is committed already."""
        if batch_id.startswith(COMPACTED):
            raise ValueError(f"batch ids must not begin with {COMPACTED}")
        return self._apply(batch_id, changes)

    def _apply(self, batch_id: str, changes: DataFrame) -> bool:
        if not self.committed().where(F.col("batch_id") == batch_id).isEmpty():
            return False
        attempt = uuid.uuid4().hex
        sums = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        sums.withColumn("batch_id", F.lit(batch_id)).withColumn("attempt", F.lit(attempt)).write.mode("append").parquet(self.deltas)
        self.spark.createDataFrame([(batch_id, attempt)], COMMIT).coalesce(1).write.mode("append").parquet(self.commits)
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all committed batches."""
        deltas = self.spark.read.schema(DELTA).parquet(self.deltas)
        return (deltas.join(self.committed(), ["batch_id", "attempt"], "left_semi").groupBy(*KEYS)
                .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0"))

    def compact(self, path: str) -> Rollup:
        """A new rollup below ``path`` with the same totals in one delta, which goes on skipping the batches committed so far."""
        new = Rollup(self.spark, path)
        new._apply(COMPACTED + uuid.uuid4().hex, self.totals())
        self.committed().where(~F.col("batch_id").startswith(COMPACTED)).write.mode("append").parquet(new.commits)
        return new
