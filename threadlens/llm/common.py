"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLICE_BYTES = 4 << 20   # text handled at once inside a task
SLICE_ROWS = 2048
BINS = 256              # counted per wanted rank and round


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of every value; null counts as 0."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(texts: pa.Array, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[tuple[int, int]]:
    """(start, stop) runs of at most ``rows`` values and about ``limit`` bytes; one longer value stands alone."""
    start = size = 0
    for i, n in enumerate(byte_lengths(texts).tolist()):
        if i > start and (size + n > limit or i - start >= rows):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3: rows with 1 are held out from learning."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


def list_array(flat: np.ndarray, counts: list[int]) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def first_rows(rows: DataFrame, group: str, order: list[Column | str], n: int) -> DataFrame:
    """The ``n`` rows of each group that come first in ``order``.

    Rows are ranked among those of one task in 256 first, so the last ranking reads at most 256 * ``n`` rows of a
    group however many tasks there are; the rows chosen do not depend on how they were dealt out.
    """
    left = rows.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(256)))
    for keys in ([group, "__part"], [group]):
        left = left.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(f"__rank <= {n}")
    return left.drop("__part", "__rank")


def values_at(rows: DataFrame, ranks: dict[str, Iterable[int]]) -> dict[tuple[str, int], float]:
    """The values that stand at the given places (from 0) of the ascending order of each ``key``; exact.

    ``rows`` is a written table (key, value).  Values around a wanted place are counted in BINS bins, and those of the bin that
    holds it again, until they are all equal, so no task sorts a group and the driver gets BINS rows a place and round.
    """
    spark, found = rows.sparkSession, {}
    ends = {r.key: (r.low, r.high) for r in rows.groupBy("key").agg(F.min("value").alias("low"), F.max("value").alias("high")).collect()}
    open_ = {(key, rank): (*ends[key], rank) for key, some in ranks.items() for rank in set(some)}
    while open_:
        for at in [at for at, (low, high, _) in open_.items() if low == high]:
            found[at] = open_.pop(at)[0]
        if not open_:
            break
        spans = spark.createDataFrame([(*at, low, high) for at, (low, high, _) in open_.items()], "key string, rank long, low double, high double")
        near = rows.join(F.broadcast(spans), "key").where("value between low and high")
        place = F.least(F.lit(BINS - 1), F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * BINS).cast("int"))
        bins = near.groupBy("key", "rank", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
        passed: dict[tuple[str, int], int] = {}
        left = {at: rest for at, (_, _, rest) in open_.items()}
        for r in sorted(bins, key=lambda r: r.bin):
            at = (r.key, r.rank)
            before = passed.get(at, 0)
            passed[at] = before + r.n
            if before <= left[at] < before + r.n:
                open_[at] = (r.low, r.high, left[at] - before)
    return found
