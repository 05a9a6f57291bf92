"""Exact cosine top-k of query vectors against an evidence store.

Two plans, same result:

* ``broadcast``: a bounded block of queries is shipped to the store partitions.  The
  store is scanned in place, each partition keeps k candidates per query.
* ``tiled``: when queries do not fit the bound, the store is clustered into tiles
  (``vector_index``).  A query visits the tiles whose bound reaches its k-th score;
  queries and the visited part of a tile meet in cells of bounded size.

Both only ever shuffle k candidates per query and partition or cell; nothing is pruned
approximately.  ``vector_index.ann_topk`` is the approximate alternative.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from threadlens.functions.numeric import half_even
from threadlens.functions.text import is_blank
from threadlens.operators.vector_index import TILE_ROWS, TileIndex, build_tile_index, search_tiles, search_vectors
from threadlens.plans.skew import HOT_ROWS, skew_lookup
from threadlens.schema import TOP_K

BROADCAST_BYTES = 64 * 1024 * 1024
QUERY_BLOCK = 256
TIE_DIGITS = 12  # scores closer than this tie and fall back to the id


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column -> (rows, dim) float64 matrix of unit rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    m = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm != 0)


def _block_topk(q: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row/column/score of the k best columns per row; equal scores keep the earlier column."""
    scores = np.round(q @ s.T, TIE_DIGITS)
    k = min(k, scores.shape[1])
    floor = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    rows, cols = np.nonzero(scores >= floor)
    vals = scores[rows, cols]
    order = np.lexsort((cols, -vals, rows))
    rows, cols, vals = rows[order], cols[order], vals[order]
    starts = np.searchsorted(rows, np.arange(q.shape[0]))
    keep = np.arange(len(rows)) - starts[rows] < k
    return rows[keep], cols[keep], vals[keep]


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Id column as a sortable numpy array (numbers, or fixed-width unicode)."""
    out = column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)
    return out.astype(str) if out.dtype == object else out


def _match(q: np.ndarray, sids: np.ndarray, s: np.ndarray, k: int):
    """(query position, store id, score) of the k best store rows per query, block by block."""
    order = np.argsort(sids, kind="stable")
    sids, s = sids[order], s[order]
    for at in range(0, len(q), QUERY_BLOCK):
        rows, cols, vals = _block_topk(q[at:at + QUERY_BLOCK], s, k)
        yield at + rows, sids[cols], vals


def _trim(rows: np.ndarray, sids: np.ndarray, vals: np.ndarray, k: int):
    """Keep the k best entries per query position (score descending, id ascending)."""
    order = np.lexsort((sids, -vals, rows))
    rows, sids, vals = rows[order], sids[order], vals[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
    return rows[keep], sids[keep], vals[keep]


def _final(candidates: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "store_id")
    return candidates.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "store_id", half_even(F.col("score"), 4).alias("similarity"))


def _candidate_type(queries: DataFrame, query_id: str, store: DataFrame, store_id: str) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema[query_id].dataType),
        T.StructField("store_id", store.schema[store_id].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _table(qids: np.ndarray, sids: np.ndarray, vals: np.ndarray, arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(qids, type=arrow.field(0).type), pa.array(sids, type=arrow.field(1).type),
         pa.array(vals, type=arrow.field(2).type)], schema=arrow)


def topk_similar(queries: DataFrame, store: DataFrame, k: int = TOP_K, *, query_id: str, store_id: str,
                 vector: str = "embedding", query_text: str | None = None, plan: str = "auto",
                 broadcast_bytes: int = BROADCAST_BYTES, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(query_id, rank, store_id, similarity): ranks 1..min(k, store size) per query.

    ``query_text`` names a text column; blank texts get no result.  ``auto`` picks the
    broadcast plan only after counting that the query vectors stay within
    ``broadcast_bytes``; the count stops at the bound.
    """
    q = queries.where(F.col(vector).isNotNull())
    if query_text:
        q = q.where(~is_blank(F.col(query_text)))
    q = q.select(F.col(query_id), F.col(vector).cast("array<double>").alias("v"))
    s = store.where(F.col(vector).isNotNull()).select(F.col(store_id), F.col(vector).cast("array<double>").alias("v"))
    schema = _candidate_type(queries, query_id, store, store_id)
    if plan == "auto":
        first = q.select(F.size("v")).first()
        if first is None:
            return _final(q.sparkSession.createDataFrame([], schema), k)
        limit = max(1, broadcast_bytes // (8 * first[0]))
        plan = "broadcast" if q.limit(limit + 1).count() <= limit else "tiled"
    if plan == "broadcast":
        return _final(_broadcast_candidates(q, s, k, schema), k)
    index = build_tile_index(store.select(store_id, vector), store_id=store_id, vector=vector, keep=k, tile_rows=tile_rows)
    return search_tiles(q, index, k, query_id=query_id, vector="v", in_place=False)


def _broadcast_candidates(q: DataFrame, s: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    table = q.toArrow()  # bounded by broadcast_bytes; Spark ships it with the function and drops it with the plan
    qids, qm = _ids(table.column(0)), _matrix(table.column(1))
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            if not batch.num_rows or not len(qids):
                continue
            parts = list(_match(qm, _ids(batch.column(0)), _matrix(batch.column(1)), k))
            if best is not None:
                parts.append(best)
            best = _trim(*(np.concatenate(c) for c in zip(*parts)), k)
        if best is not None:
            yield _table(qids[best[0]], best[1], best[2], arrow)

    return s.mapInArrow(scan, schema)


META = ["customer_text", "brand_text", "conversation_id", "created_at"]


def _meta(store: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in store.columns else F.lit("").alias(c) for c in META]


def attach_evidence(topk: DataFrame, store: DataFrame, *, store_id: str,
                    hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(query_id, evidence, n_evidence, evidence_score): the ranked examples per query.

    A store row may be the best match of very many queries, hence the skew-aware
    lookup.  A query carries at most k examples.
    """
    meta = store.select(F.col(store_id).alias("__sid"), *_meta(store))
    return pack_evidence(skew_lookup(topk, meta, "store_id", "__sid", spread="query_id", how="inner", hot_rows=hot_rows))


def pack_evidence(found: DataFrame) -> DataFrame:
    """Top-k rows with their examples as one row per query."""
    return found.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "similarity", *META))).alias("evidence"),
        F.count(F.lit(1)).cast("int").alias("n_evidence"),
        half_even(F.avg("similarity"), 4).alias("evidence_score"))


def shared_evidence(topk: DataFrame, store: DataFrame, *, store_id: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(share, answers, examples): what ``own_evidence`` needs for all queries of a ``share``, a column of ``topk``, a written table.

    Queries of one share should have much the same best rows, and be few; each example then travels once a share, not once a
    query.  A store row comes ``copies`` times where ``topk`` has such a column.
    """
    copies = [F.first("copies").alias("copies")] if "copies" in topk.columns else [F.lit(1).alias("copies")]
    pairs = topk.groupBy("share", "store_id").agg(*copies)
    meta = store.select(F.col(store_id).alias("__sid"), *_meta(store))
    found = skew_lookup(pairs, meta, "store_id", "__sid", spread="share", how="inner", hot_rows=hot_rows)
    examples = found.groupBy("share").agg(F.collect_list(F.struct("store_id", "copies", *META)).alias("examples"))
    answers = topk.groupBy("share").agg(F.collect_list(F.struct("query_id", "rank", "similarity", "store_id")).alias("answers"))
    return answers.join(examples, "share")


def own_evidence(rows: DataFrame, query_id: str) -> DataFrame:
    """``rows`` that carry ``answers`` and ``examples``, with the evidence columns of ``attach_evidence`` instead."""
    def shown(a: Column) -> Column:
        same = F.filter("examples", lambda e: e["store_id"] == a["store_id"])
        return F.flatten(F.transform(same, lambda e: F.array_repeat(F.struct(a["rank"].alias("rank"), a["similarity"].alias("similarity"), *[e[c].alias(c) for c in META]), e["copies"].cast("int"))))

    own = F.filter("answers", lambda a: a["query_id"] == F.col(query_id))
    found = rows.withColumn("evidence", F.array_sort(F.flatten(F.transform(own, shown)))).where(F.size("evidence") > 0).drop("answers", "examples")
    total = F.aggregate("evidence", F.lit(0.0), lambda t, e: t + e["similarity"])
    return found.withColumn("n_evidence", F.size("evidence")).withColumn("evidence_score", half_even(total / F.size("evidence"), 4))


def build_evidence_index(store: DataFrame, path: str | None = None, *, store_id: str = "store_id", vector: str = "embedding", k: int = TOP_K, **params) -> TileIndex:
    """A tile index of an evidence store with the examples' texts beside their vectors."""
    return build_tile_index(store.select(F.col(store_id).alias("store_id"), vector, *_meta(store)), path, store_id="store_id", vector=vector, keep=k, columns=META, **params)


def find_evidence(queries: DataFrame, store: DataFrame | TileIndex, k: int = TOP_K, *, query_id: str, store_id: str = "store_id", vector: str = "embedding") -> DataFrame:
    """Evidence of every query from a store, or from an index whose visited tiles alone are read."""
    if isinstance(store, TileIndex):
        return pack_evidence(search_tiles(queries, store, k, query_id=query_id, vector=vector, extra=META))
    return attach_evidence(topk_similar(queries, store, k, query_id=query_id, store_id=store_id, vector=vector), store, store_id=store_id)


def add_evidence(rows: DataFrame, store: DataFrame | TileIndex, k: int = TOP_K, *, key: str, store_id: str = "store_id", vector: str = "embedding",
                 texts_of: DataFrame) -> DataFrame:
    """``texts_of`` with the evidence columns of its ``key``, null where nothing was found; ``rows`` (key, vector) are the queries.

    With an index the examples are put together once a distinct vector, whose key ``texts_of`` carries as ``__vk``, and join the
    rows last, so that they are not shuffled once a row.
    """
    if not isinstance(store, TileIndex):
        found = find_evidence(rows, store, k, query_id=key, store_id=store_id, vector=vector).withColumnRenamed("query_id", key)
        return texts_of.drop("__vk").join(found, key, "left")
    best = search_vectors(rows, store, k, vector=vector, extra=META).select(F.col("qk").alias("query_id"), "rank", half_even(F.col("score"), 4).alias("similarity"), *META)
    return skew_lookup(texts_of, pack_evidence(best), "__vk", "query_id", spread=key, how="left").drop("__vk")


def evidence_score(queries: DataFrame, topk: DataFrame, *, query_id: str) -> DataFrame:
    """Mean of the rounded similarities per query, 0.0 where nothing was retrieved."""
    means = topk.groupBy("query_id").agg(F.avg("similarity").alias("m"), F.count(F.lit(1)).alias("n"))
    return queries.select(F.col(query_id).alias("query_id")).join(means, "query_id", "left").select(
        "query_id", F.coalesce("n", F.lit(0)).alias("n_evidence"),
        half_even(F.coalesce("m", F.lit(0.0)), 4).alias("evidence_score"))


def similarity_distribution(topk: DataFrame) -> DataFrame:
    """Distribution of retrieved similarities.

    The percentile buffer holds one counter per distinct similarity, and those have
    four decimals.
    """
    s = F.col("similarity")
    return topk.agg(
        F.count(F.lit(1)).alias("n"), half_even(F.avg(s), 3).alias("mean"),
        half_even(F.percentile(s, 0.5), 3).alias("median"),
        half_even(F.min(s), 3).alias("min"), half_even(F.max(s), 3).alias("max"),
        half_even(F.avg(F.when(s > 0.5, 100.0).otherwise(0.0)), 1).alias("pct_above_05"),
        half_even(F.avg(F.when(s > 0.3, 100.0).otherwise(0.0)), 1).alias("pct_above_03"))
