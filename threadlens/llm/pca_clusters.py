"""Centroid clustering on integer vectors with PCA-rotated filtering.

1. Kept vectors have exactly ``components`` finite components; each becomes the integer floor(256 * x).
2. One pass adds up their sums and products (``components`` squared numbers); the eigenvectors of the covariance give a
   rotation.  Per vector the ``lead`` leading rotated coordinates and the norm of what they leave out are stored
   beside the integers, in one written table.
3. A round broadcasts the centroids (at most ``clusters`` rows).  For a vector and a centroid, the squared distance of
   the leading coordinates plus the squared difference of the two residual norms never exceeds their squared distance.
   The centroid with the smallest bound is measured first, in integers; every centroid whose bound does not exceed
   that distance survives and is measured in integers, too.  Ties go to the smaller number.  Rounding errors of the
   bound only let more centroids survive, so results are exact.
4. Tasks add up the integers of their vectors per centroid; only these sums are shuffled, and at most ``clusters`` rows
   reach the driver in a round.

Vectors that are null, have another number of components, or a null, NaN or infinite one are left out.  Rows that repeat
an id are vectors each; a null id is never a first centroid.  Equal hashes are taken in the order of components.  With
fewer than ``clusters`` vectors that have an id there are as many centroids; with none, no rows come out.  A component
beyond 2**19 in size is an error, as squared distances would not fit a long.  Only the id and vector columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.sources.scratch import materialize

SCALE, LIMIT = 256, 1 << 19
CLUSTERS, ROUNDS, LEAD = 40, 5, 16
SLACK = 1e-9           # relative to the squared norms: far above the rounding errors of a bound
PAIRS = 1 << 15        # (vector, centroid) pairs measured at once
ROWS = 4096            # vectors compared at once


def integers(vector: Column, components: int) -> Column:
    """floor(256 * x) of every component; null for vectors that are not kept."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    small = F.forall(x, lambda v: F.abs(v) <= LIMIT)
    cells = F.transform(x, lambda v: F.floor(v * SCALE).cast("int"))
    return F.when((F.size(vector) == components) & finite, F.when(small, cells).otherwise(F.raise_error(F.lit(f"component beyond {LIMIT}"))))


def matrix(column: pa.Array, width: int, kind: type = np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def moments(kept: DataFrame, components: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(number, sums, sums of products) over all vectors; tasks add up first, then Spark adds by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components + 1, components + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = matrix(batch.column(0).slice(at, ROWS), components, np.float64)
                x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
                total += x.T @ x
        if total[0, 0]:
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["place", "value"])

    rows = kept.select("cells").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((components + 1) ** 2)  # that many rows at most
    for r in rows:
        total[r.place] = r.value
    total = total.reshape(components + 1, components + 1)
    return int(total[0, 0]), total[0, 1:], total[1:, 1:]


def rotation(n: int, sums: np.ndarray, products: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, components x lead orthonormal directions of largest variance)."""
    mean = sums / n
    _, vectors = np.linalg.eigh(products / n - np.outer(mean, mean))
    return mean, vectors[:, ::-1][:, :lead].copy()


def project(x: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leading coordinates, residual norms, squared norms) of rows about the mean."""
    centred = x - mean
    lead = centred @ turn
    norms = (centred ** 2).sum(axis=1)
    return lead, np.sqrt(np.maximum(0.0, norms - (lead ** 2).sum(axis=1))), norms


def nearest(cells: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance, pairs measured) of integer rows."""
    own, own_rest, own_norms = project(centroids.astype(np.float64), mean, turn)
    lead_norms = (lead ** 2).sum(axis=1)
    bound = lead_norms[:, None] + (own ** 2).sum(axis=1) - 2.0 * (lead @ own.T) + (rest[:, None] - own_rest) ** 2
    bound -= SLACK * ((lead_norms + rest ** 2)[:, None] + own_norms + 1.0)
    guess = bound.argmin(axis=1)
    every = np.arange(len(cells))
    upper = measure(cells, centroids, every, guess)
    bound[every, guess] = np.inf
    rows, columns = np.nonzero(bound <= upper[:, None])
    found = measure(cells, centroids, rows, columns)
    rows, columns, found = (np.concatenate(x) for x in ((every, rows), (guess, columns), (upper, found)))
    order = np.lexsort((columns, found, rows))
    first = order[np.concatenate([[True], np.diff(rows[order]) > 0])] if len(order) else order
    return columns[first], found[first], len(rows)


def measure(cells: np.ndarray, centroids: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Exact squared distances of (row, centroid) pairs."""
    out = np.empty(len(rows), dtype=np.int64)
    for at in range(0, len(rows), PAIRS):
        off = cells[rows[at:at + PAIRS]] - centroids[columns[at:at + PAIRS]]
        out[at:at + PAIRS] = np.einsum("ij,ij->i", off, off)
    return out


def store(kept: DataFrame, mean: np.ndarray, turn: np.ndarray) -> DataFrame:
    """(id, cells, lead, rest): integers, leading rotated coordinates and residual norm of every vector."""
    kind = kept.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                lead, rest, _ = project(matrix(part.column(1), len(mean), np.float64), mean, turn)
                offsets = pa.array(np.arange(0, lead.size + 1, lead.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(offsets, pa.array(lead.ravel())), pa.array(rest)],
                                                 names=["id", "cells", "lead", "rest"])

    return kept.mapInArrow(run, f"id {kind}, cells array<int>, lead array<double>, rest double")


def assigned(stored: DataFrame, centroids: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> DataFrame:
    """(id, cluster, distance): nearest centroid of every stored vector."""
    kind, lead_width = stored.schema["id"].dataType.simpleString(), turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                cluster, distance, _ = nearest(matrix(part.column(1), len(mean)), matrix(part.column(2), lead_width, np.float64),
                                               part.column(3).to_numpy(), centroids, mean, turn)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], names=["id", "cluster", "distance"])

    return stored.select("id", "cells", "lead", "rest").mapInArrow(run, f"id {kind}, cluster int, distance long")


def cluster_sums(stored: DataFrame, centroids: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> list:
    """One row a non-empty cluster: (cluster, number, component sums, pairs measured)."""
    width, lead_width = len(mean), turn.shape[1]
    fields = [f"s{k}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, pairs = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), width), np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                cells = matrix(part.column(0), width)
                cluster, _, measured = nearest(cells, matrix(part.column(1), lead_width, np.float64), part.column(2).to_numpy(), centroids, mean, turn)
                counts += np.bincount(cluster, minlength=len(centroids))
                np.add.at(sums, cluster, cells)
                pairs += measured
        used = np.flatnonzero(counts)
        if len(used):
            share = np.zeros(len(used), np.int64)
            share[0] = pairs
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(share), *[pa.array(sums[used, k]) for k in range(width)]],
                                             names=["cluster", "n", "measured", *fields])

    schema = "cluster int, n long, measured long, " + ", ".join(f"{f} long" for f in fields)
    return stored.select("cells", "lead", "rest").mapInArrow(run, schema).groupBy("cluster") \
        .agg(*[F.sum(c).alias(c) for c in ("n", "measured", *fields)]).collect()  # one row a cluster


def first_centroids(kept: DataFrame, clusters: int, prefix: str) -> np.ndarray:
    """The integers of the vectors whose ids have the smallest hashes, in ascending order of these."""
    marked = kept.where("id is not null").select(F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")).cast("binary"), 256).alias("h"), "cells")
    return np.array([r.cells for r in marked.orderBy("h", "cells").limit(clusters).collect()], dtype=np.int64)  # limit: the number of centroids


def fit(stored: DataFrame, centroids: np.ndarray, mean: np.ndarray, turn: np.ndarray, rounds: int) -> tuple[np.ndarray, list[int]]:
    """(centroids after the rounds, pairs measured in each)."""
    measured = []
    for _ in range(rounds):
        centroids = centroids.copy()
        rows = cluster_sums(stored, centroids, mean, turn)
        measured.append(sum(r.measured for r in rows))
        for r in rows:
            centroids[r.cluster] = [v // r.n for v in r[3:]]
    return centroids, measured


def cluster_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 64, clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, lead: int = LEAD, prefix: str = "2:") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    kind = vectors.schema[id_col].dataType.simpleString()
    kept = vectors.select(F.col(id_col).alias("id"), integers(F.col(vector_col), components).alias("cells")).where("cells is not null")
    centroids = first_centroids(kept, clusters, prefix)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    mean, turn = rotation(*moments(kept, components), lead)
    stored = materialize(store(kept, mean, turn), "rotated")
    centroids, _ = fit(stored, centroids, mean, turn, rounds)
    done = materialize(assigned(stored, centroids, mean, turn), "clusters")
    inertia = {r.cluster: r.inertia for r in done.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # one row a centroid
    facts = [(k, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest()) for k in sorted(inertia)]
    facts = done.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
