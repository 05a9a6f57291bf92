"""Centroid clustering with PCA-rotated filtering against plain loops."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import pca_clusters

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, id string, lead int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2) for i, v in rows], SCHEMA)


def plain(rows, components, clusters, rounds):
    """[(id, cluster, distance, cluster inertia, inertia, centroid digest)] by comparing everything with everything."""
    kept = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in order[:clusters]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, g in groups.items():
            centroids[k] = tuple(sum(x) // len(g) for x in zip(*g))
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for _, _, d in found)
    return [(i, k, d, sum(e for _, j, e in found if j == k), total, hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for i, k, d in found]


def spread(rng, n, components, centres):
    where = rng.normal(scale=3, size=(centres, components))
    return [(k, (where[rng.integers(centres)] + rng.normal(scale=0.3, size=components)).tolist()) for k in range(n)]


@pytest.mark.parametrize("components, clusters, lead", [(8, 5, 3), (8, 12, 8), (3, 4, 1)])
def test_same_as_plain_loops(spark, components, clusters, lead):
    rng = np.random.default_rng(components + clusters)
    rows = spread(rng, 150, components, 6)
    rows += [(1000 + k, [0.5] * components) for k in range(40)]                    # one value many times
    rows += [(1000, [0.5] * components), (1000, [9.0] * components), (None, [0.25] * components)]  # repeated and null ids
    rows += [(2000 + k, [float(s)] + [0.0] * (components - 1)) for k, s in enumerate((-1, 1, -1, 1))]  # ties
    rows += [(3000, None), (3001, []), (3002, [1.0] * (components + 1)), (3003, [None] + [1.0] * (components - 1)),
             (3004, [float("nan")] * components), (3005, [float("inf")] + [0.0] * (components - 1)), (3006, [-0.001] * components)]
    got = pca_clusters.cluster_vectors(table(spark, rows).repartition(5), components=components, clusters=clusters, rounds=3, lead=lead)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows, components, clusters, 3), key=repr)


def test_empty_tables_and_ids(spark):
    for rows in ([], [(1, None)], [(None, [1.0, 2.0])]):
        assert pca_clusters.cluster_vectors(table(spark, rows), components=2).collect() == []
    one = pca_clusters.cluster_vectors(table(spark, [(7, [1.0, 2.0])]), components=2, lead=2).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in one] == [(7, 0, 0, 0)]


def test_too_large_components_end_the_job(spark):
    with pytest.raises(Exception, match="component beyond"):
        pca_clusters.cluster_vectors(table(spark, [(1, [1e9, 0.0])]), components=2).collect()


def test_filter_leaves_few_centroids_to_measure(spark):
    rng = np.random.default_rng(1)
    kept = table(spark, spread(rng, 2000, 32, 20)).select(F.col("vec_id").alias("id"), pca_clusters.integers(F.col("embedding"), 32).alias("cells"))
    centroids = pca_clusters.first_centroids(kept, 20, "2:")
    mean, turn = pca_clusters.rotation(*pca_clusters.moments(kept, 32), 8)
    _, measured = pca_clusters.fit(pca_clusters.store(kept, mean, turn), centroids, mean, turn, 3)
    assert measured[-1] < 2000 * 4  # of 20 centroids a vector


def test_bound_never_loses_the_nearest():
    rng = np.random.default_rng(2)
    for scale in (1, 1000, 1 << 26):
        cells = rng.integers(-scale, scale + 1, size=(300, 6))
        cells[100:200] = cells[0]
        centroids = np.concatenate([cells[:10], cells[:10] + rng.integers(0, 2, size=(10, 6))])
        mean, turn = pca_clusters.rotation(len(cells), cells.sum(axis=0).astype(float), (cells.T.astype(float) @ cells), 2)
        lead, rest, _ = pca_clusters.project(cells.astype(float), mean, turn)
        cluster, distance, _ = pca_clusters.nearest(cells, lead, rest, centroids, mean, turn)
        exact = ((cells[:, None].astype(object) - centroids) ** 2).sum(axis=2)
        assert [min((d, k) for k, d in enumerate(r)) for r in exact] == list(zip(distance.tolist(), cluster.tolist()))
