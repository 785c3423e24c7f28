"""Operator 13: centroid clustering with a vantage-point tree over the centroids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.session import stored

#: Centroids of a tree's leaf, and the most numbers that all centroids may hold: the tree is broadcast.
LEAF, MOST = 4, 1 << 23
_LONG = (1 << 63) - 1


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows x to integer rows c."""
    gap = x[:, None, :] - c[None, :, :]
    return np.einsum("ijk,ijk->ij", gap, gap)


class VantageTree:
    """A vantage-point tree over integer centroids.

    A node is either a leaf of a few centroids or a vantage centroid with two children; each child knows the least
    and greatest distance of its centroids to the vantage, which bounds the distance of any vector to them.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.nodes: list[tuple] = []
        self._grow(np.arange(len(centroids)))

    def _grow(self, members: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(("leaf", members))
        if len(members) > LEAF:
            vantage, rest = members[0], members[1:]
            far = np.sqrt(squared(self.centroids[[vantage]], self.centroids[rest])[0].astype(float))
            order = np.argsort(far, kind="stable")
            halves = np.array_split(order, 2)
            self.nodes[at] = ("inner", vantage, [(self._grow(rest[np.sort(h)]), far[h].min(), far[h].max()) for h in halves])
        return at

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row its nearest centroid (the smaller number of equals) and the exact squared distance.

        Every row has its own best-first search: in each step it opens its unopened node of least bound, and ends
        when that bound is beyond its best distance; a bound equal to it is still opened, so that ties are found.
        Rows that open the same node are measured together.
        """
        n = len(x)
        bounds = np.full((n, len(self.nodes)), np.inf)  # inf: closed, or not reached yet
        bounds[:, 0] = 0
        best, who = np.full(n, _LONG), np.full(n, len(self.centroids))

        def measure(rows: np.ndarray, members: np.ndarray) -> np.ndarray:
            d = squared(x[rows], self.centroids[members])
            for m, column in zip(members.tolist(), d.T):
                better = (column < best[rows]) | ((column == best[rows]) & (m < who[rows]))
                best[rows[better]], who[rows[better]] = column[better], m
            return d

        active = np.arange(n)
        while len(active):
            node = bounds[active].argmin(axis=1)
            going = bounds[active, node] <= np.sqrt(best[active].astype(float))
            active, node = active[going], node[going]
            for t in np.unique(node).tolist():
                rows, kind = active[node == t], self.nodes[t]
                bounds[rows, t] = np.inf
                if kind[0] == "leaf":
                    measure(rows, kind[1])
                    continue
                far = np.sqrt(measure(rows, np.array([kind[1]]))[:, 0].astype(float))
                for child, low, high in kind[2]:
                    slack = 1e-9 * (1 + far + high)  # rounded roots never close a node that is due
                    bounds[rows, child] = np.maximum(np.maximum(low - far, far - high) - slack, 0)
        return who, best


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, key: str = "vec_id", vector: str = "embedding", width: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Components become floor(scale * x). The first centroids are the k vectors with smallest sha256 of `seed:key`. A
    round assigns every vector to its nearest centroid (ties: the smaller number) and replaces each centroid that
    has vectors by the floor of their mean; then all are assigned once more. In a round only one row of sums per
    task and centroid is shuffled, and the driver holds the centroids alone, which are bounded by k * width.

    Vectors that are null, of another width, or hold null or non-finite components take no part. A null key takes
    part but starts no centroid; rows that repeat a key are vectors of their own (ties in the start go to the least
    vector). Fewer than k vectors give fewer centroids. Components are held within the range where squared distances
    fit a long; a sum of distances beyond a long is null. Other columns are not read; an empty table gives an
    empty result.
    """
    if k < 1 or k * width > MOST:
        raise ValueError(f"k * width must lie between {width} and {MOST}: the centroids are broadcast")
    spark, reach = vectors.sparkSession, float(min(isqrt((1 << 62) // width) // 2, 1 << 30))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where((F.size(vector) == width) & finite).select(
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(reach)), F.lit(-reach))).cast("int")).alias("v"),
    )
    rows = stored(rows, "vectors")
    first = rows.where("id is not null").orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), "v").limit(k)
    centroids = np.array([r["v"] for r in first.select("v").collect()], dtype=np.int64).reshape(-1, width)
    for _ in range(rounds if len(centroids) else 0):
        tree = spark.sparkContext.broadcast(VantageTree(centroids))

        def sums(batches: Iterator[pa.RecordBatch], tree=tree, k=len(centroids)) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros((k, width), dtype=np.int64), np.zeros(k, dtype=np.int64)
            for batch in batches:
                x = _matrix(batch.column(0), width)
                who, _ = tree.value.nearest(x)
                np.add.at(total, who, x)
                n += np.bincount(who, minlength=k)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some], pa.int64()), pa.array(list(total[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

        parts = rows.select("v").mapInArrow(sums, "cluster int, n long, sums array<long>")
        means = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.get("sums", F.lit(j)).cast("decimal(38,0)")) for j in range(width))).alias("sums")).collect()
        tree.unpersist()
        centroids = centroids.copy()
        for r in means:
            centroids[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
    tree = spark.sparkContext.broadcast(VantageTree(centroids)) if len(centroids) else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if tree is not None and len(batch):
                who, far = tree.value.nearest(_matrix(batch.column(1), width))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(who, pa.int32()), pa.array(far, pa.int64())], ["id", "cluster", "distance"])

    found = stored(rows.mapInArrow(assign, "id long, cluster int, distance long"), "clusters")
    sums_ = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole_sum = sum(sums_.values())
    shown = [(c, s if s <= _LONG else None, whole_sum if whole_sum <= _LONG else None, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums_.items()]
    totals = spark.createDataFrame(shown, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(totals), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
