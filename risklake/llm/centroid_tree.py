"""Centroid clustering of vectors in whole numbers, with a vantage-point tree over the centroids.

Every component x becomes floor(SCALE * x). Each round the centroids are put into a
vantage-point tree, which is broadcast; every vector looks for its nearest centroid best-first:
of the nodes open to it, the one with the least possible distance is next, until that is greater
than the best distance found. The bound is inclusive, so that equally near centroids are all
seen and the smaller number wins. Distances to centroids are whole numbers, hence exact; bounds
are floating point and lowered by more than their rounding, so no node is left out wrongly.
The search runs for all vectors of a batch at once, each with its own open nodes.

What a round sends on is one row of sums a task and centroid, what the driver and broadcasts
hold is ``clusters`` centroids: neither grows with the vectors, and a frequent vector is
just many rows. Vectors are read once a round and never shuffled; give a stored table, or cut the
lineage of an expensive plan first. A round that changes no centroid ends the rounds, since all
others would be the same.

Vectors of another length than ``dimensions``, null vectors, and those with a null, infinite or NaN
component are left out. Components beyond +-2**27 after scaling are cut to that, so that squared
distances fit 64 bits. Repeated rows, also of one id, count each. A null id is kept; its seed text is
"seed:". With fewer vectors than clusters there are fewer centroids, with none no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024
CLUSTERS, ROUNDS, SEED, DIMENSIONS = 8, 10, 3, 64
#: Largest scaled component.
REACH = 2**27
#: Centroids in a leaf.
LEAF = 4
#: Bounds are lowered by this share of the distances they come from; far above double rounding.
SLACK = 2.0**-40
#: Vectors that are searched at once.
AT_ONCE = 1000


@dataclass(frozen=True)
class Node:
    """Of an inner node the vantage point, the children, and each child's least and greatest distance from the
    vantage point; of a leaf its centroids."""

    members: tuple[int, ...] = ()
    vantage: int = -1
    children: tuple[int, ...] = ()
    shells: tuple[tuple[float, float], ...] = ()


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = vectors - point
    return np.einsum("ij,ij->i", gap, gap)


def build_tree(points: np.ndarray) -> list[Node]:
    """Node 0 is the root. The vantage point is the centroid farthest from the first one; the
    others are halved by their distance from it."""
    nodes: list[Node] = []

    def add(members: np.ndarray) -> int:
        here = len(nodes)
        nodes.append(Node())
        if len(members) <= LEAF:
            nodes[here] = Node(members=tuple(members.tolist()))
            return here
        vantage = members[np.argmax(squared(points[members], points[members[0]]))]
        rest = members[members != vantage]
        far = np.sqrt(squared(points[rest], points[vantage]).astype(float))
        order = np.argsort(far, kind="stable")
        halves = [h for h in np.array_split(order, 2) if len(h)]
        children = tuple(add(rest[h]) for h in halves)
        nodes[here] = Node(vantage=int(vantage), children=children, shells=tuple((far[h].min(), far[h].max()) for h in halves))
        return here

    add(np.arange(len(points)))
    return nodes


def nearest(vectors: np.ndarray, points: np.ndarray, nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of every vector's nearest point; of equally near ones the
    smaller number."""
    n = len(vectors)
    number, best = np.full(n, len(points)), np.full(n, np.iinfo(np.int64).max)
    open_at = np.full((n, len(nodes)), np.inf)
    open_at[:, 0] = 0.0
    alive = np.arange(n)

    def offer(rows: np.ndarray, point: int) -> np.ndarray:
        found = squared(vectors[rows], points[point])
        better = (found < best[rows]) | ((found == best[rows]) & (point < number[rows]))
        best[rows[better]], number[rows[better]] = found[better], point
        return found

    while len(alive):
        choice = open_at[alive].argmin(axis=1)
        bound = open_at[alive, choice]
        # Square roots of whole numbers below 2**63 are off by far less than the slack.
        inside = bound <= np.sqrt(best[alive].astype(float)) * (1 + SLACK)
        inside &= np.isfinite(bound)
        alive, choice, bound = alive[inside], choice[inside], bound[inside]
        for at in np.unique(choice).tolist():
            mine = choice == at
            rows, node = alive[mine], nodes[at]
            open_at[rows, at] = np.inf
            for point in node.members:
                offer(rows, point)
            if node.children:
                far = np.sqrt(offer(rows, node.vantage).astype(float))
                for child, (low, high) in zip(node.children, node.shells):
                    least = np.maximum(far - high, low - far) - (far + high) * SLACK
                    open_at[rows, child] = np.maximum(np.maximum(least, 0.0), bound[mine])
    return number, best


def scaled(column: pa.Array, dimensions: int) -> np.ndarray:
    """Whole-number components of a list column of which every row has ``dimensions``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(flat * SCALE), -REACH, REACH).astype(np.int64).reshape(-1, dimensions)


def usable(vectors: DataFrame, vector_col: str, dimensions: int) -> DataFrame:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    as_double = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    return vectors.where((F.size(vector_col) == dimensions) & ~F.exists(as_double, bad))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def _seeds(kept: DataFrame, id_col: str, vector_col: str, clusters: int, seed: int, dimensions: int) -> np.ndarray:
    """The first centroids: the vectors with the smallest digests of ``seed:id``; rows of one id by vector."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    chosen = kept.select(F.sha2(text, 256).alias("digest"), F.col(vector_col).alias("v")).orderBy("digest", "v").limit(clusters).collect()
    column = pa.array([r["v"] for r in chosen], pa.list_(pa.float64()))
    return scaled(column, dimensions)


@dataclass(frozen=True)
class Tally:
    """A cluster's number of vectors, sum of their distances, and sums of their components."""

    n: int
    inertia: int
    total: list[int]


def _tally(kept: DataFrame, vector_col: str, points: np.ndarray, dimensions: int) -> dict[int, Tally]:
    """The tallies of all clusters that aren't empty."""
    shared = kept.sparkSession.sparkContext.broadcast((points, build_tree(points)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, nodes = shared.value
        count = np.zeros(len(points), np.int64)
        # Python integers: sums of a whole task may pass 64 bits.
        total = np.zeros((len(points), dimensions), object)
        inertia = np.zeros(len(points), object)
        for block in _slices(batches):
            vectors = scaled(block.column(0), dimensions)
            number, distance = nearest(vectors, points, nodes)
            for c in np.unique(number).tolist():
                mine = number == c
                count[c] += int(mine.sum())
                total[c] += vectors[mine].sum(axis=0).astype(object)
                inertia[c] += sum(distance[mine].tolist())
        used = np.flatnonzero(count)
        number = pa.decimal128(38, 0)
        yield pa.record_batch({
            "cluster": pa.array(used, pa.int32()), "n": pa.array(count[used], pa.int64()),
            "total": pa.array([[Decimal(int(x)) for x in total[c]] for c in used], pa.list_(number)),
            "inertia": pa.array([Decimal(int(inertia[c])) for c in used], number),
        })

    parts = kept.select(vector_col).mapInArrow(run, "cluster int, n bigint, total array<decimal(38,0)>, inertia decimal(38,0)")
    flat = parts.select("cluster", "n", "inertia", F.posexplode("total").alias("place", "x"))
    rows = flat.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("inertia").alias("inertia"), F.sum("x").alias("x")).collect()
    shared.unpersist()
    found: dict[int, Tally] = {}
    for r in rows:
        found.setdefault(r["cluster"], Tally(r["n"], int(r["inertia"]), [0] * dimensions)).total[r["place"]] = int(r["x"])
    return found


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The centroids, one row each. An empty cluster's centroid stays where it is."""
    kept = usable(vectors, vector_col, dimensions)
    points = _seeds(kept, id_col, vector_col, clusters, seed, dimensions)
    for _ in range(rounds if len(points) else 0):
        moved = points.copy()
        for number, tally in _tally(kept, vector_col, points, dimensions).items():
            moved[number] = [x // tally.n for x in tally.total]
        if (moved == points).all():
            break
        points = moved
    return points


def assign(vectors: DataFrame, points: np.ndarray, vector_col: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """The usable rows of ``vectors`` with all columns, and

    cluster, distance         the nearest centroid's number, and the squared distance
    cluster_inertia, inertia  distances summed over the cluster, and over all; cut at the largest long
    centroid                  the centroid's components

    Columns so named are replaced.
    """
    made = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    source = usable(vectors, vector_col, dimensions).drop("cluster", "distance", "cluster_inertia", "inertia", "centroid")
    kept = source.columns
    largest = np.iinfo(np.int64).max
    inertia = np.zeros(len(points), object)
    if len(points):
        for number, tally in _tally(source, vector_col, points, dimensions).items():
            inertia[number] = tally.inertia
    known = (points, build_tree(points) if len(points) else [], [min(x, largest) for x in inertia.tolist()], min(sum(inertia.tolist()), largest))
    shared = vectors.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, nodes, of_cluster, of_all = shared.value
        of_cluster, centroid = pa.array(of_cluster, pa.int64()), pa.array(points.tolist(), pa.list_(pa.int64()))
        for block in _slices(batches):
            if not block.num_rows:
                continue
            number, distance = nearest(scaled(block.column(vector_col), dimensions), points, nodes)
            spot = pa.array(number, pa.int32())
            yield pa.record_batch({c: block.column(c) for c in kept} | {
                "cluster": spot, "distance": pa.array(distance, pa.int64()),
                "cluster_inertia": of_cluster.take(spot), "inertia": pa.array([of_all] * block.num_rows, pa.int64()),
                "centroid": centroid.take(spot),
            })

    return source.mapInArrow(run, ", ".join([f"`{n}` {t}" for n, t in source.dtypes] + [made]))


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """``fit``, then ``assign``."""
    points = fit(vectors, id_col, vector_col, **options)
    return assign(vectors, points, vector_col, options.get("dimensions", DIMENSIONS))
