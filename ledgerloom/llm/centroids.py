"""Centroid clustering of integer vectors with the equal-average equal-variance search.

Centroids lie sorted by their component sum. From the place of a vector's own sum, the search goes
outward, the nearer sum first. For n components, with sums s and t and with centred norms v and w,

    distance >= (s - t)^2 / n + (v - w)^2

so a side whose first term alone passes the best distance so far ends, and a centroid whose two terms
pass it is left out. All others are measured in 64-bit integers, so the result is that of comparing
every vector with every centroid, ties included: the smaller number wins.

The vectors are quantised once and saved; each round is one pass over them that brings sums per
cluster and component to the driver, so what the driver holds depends on centroids and components
alone. A third of all vectors may be equal, or fall into one cluster: no step groups vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

#: Components beyond this leave no room for an exact distance in 64 bits.
LARGEST = 1 << 27
ROWS = 8192


@dataclass(frozen=True)
class Clustering:
    clusters: int = 8
    rounds: int = 10
    components: int = 64
    scale: int = 1024
    #: Centroids start as the vectors with the smallest SHA-256 of this, a colon and the vec_id.
    seed: int = 3


class Search:
    """Nearest centroids by mean and deviation. ``measured`` counts the exact distances taken."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order].astype(np.float64)
        self.centroids = centroids[self.order]
        self.norms = centred_norms(self.centroids)
        self.measured = 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of and the squared distance to the nearest centroid of each vector."""
        n, k, width = len(vectors), len(self.order), vectors.shape[1]
        sums, norms = vectors.sum(axis=1).astype(np.float64), centred_norms(vectors)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best, found = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        edge = np.concatenate(([-np.inf], self.sums, [np.inf]))
        rows = np.arange(n)
        while len(rows):
            down, up = sums[rows] - edge[left[rows] + 1], edge[right[rows] + 1] - sums[rows]
            upward = up < down
            spot = np.where(upward, right[rows], left[rows])
            # Both gaps grow outward, so once the nearer one is too large the search is over.
            mean = np.minimum(up, down) ** 2 / width
            going = mean <= best[rows] * (1 + 1e-9)
            rows, spot, upward, mean = rows[going], spot[going], upward[going], mean[going]
            right[rows[upward]] += 1
            left[rows[~upward]] -= 1
            # A little is taken off, so that rounding never leaves out a nearest centroid.
            apart = np.abs(norms[rows] - self.norms[spot]) - 1e-9 * (norms[rows] + self.norms[spot])
            near = mean + np.maximum(apart, 0) ** 2 <= best[rows] * (1 + 1e-9)
            tried, spots = rows[near], spot[near]
            self.measured += len(tried)
            gap = vectors[tried] - self.centroids[spots]
            distance, number = np.einsum("ij,ij->i", gap, gap), self.order[spots]
            wins = (distance < best[tried]) | ((distance == best[tried]) & (number < found[tried]))
            best[tried[wins]], found[tried[wins]] = distance[wins], number[wins]
            rows = rows[(left[rows] >= 0) | (right[rows] < k)]
        return found, best


def centred_norms(vectors: np.ndarray) -> np.ndarray:
    centred = vectors - vectors.mean(axis=1, keepdims=True)
    return np.sqrt(np.einsum("ij,ij->i", centred, centred))


def quantise(vectors: DataFrame, config: Clustering) -> DataFrame:
    """vec_id and packed (64-bit integers) of the usable vectors."""
    width, scale = config.components, config.scale

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            right = pc.fill_null(pc.equal(pc.list_value_length(part["embedding"]), width), False)
            part = part.filter(right)
            values = part["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            whole = np.floor(values * scale)
            good = (np.isfinite(whole) & (np.abs(whole) <= LARGEST)).all(axis=1)
            rows = np.ascontiguousarray(whole[good].astype("<i8"))
            packed = pa.Array.from_buffers(pa.binary(8 * width), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([part["vec_id"].filter(pa.array(good)), packed], ["vec_id", "packed"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(pack, "vec_id long, packed binary")


def unpack(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of a batch, a bounded number at a time, with the place of the first."""
    for start in range(0, len(column), ROWS):
        part = column.slice(start, ROWS)
        yield start, np.frombuffer(b"".join(part.to_pylist()), "<i8").reshape(-1, width)


def first_centroids(packed: DataFrame, config: Clustering) -> np.ndarray:
    name = F.sha2(F.concat(F.lit(f"{config.seed}:"), F.col("vec_id").cast("string")), 256)
    first = packed.filter("vec_id IS NOT NULL").orderBy(name, "packed").limit(config.clusters).select("packed").collect()
    return np.array([np.frombuffer(r["packed"], "<i8") for r in first], np.int64).reshape(-1, config.components)


def moved(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of their vectors, or as they were."""
    k, width = centroids.shape

    def total(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, sums = Search(centroids), np.zeros((k, width + 1), np.int64)
        for part in parts:
            for _, vectors in unpack(part["packed"], width):
                found, _ = search.nearest(vectors)
                for c in range(k):
                    mine = vectors[found == c]
                    sums[c, :width] += mine.sum(axis=0)
                    sums[c, width] += len(mine)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(sums.tolist(), pa.list_(pa.int64()))], ["cluster", "sums"])

    sums = packed.select("packed").mapInArrow(total, "cluster int, sums array<long>").select("cluster", F.posexplode("sums"))
    cells = sums.groupBy("cluster", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("n")).collect()
    whole: dict[int, dict[int, int]] = {c: {} for c in range(k)}
    for cell in cells:
        whole[cell["cluster"]][cell["pos"]] = int(cell["n"])
    return np.array([[row[j] // row[width] for j in range(width)] if row.get(width) else old.tolist()
                     for row, old in ((whole[c], centroids[c]) for c in range(k))], np.int64)


def cluster_vectors(vectors: DataFrame, config: Clustering = Clustering()) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector.

    Defined results: a vector that is null, has another number of components, or a component that is
    null, not finite or beyond ``LARGEST`` after scaling is left out; a vector without a vec_id is
    assigned but no centroid starts from it; repeated rows count and are returned each; centroids that
    start equal stay in order, the later ones empty; with fewer vectors than clusters there are fewer
    centroids, with none no rows; other columns are not returned; a sum of distances beyond 64 bits is
    null. Once a round moves nothing, later rounds would not either, and are left out.
    """
    packed = cut_lineage(quantise(vectors, config), "vectors")
    centroids = first_centroids(packed, config)
    if not len(centroids):
        return packed.limit(0).selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    for _ in range(config.rounds):
        before, centroids = centroids, moved(packed, centroids)
        if np.array_equal(before, centroids):
            break
    width = config.components

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for part in parts:
            for start, vectors in unpack(part["packed"], width):
                found, distance = search.nearest(vectors)
                yield pa.RecordBatch.from_arrays([part["vec_id"].slice(start, len(vectors)), pa.array(found, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    assigned = cut_lineage(packed.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: int(r["n"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    rows = [(c, fits(n), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, n in sums.items()]
    report = packed.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(report), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(config: Clustering = Clustering()) -> str:
    """The same by comparing every vector with every centroid, one pair of steps a round."""
    width = config.components
    kept = f"""vectors AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({config.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
      FROM embeddings
      WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}),
    cells AS MATERIALIZED (SELECT rid, vec_id, unnest(range({width})) AS i, unnest(q) AS x FROM vectors),
    c0 AS MATERIALIZED (
      SELECT n AS c, unnest(range({width})) AS i, unnest(q) AS x
      FROM (SELECT q, row_number() OVER (ORDER BY sha256('{config.seed}:' || vec_id), q) - 1 AS n FROM vectors WHERE vec_id IS NOT NULL)
      WHERE n < {config.clusters})"""
    steps = []
    for r in range(config.rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
      SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d
      FROM (SELECT v.rid, k.c, CAST(sum((v.x - k.x) * (v.x - k.x)) AS BIGINT) AS d FROM cells v JOIN c{r} k USING (i) GROUP BY v.rid, k.c) GROUP BY rid)""")
        if r < config.rounds:
            steps.append(f"""m{r} AS MATERIALIZED (
      SELECT a.c, v.i, CAST(sum(v.x) AS BIGINT) AS s, count(*) AS n FROM cells v JOIN a{r} a USING (rid) GROUP BY a.c, v.i),
    c{r + 1} AS MATERIALIZED (
      SELECT k.c, k.i, CASE WHEN m.n IS NULL THEN k.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
      FROM c{r} k LEFT JOIN m{r} m ON m.c = k.c AND m.i = k.i)""")
    last = config.rounds
    return f"""WITH {kept}, {', '.join(steps)},
    shas AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{last} GROUP BY c)
    SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
      CAST(sum(a.d) OVER () AS BIGINT) AS inertia, s.h AS centroid_sha256
    FROM a{last} a JOIN vectors v USING (rid) JOIN shas s ON s.c = a.c"""
