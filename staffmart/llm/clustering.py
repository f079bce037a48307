"""Centroid clustering with geometric drift tightening.

Lloyd's rounds over integer vectors, floor(scale * x). Every vector carries its cluster, an upper
bound of its distance to the own centroid and a lower bound of its distance to any other. When
centroids move, the upper bound grows by the own centroid's drift. The lower bound would shrink by
the largest drift of all; geometry allows less. All members of a cluster lie in a sphere about its
old centroid. How much nearer any point of that sphere can lie to another centroid's new place
than to its old one is a question in the plane through sphere centre and drift: the gain of a
point is the drift times the mean, along the way, of the cosine between the drift and the ray to
the point. Over the sphere that cosine is largest on the tangent ray closest to the drift, and it
falls as the ray's origin moves on, so the mean over the way's pieces, each taken at its start, is
an upper bound (:func:`most_gained`): full drift only if the sphere reaches the drift's own line
ahead, negative if the centroid leaves. Vectors whose bounds still separate keep their cluster
unread; for the others the own distance is worked out, and those still ambiguous are scanned
against every centroid exactly.

A round is one pass: tasks read the last state, write the next one, and add rows with their exact
integer sums per cluster (in limbs of 40 bits). Only these sums, spheres' radii and centroids (k
times dimensions) reach the driver; vectors are never shuffled. The state is a written table in the
shared folder, and the one before it is deleted when the next one stands.

Distances and decisions are exact for components of any size. In doubles they are exact while
4 * dim * largest**2 < 2**53; beyond, doubles with a known relative error choose the candidates
and Python integers decide between them.

Defined cases: vectors that are null, hold null or non-finite components (also after scaling) or
have another length take no part; a null id takes part and sorts last among the first centroids;
repeated rows take part each; fewer vectors than k give fewer centroids; ties go to the smaller
number; empty clusters keep their centroid; distances and sums beyond a long are held at its
largest value; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffmart.llm.common import discard, shared_path, ship_code, text_buffer
from staffmart.llm.vectors import as_long, integers, scaled, to_binary

K, ROUNDS, SCALE, DIM, SEED = 40, 5, 256, 64, "2:"
STEPS = 16                        # pieces of a drift's way
ROWS = 4096                       # vectors worked on at once
LIMB = 40                         # bits of a limb of the sums
COUNT, RADIUS = -1, -2            # in place of a dimension: a cluster's number of vectors, its sphere's radius
_SLACK = 1e-9                     # relative; rounding of bounds stays far below
STATE_SCHEMA = pa.schema([("vec_id", pa.int64()), ("vec", pa.binary()), ("cluster", pa.int32()), ("upper", pa.float64()), ("lower", pa.float64()),
                          ("dim", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])
STATE_DDL = "vec_id long, vec binary, cluster int, upper double, lower double, dim int, limb int, value long"


class Centroids:
    """Integer points, as Python integers and as sums of two doubles each."""

    def __init__(self, points: list[list[int]]):
        self.points = points
        self.high = np.array([[float(x) for x in p] for p in points])
        self.low = np.array([[float(x - int(float(x))) for x in p] for p in points])
        self.largest = float(np.abs(self.high).max())

    def exact_for(self, vectors: np.ndarray) -> bool:
        """Whether squared distances in doubles have no rounding at all."""
        top = max(self.largest, float(np.abs(vectors).max(initial=0.0)))
        return 4 * vectors.shape[1] * top * top < 2.0**53

    def squared(self, vectors: np.ndarray, j: int | np.ndarray) -> np.ndarray:
        """Squared distances to centroid ``j`` (one, or one for each row), relative error below 1e-12."""
        with np.errstate(over="ignore"):
            diff = (vectors - self.high[j]) - self.low[j]
            return np.einsum("ij,ij->i", diff, diff)

    def integer_distance(self, vector: np.ndarray, j: int) -> int:
        return sum((int(x) - c) ** 2 for x, c in zip(vector, self.points[j]))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cluster, upper bound of its distance and lower bound of the distance to all others."""
        exact, n = self.exact_for(vectors), np.arange(len(vectors))
        if exact:
            d = np.einsum("ij,ij->i", vectors, vectors)[:, None] - 2 * (vectors @ self.high.T) + np.einsum("ij,ij->i", self.high, self.high)
        else:
            d = np.stack([self.squared(vectors, j) for j in range(len(self.points))], axis=1)
        best = d.argmin(axis=1)
        if not exact:
            close = d <= d[n, best][:, None] * (1 + 1e-11)
            for i in np.flatnonzero(close.sum(axis=1) > 1):
                best[i] = min(np.flatnonzero(close[i]), key=lambda j: (self.integer_distance(vectors[i], j), j))
        upper = np.sqrt(d[n, best]) * (1 + _SLACK)
        d[n, best] = np.inf
        return best.astype(np.int32), upper, np.sqrt(d.min(axis=1)) * (1 - _SLACK)

    def distances(self, vectors: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        """Exact squared distances to each vector's own centroid, held at a long's end."""
        if self.exact_for(vectors):
            return self.squared(vectors, cluster).astype(np.int64)
        return np.array([as_long(self.integer_distance(v, j)) for v, j in zip(vectors, cluster)], np.int64)

    def digest(self, j: int) -> str:
        return hashlib.sha256(",".join(map(str, self.points[j])).encode()).hexdigest()


def most_gained(centre: np.ndarray, radius: np.ndarray, old: np.ndarray, way: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """For each sphere a and centroid j, an upper bound of ``|x - old_j| - |x - old_j - way_j|``
    over all x in the sphere about ``centre[a]``."""
    drift = np.sqrt(np.einsum("jd,jd->j", way, way))
    unit = way / np.where(drift > 0, drift, 1)[:, None]
    to = centre[:, None, :] - old[None, :, :]
    along = np.einsum("ajd,jd->aj", to, unit)
    off = np.sqrt(np.maximum(0, ((to - along[:, :, None] * unit[None]) ** 2).sum(axis=2)))
    # rounding of a sphere's place counts as radius
    radius = radius[:, None] * (1 + _SLACK) + _SLACK * (np.sqrt((to ** 2).sum(axis=2)) + drift[None])
    ahead = along[:, :, None] - drift[None, :, None] * (np.arange(steps) / steps)
    far = np.hypot(ahead, off[:, :, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        tangent = np.arctan2(off[:, :, None], ahead) - np.arcsin(np.minimum(1, radius[:, :, None] / far))
    cosine = np.where(far <= radius[:, :, None], 1.0, np.cos(np.maximum(0, tangent)))
    return drift * (cosine.mean(axis=2) + _SLACK)


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    i = 0
    while abs(total) >> LIMB:
        yield i, total & ((1 << LIMB) - 1)
        total >>= LIMB
        i += 1
    yield i, total


class _Sums:
    """A task's exact sums per cluster."""

    def __init__(self, k: int, dim: int):
        self.total = np.zeros((k, dim), object)
        self.count, self.radius = np.zeros(k, np.int64), np.zeros(k)

    def add(self, vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray) -> None:
        k = len(self.count)
        if float(np.abs(vectors).max(initial=0.0)) * len(vectors) < 2.0**53:
            member = np.zeros((k, len(vectors)))
            member[cluster, np.arange(len(vectors))] = 1
            self.total += (member @ vectors).astype(np.int64).astype(object)
        else:
            np.add.at(self.total, cluster, integers(vectors))
        self.count += np.bincount(cluster, minlength=k)
        np.maximum.at(self.radius, cluster, upper)

    def batch(self) -> pa.RecordBatch:
        rows = []
        for j in np.flatnonzero(self.count).tolist():
            rows += [(j, COUNT, 0, int(self.count[j]), None), (j, RADIUS, 0, None, float(self.radius[j]))]
            rows += [(j, d, limb, value, None) for d, total in enumerate(self.total[j].tolist()) for limb, value in _limbs(total)]
        columns = list(zip(*rows)) if rows else [[]] * 5
        given = dict(zip(("cluster", "dim", "limb", "value", "upper"), columns))
        return pa.RecordBatch.from_arrays([pa.array(given.get(f.name, [None] * len(rows)), f.type) for f in STATE_SCHEMA], schema=STATE_SCHEMA)


def kept_vectors(rows: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """vec_id and vec (integer-valued doubles) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, lengths, flat = scaled(batch.column(1), scale)
            fit = lengths == dim
            flat = flat[np.repeat(fit, lengths)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[fit])), to_binary(flat, lengths[fit])], names=["vec_id", "vec"])

    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(run, "vec_id long, vec binary")


def _round(state: DataFrame, centroids: Centroids, drift: np.ndarray | None, loosen: np.ndarray | None, last: bool) -> DataFrame:
    """The next state: every vector with its cluster under ``centroids``, and the tasks' sums. In
    the last one, each vector's exact distance instead of sums."""
    k, dim = centroids.high.shape

    def assign(vectors: np.ndarray, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if drift is None:
            return centroids.nearest(vectors)
        cluster, upper, lower = (batch.column(i).to_numpy(zero_copy_only=False).copy() for i in (2, 3, 4))
        upper += drift[cluster]
        lower -= loosen[cluster]
        for scan in (False, True):
            open_ = np.flatnonzero(~(upper < lower))
            if not len(open_):
                break
            if scan:
                cluster[open_], upper[open_], lower[open_] = centroids.nearest(vectors[open_])
            else:
                upper[open_] = np.sqrt(centroids.squared(vectors[open_], cluster[open_])) * (1 + _SLACK)
        return cluster, upper, lower

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(k, dim)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                vectors = text_buffer(batch.column(1))[0].view("<f8").reshape(-1, dim)
                cluster, upper, lower = assign(vectors, batch)
                value = pa.array(centroids.distances(vectors, cluster)) if last else pa.nulls(len(cluster), pa.int64())
                if not last:
                    sums.add(vectors, cluster, upper)
                none = pa.nulls(len(cluster), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower), none, none, value],
                                                 schema=STATE_SCHEMA)
        if not last:
            yield sums.batch()

    vectors = state.where("dim is null").select("vec_id", "vec", "cluster", "upper", "lower") if drift is not None else state.select("vec_id", "vec")
    return vectors.mapInArrow(run, STATE_DDL)


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors of smallest SHA-256 of ``seed`` and their id."""
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    return [[int(x) for x in np.frombuffer(r["vec"], "<f8")] for r in vectors.orderBy(order.asc_nulls_last(), "vec").limit(k).collect()]


def _moved(state: DataFrame, centroids: Centroids) -> tuple[Centroids, np.ndarray]:
    """Centroids after a round and the radius of each cluster's sphere, from the tasks' sums (k x dim rows)."""
    k, dim = centroids.high.shape
    total, count, radius = [[0] * dim for _ in range(k)], [0] * k, np.zeros(k)
    parts = state.where("dim is not null").groupBy("cluster", "dim", "limb").agg(F.sum("value").alias("value"), F.max("upper").alias("upper"))
    for r in parts.collect():
        if r["dim"] == COUNT:
            count[r["cluster"]] = r["value"]
        elif r["dim"] == RADIUS:
            radius[r["cluster"]] = r["upper"]
        else:
            total[r["cluster"]][r["dim"]] += r["value"] << (LIMB * r["limb"])
    return Centroids([[t // count[j] for t in total[j]] if count[j] else centroids.points[j] for j in range(k)]), radius


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
            seed: str = SEED) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector."""
    spark: SparkSession = rows.sparkSession
    ship_code(spark)
    state = kept_vectors(rows, id_col, vector_col, dim, scale)
    points = first_centroids(state, k, seed)
    if not points:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids, drift, loosen, before = Centroids(points), None, None, None
    for i in range(rounds + 1):
        path = shared_path(spark, "clusters")
        _round(state, centroids, drift, loosen, last=i == rounds).write.option("compression", "zstd").parquet(path)
        state = spark.read.schema(STATE_DDL).parquet(path)
        if before is not None:
            discard(spark, before)
        before = path
        if i < rounds:
            old, (centroids, radius) = centroids, _moved(state, centroids)
            way = (centroids.high - old.high) + (centroids.low - old.low)
            drift = np.sqrt((way ** 2).sum(axis=1)) * (1 + _SLACK)
            gained = most_gained(old.high, radius, old.high, way)
            np.fill_diagonal(gained, -np.inf)
            loosen = gained.max(axis=1)
    found = state.select("vec_id", "cluster", F.col("value").alias("distance"))
    inertia = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    whole = as_long(sum(inertia.values()))
    facts = spark.createDataFrame([(j, as_long(inertia.get(j, 0)), whole, centroids.digest(j)) for j in range(len(points))],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = SEED) -> str:
    """The same by plain rounds over (vector, dimension) rows."""
    assign = lambda c: (
        f"SELECT vec_id, cluster, distance FROM (SELECT v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance FROM v JOIN {c} c USING (i) GROUP BY ALL) "
        "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1")
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"v AS MATERIALIZED (SELECT vec_id, i, floor({scale} * embedding[i]::DOUBLE)::BIGINT AS x FROM kept, range(1, {dim} + 1) r(i))",
        f"c0 AS MATERIALIZED (SELECT cluster, i, x FROM (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}' || vec_id)) - 1 AS cluster FROM kept) JOIN v USING (vec_id) WHERE cluster < {k})"]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED ({assign(f'c{r}')})")
        if r < rounds:
            steps.append(f"s{r} AS (SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{r} JOIN v USING (vec_id) GROUP BY ALL)")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c.cluster, c.i, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{r} c LEFT JOIN s{r} USING (cluster, i))")
    return "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, a.cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{rounds} a JOIN (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster) USING (cluster)"""
