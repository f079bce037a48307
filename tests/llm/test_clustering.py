import hashlib
import math

import numpy as np
import pytest

from staffmart.llm import clustering

DDL = "vec_id long, embedding array<double>, cluster string, vec int, upper string, value string, dim string"


def plain(rows, k, rounds, dim):
    """Lloyd's rounds in Python integers."""
    kept = [(i, [int(math.floor(x * 256)) for x in v]) for i, v in rows if v and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), np.array(r[1], "<f8").tobytes()))[:k]
    cents = [v for _, v in first]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((dist(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(cents)):
            members = [v for (_, v), o in zip(kept, own) if o == j]
            if members:
                cents[j] = [sum(col) // len(members) for col in zip(*members)]
    last = [(i, *nearest(v)) for i, v in kept]
    held = lambda x: min(x, 2**63 - 1)
    sums = {j: sum(held(d) for _, d, o in last if o == j) for _, _, j in last}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, held(d), held(sums[j]), held(sum(sums.values())), digest[j]) for i, d, j in last), key=str)


def spread(seed, n=300, dim=5, scale=1.0):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, dim)) * 4
    return [(int(i), [float(x) * scale for x in centres[i % 6] + rnd.normal(size=dim)]) for i in range(n)]


@pytest.mark.parametrize("rows", [
    spread(1),
    spread(2, 80) + [(200 + i, [0.5] * 5) for i in range(30)],                               # copies and ties
    spread(3, 60) + [(70, None), (71, []), (72, [1.0] * 4), (73, [1.0, None, 1.0, 1.0, 1.0]), (74, [float("nan")] * 5), (75, [float("inf")] * 5), (None, [1.0] * 5), (5, [2.0] * 5)],
    spread(4, 60, scale=1e7) + [(100, [2.0**54] * 5), (101, [-2.0**54 - 4096.0] * 5), (102, [1e30, 0.0, 0.0, 0.0, 1.0])],   # beyond exact doubles
    spread(5, 3),                                                                            # fewer vectors than centroids
])
def test_against_plain_rounds(spark, rows):
    df = spark.createDataFrame([(i, v, "x", 1, "y", "z", "w") for i, v in rows], DDL).repartition(3)
    got = [tuple(r) for r in clustering.cluster(df, k=7, rounds=4, dim=5).collect()]
    assert sorted(got, key=str) == plain(rows, 7, 4, 5)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert clustering.cluster(df, dim=5).collect() == []
    assert clustering.cluster(df, dim=5).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_bound_holds_and_is_less_than_drift():
    rnd = np.random.default_rng(7)
    less = 0
    for dim in (2, 3, 20):
        for _ in range(200):
            centre, old = rnd.normal(size=(1, dim)) * 3, rnd.normal(size=(1, dim)) * 3
            way, radius = rnd.normal(size=(1, dim)) * rnd.choice([0.01, 1, 5]), np.array([abs(rnd.normal()) * rnd.choice([0, 0.3, 2])])
            bound = clustering.most_gained(centre, radius, old, way)[0, 0]
            to = rnd.normal(size=(400, dim))
            points = centre + to / np.linalg.norm(to, axis=1)[:, None] * radius * rnd.random((400, 1)) ** 0.2
            gain = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - old - way, axis=1)
            assert gain.max() <= bound + 1e-9
            assert bound <= np.linalg.norm(way) * (1 + 1e-6)
            less += bound < 0.9 * np.linalg.norm(way)
    assert less > 200


def test_settled_vectors_are_not_scanned(monkeypatch):
    """Separate clusters: after the first assignment bounds keep nearly all vectors unread."""
    import pyarrow as pa

    vectors = np.floor(np.array([v for _, v in spread(8, 600)]) * 256)
    scanned = []
    real = clustering.Centroids.nearest
    monkeypatch.setattr(clustering.Centroids, "nearest", lambda self, v: scanned.append(len(v)) or real(self, v))
    cents = clustering.Centroids([[int(x) for x in vectors[j:600:6].mean(axis=0)] for j in range(6)])
    cluster, upper, lower = cents.nearest(vectors)
    way = np.full((6, 5), 3.0)
    moved = clustering.Centroids([[x + 3 for x in p] for p in cents.points])
    radius = np.zeros(6)
    np.maximum.at(radius, cluster, upper)
    gained = clustering.most_gained(cents.high, radius, cents.high, way)
    np.fill_diagonal(gained, -np.inf)
    assert (gained.max(axis=1) <= np.linalg.norm(way[0]) * (1 + 1e-6)).all()

    class State:
        where = select = lambda self, *a: self

        def mapInArrow(self, run, ddl):
            batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), clustering.to_binary(vectors.ravel(), np.full(600, 5)), pa.array(cluster), pa.array(upper), pa.array(lower)],
                                               names=["vec_id", "vec", "cluster", "upper", "lower"])
            return list(run(iter([batch])))

    out = clustering._round(State(), moved, np.linalg.norm(way, axis=1), gained.max(axis=1), last=True)
    assert sum(scanned[1:]) < 120
    assert out[0].column(2).to_pylist() == [int(np.argmin([np.sum((v - h) ** 2) for h in moved.high])) for v in vectors]
