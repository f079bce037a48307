import math

import pytest

from staffmart.llm import topk

import numpy as np

from staffmart.llm.vectors import LAST, products

DDL = "vec_id long, embedding array<float>, label int, score string, dim string, g string, vec string"


def brute(rows, every=50, k=5):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in ok:
        if q % every == 0:
            scored = sorted((-max(-LAST, min(LAST, sum(x * y for x, y in zip(a, b)))), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return sorted(out)


def rows_of(seed, n=230, dim=6, scale=1.0):
    import numpy as np

    rnd = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rnd.normal(size=dim).astype("float32") * scale]) for i in range(n)]
    rows += [(300 + i, rows[50][1]) for i in range(8)]                       # ties
    rows += [(350, None), (400, []), (450, [1.0, None] * 3), (500, [float("nan")] * dim), (550, [float("inf")] * dim), (None, rows[0][1]), (600, [1.0, 2.0]), (650, [2.0, 1.0]), (700, [0.0] * dim)]
    return rows


@pytest.mark.parametrize("options", [{}, {"group_rows": 40, "query_rows": 2}])
@pytest.mark.parametrize("scale", [0.3, 5000.0])
def test_against_all_pairs(spark, options, scale):
    rows = rows_of(1, scale=scale)
    df = spark.createDataFrame([(i, v, 1, "x", "y", "z", "w") for i, v in rows], DDL).repartition(3)
    assert sorted(map(tuple, topk.top_k(df, **options).collect())) == brute([(i, None if v is None else v) for i, v in rows])


def test_large_components_are_exact(spark):
    rows = [(0, [1e6, 3.0]), (1, [2e6, 1.0]), (2, [2e6, 1.0]), (3, [-1e6, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df).orderBy("rank").collect()] == [(0, 1, 1, 65536), (0, 2, 1, 65536)]
    assert topk.top_k(df.where("false")).collect() == []


def test_finite_vectors_of_any_size_take_part(spark):
    rows = [(0, [2.0**54, 3.0]), (1, [1.0, 1.0]), (2, [1.0, 1.5]), (3, [-1.0, 1.0]), (4, [2.0**55, -5.0]), (50, [0.5, 0.25]), (100, [1e-3, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute(rows)


def test_bounds_hold_and_few_vectors_are_read():
    rnd = np.random.default_rng(5)
    vectors = np.floor(rnd.normal(size=(3000, 32)) * 200)
    vectors[7] *= 1e6                                                     # one far out
    queries, ids = vectors[:40], np.arange(3000)
    number, borders = topk.cells(vectors, topk.CELLS)
    exact = queries @ vectors.T
    upper, lower = topk.bounds(queries, number, borders, True), topk.bounds(queries, number, borders, False)
    assert (lower <= exact).all() and (exact <= upper).all()
    read = kept = 0
    for i, at, up, low in topk.survivors(queries, ids[:40], ids, number, borders, 5):
        want = sorted((-exact[i, j], j) for j in range(3000) if j != i)[:5]
        assert {j for _, j in want} <= set(at.tolist())
        order = np.argsort(-up)
        reader = topk.Reader(queries[i:i + 1], 5)
        for some in np.array_split(order, 3):
            reader.take(at[some], [vectors[j].astype("<f8").tobytes() for j in at[some]], up[some])
        assert [(-s, j) for s, j in zip(reader.scores, reader.ids)] == want
        read, kept = read + reader.read, kept + len(at)
    assert read <= kept < 0.1 * 40 * 3000


def test_products_beyond_doubles_are_exact():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**22, 5.0], [-2.0**60, 1.0]])
    assert products(a, b).tolist() == [[2**62 + 15, -(2**63 - 1)]]


def test_a_vector_that_a_third_of_the_rows_have(spark):
    rows = rows_of(9, n=300) + [(1000 + i, [3.0, 3.0, 3.0, 3.0, 3.0, 3.0]) for i in range(160)] + [(1000, [3.0] * 6)] * 9
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, group_rows=100).collect())) == brute(rows)
