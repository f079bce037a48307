import math

import numpy as np
import pytest

from staffmart.llm import negatives

DDL = "vec_id long, embedding array<double>, label int, anchor string, score string, dim string, g string, mark string"


def brute(rows, every=50, n_pos=5, n_neg=3, low=50, high=95):
    hold = lambda x: max(-(2**63 - 1), min(2**63 - 1, x))
    ok = [(i, label, tuple(math.floor(256 * x) if abs(x) < 2**45 else int(x) * 256 for x in v)) for i, v, label in rows
          if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, la, va in dict.fromkeys(r for r in ok if r[0] % every == 0):
        met = [(hold(sum(x * y for x, y in zip(va, v))), i, lab) for i, lab, v in ok if i != a and len(v) == len(va)]
        met.sort(key=lambda x: (-x[0], x[1]))
        for ps, p, _ in [m for m in met if m[2] == la][:n_pos]:
            fit = [m for m in met if m[2] != la and low * ps <= 100 * m[0] <= high * ps][:n_neg]
            out += [(a, p, r + 1, n, ps, ns) for r, (ns, n, _) in enumerate(fit)]
    return sorted(out)


def rows_of(seed, n=260, dim=4, scale=1.0, labels=4):
    rnd = np.random.default_rng(seed)
    rows = [(int(i), [float(x) * scale for x in rnd.normal(size=dim)], int(rnd.integers(labels))) for i in range(n)]
    rows += [(300 + i, rows[50][1], int(i % 3)) for i in range(9)]                             # ties
    rows += [(350, None, 1), (400, [], 1), (450, [1.0, None] * 2, 1), (500, [float("nan")] * dim, 1), (550, [float("inf")] * dim, 2), (None, rows[0][1], 1),
             (600, [1.0, 2.0], 1), (601, [2.0, 1.0], 1), (602, [1.0, 1.9], 2), (650, [0.0] * dim, 1), (651, [0.0] * dim, 2), (700, rows[3][1], None)]
    return rows


@pytest.mark.parametrize("options", [{}, {"group_rows": 40, "anchor_rows": 2}])
@pytest.mark.parametrize("seed, scale", [(1, 0.3), (2, 3000.0), (3, 1e6)])
def test_against_all_pairs(spark, seed, scale, options):
    rows = rows_of(seed, scale=scale)
    rows += [rows[100], rows[7], rows[8]]                                                      # repeated rows
    df = spark.createDataFrame([(i, v, y, "a", "s", "d", "g", "m") for i, v, y in rows], DDL).repartition(4)
    got = sorted(map(tuple, negatives.mine_negatives(df, **options).collect()))
    assert got == brute(rows) and len(got) > 30


def test_large_components_are_exact(spark):
    rows = [(0, [2.0**54, 3.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 0.5], 2), (3, [0.6, 77.0], 2), (4, [-1.0, 1.0], 2), (50, [1.0, 0.0], 1), (100, [1e30, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, negatives.mine_negatives(df).collect())) == brute(rows)


def test_hot_label_and_one_label_only(spark):
    rows = rows_of(5, n=400, labels=1) + [(1000 + i, [0.1 * i, 0.2, 0.3, 0.4], 9) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, negatives.mine_negatives(df, group_rows=50).collect())) == brute(rows)
    alone = [(i, v, 1) for i, v, y in rows]
    df = spark.createDataFrame(alone, "vec_id long, embedding array<double>, label int")
    assert negatives.mine_negatives(df).collect() == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    out = negatives.mine_negatives(df)
    assert out.collect() == [] and out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_slots_are_disjoint_and_suffixes_answer_windows():
    rnd = np.random.default_rng(3)
    scores = rnd.integers(-50, 50, (6, 200)).astype(float)
    upper = np.sort(rnd.integers(-10, 45, (6, 4)).astype(float), axis=1)[:, ::-1]
    floor = np.full(6, -20.0)
    found = [(slot, r, c) for slot, row, col in negatives.top_slots(scores, np.ones_like(scores, bool), upper, floor, 3) for r, c in zip(row, col)]
    assert len({(r, c) for _, r, c in found}) == len(found)
    for r in range(6):
        for i in range(4):
            suffix = sorted((-scores[r, c], c) for slot, x, c in found if x == r and slot >= i)[:3]
            assert suffix == sorted((-s, c) for c, s in enumerate(scores[r]) if floor[r] <= s <= upper[r, i])[:3]
