"""The scan of op6: what leaves it does not grow with the number of groups, and its bounds hold on
any values."""

import numpy as np
import pytest

from staffmart.llm import bytewise, topk
from test_topk import brute

DDL = "vec_id long, embedding array<double>"


def values(kind, n, dim, rnd):
    x = rnd.normal(size=(n, dim))
    return np.floor({
        "unit": lambda: 256 * x / np.linalg.norm(x, axis=1)[:, None],
        "wide": lambda: 1e5 * x,
        "far tails": lambda: 50 * rnd.standard_cauchy(size=(n, dim)) ** 3,
        "mixed scales": lambda: x * 8.0 ** np.arange(-3, dim - 3),
        "few values": lambda: rnd.integers(-1, 2, (n, dim)) * 1.0,
        "beyond doubles": lambda: x * 1e200,
    }[kind]()) + 0.0


@pytest.fixture
def tables(monkeypatch):
    """Rows of every table that op6 has written, by name."""
    written, write = {}, topk.materialize

    def seen(df, name):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(topk, "materialize", seen)
    return written


def test_survivors_do_not_grow_with_groups(spark, tables):
    rnd = np.random.default_rng(2)
    vectors = rnd.normal(size=(4000, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], DDL).repartition(4)
    found = topk.top_k(df, group_rows=20)
    assert len(found.collect()) == 80 * 5
    groups = tables["topk-cells"].count()
    assert groups > 150
    assert tables["topk-bounds"].count() < 0.4 * 80 * 5 * groups        # k of each group before


def test_equal_vectors_meet_whatever_the_number_of_groups(spark, tables):
    rnd = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rnd.normal(size=(300, 4)))] + [(1000 + i, [3.0, 3.0, 3.0, 3.0]) for i in range(600)]
    df = spark.createDataFrame(rows, DDL).repartition(4)
    assert sorted(map(tuple, topk.top_k(df, group_rows=30).collect())) == brute(rows)
    kept = np.concatenate([np.frombuffer(bytes(r["ids"]), "<i8") for r in tables["topk-cells"].collect()])
    assert sorted(kept[kept >= 1000].tolist()) == list(range(1000, 1006))


def test_groups_scanned_first(spark, tables, monkeypatch):
    monkeypatch.setattr(topk, "FIRST_PAIRS", 0)
    monkeypatch.setattr(topk, "FIRST_GROUPS", 3)
    rnd = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rnd.normal(size=(700, 5)))] + [(750, [1.0, 2.0]), (800, [2.0, 1.0]), (800, [2.0, 1.5])]
    df = spark.createDataFrame(rows, DDL).repartition(3)
    assert sorted(map(tuple, topk.top_k(df, group_rows=40, query_rows=6).collect())) == brute(rows)
    assert tables["topk-first"].count() and tables["topk-bounds"].count()


def test_tasks_are_dealt_evenly(spark):
    for n in (1, 7, 145):
        numbers = spark.createDataFrame([(x,) for x in topk.dealt_evenly(spark, n)], "t long")
        found = numbers.repartition(n, "t").withColumn("at", topk.F.spark_partition_id()).collect()
        assert sorted(r["at"] for r in found) == list(range(n))


@pytest.mark.parametrize("kind", ["unit", "wide", "far tails", "mixed scales", "few values", "beyond doubles"])
@pytest.mark.parametrize("plain", [False, True])
def test_no_best_vector_is_lost(kind, plain, monkeypatch):
    if plain:
        monkeypatch.setattr(topk, "bytewise", bytewise.in_singles)
    monkeypatch.setattr(topk, "ROWS", 7)
    monkeypatch.setattr(topk, "COLUMNS", 60)
    monkeypatch.setattr(topk, "HELD", 500)
    rnd, k = np.random.default_rng(4), 5
    vectors = values(kind, 900, 12, rnd)
    ids, queries = np.arange(900) // 2 * 2, vectors[:40]      # ids repeat
    exact = np.array([[int(x) for x in v] for v in queries], object) @ np.array([[int(x) for x in v] for v in vectors], object).T
    exact = np.clip(exact, -2**63 + 1, 2**63 - 1)
    block = topk.Block(queries, ids[:40], k)
    for at in range(0, 900, 100):
        block.meet(np.arange(at, at + 100), ids[at:at + 100], *topk.cells(vectors[at:at + 100], topk.CELLS))
    q, place, upper, lower = block.left()
    scores = exact[q, place].astype(float)
    assert (lower <= scores).all() and (scores <= upper).all()
    assert len({*zip(q.tolist(), place.tolist())}) == len(q)
    for i in range(40):
        others = np.flatnonzero(ids != ids[i])
        least = sorted(exact[i, others])[-k]
        assert set(others[exact[i, others] >= least].tolist()) <= set(place[q == i].tolist())
    if kind in ("unit", "wide"):
        assert len(q) < 40 * 12


@pytest.mark.parametrize("dims", [1, 64, 1024, 2500])
def test_products_of_bytes_are_exact(dims):
    rnd = np.random.default_rng(dims)
    for low, high in ((-128, 128), (-128, -127), (127, 128)):
        a, b = (rnd.integers(low, high, (n, dims)).astype(np.int8) for n in (9, 31))
        want = a.astype(np.int64) @ b.astype(np.int64).T
        assert (bytewise.bytewise(b)(a) == want).all() and (bytewise.in_singles(b)(a) == want).all()


def test_every_cell_holds_its_components():
    rnd = np.random.default_rng(6)
    for kind in ("unit", "wide", "far tails", "mixed scales", "beyond doubles"):
        vectors = values(kind, 500, 8, rnd)
        number, borders = topk.cells(vectors, topk.CELLS)
        low, high = (x[np.arange(8), number] for x in topk.edges(borders))
        assert (low <= vectors).all() and (vectors <= high).all(), kind
