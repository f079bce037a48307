import math
import re

import pytest

from staffmart.llm import mixing
from tests.llm.plain import DDL, frame, odd_documents


def water(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Shares by weight, the excess over the caps shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = {s: 0.0 for s in names}, set(names), share * sum(sizes.values())
    while open_ and rest > 1e-9:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if target[s] + rest * w[s] / total >= cap * sizes[s]}
        if not full:
            for s in open_:
                target[s] += rest * w[s] / total
            return target
        given = {s: target[s] + rest * w[s] / total for s in open_}
        rest = sum(given[s] - cap * sizes[s] for s in full)
        target |= given | {s: float(cap * sizes[s]) for s in full}
        open_ -= full
    return target


def test_targets_and_copies(spark):
    docs = odd_documents(6)
    rows = mixing.digest(mixing.mix(frame(spark, docs))).collect()
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in docs}
    sizes = {}
    for r in docs:
        sizes[r[3]] = sizes.get(r[3], 0) + size[r[0]]
    target = water(sizes)
    source = {r[0]: r[3] for r in docs}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]]
        assert math.isclose(r.target, target[source[r.doc_id]], rel_tol=1e-9)
        rate = r.target / r.source_size
        assert r.taken in (r["size"] * math.floor(rate), r["size"] * (math.floor(rate) + 1)) and r.taken <= 2 * r["size"]
    again = mixing.digest(mixing.mix(frame(spark, docs))).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


@pytest.mark.parametrize("sizes", [{"a": 5}, {"a": 10, "b": 1000, "c": 10}, {"a": 1, "b": 1, "c": 1, None: 100}, {"b": 7, "a": 0}])
def test_water_level(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(water(sizes))


def test_emitted_rows_match_copies(spark):
    docs = odd_documents(6)
    df = frame(spark, docs)
    mixed = mixing.mix(df)
    out = mixing.emit(mixed)
    assert out.columns == df.columns
    assert out.count() == mixed.groupBy().sum("copies").first()[0]


def test_large_source_comes_near_its_target(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "big" if i % 3 else "small", 1) for i in range(6000)]
    got = mixing.digest(mixing.mix(spark.createDataFrame(rows, DDL))).groupBy("source_size").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.05 for r in got)


def test_empty(spark):
    assert mixing.digest(mixing.mix(frame(spark, []))).collect() == []
    assert mixing.emit(mixing.mix(frame(spark, []))).collect() == []


def test_sql_and_no_python(spark):
    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    df = mixing.digest(mixing.mix(spark.read.parquet(f"{d}/documents.parquet")))
    assert sorted(map(tuple, df.collect())) == sorted(con.execute(mixing.MIX_SQL).fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan


def test_documents_are_not_shuffled_by_source(spark):
    import contextlib
    import io

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        mixing.mix(docs).explain("simple")
    plan = buf.getvalue()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan and "Arrow" not in plan
