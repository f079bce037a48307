"""The pipeline and the registered queries against plain versions, over given tables."""

import collections
import os
import subprocess
import sys

import pytest

from tests.llm.plain import join_components, repeats

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages(spark):
    import corpus_pipeline
    from staffmart.llm import toxicity
    from staffmart.llm.common import materialize

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "jaccard_join", "suffix_dedup", "mixing", "packing"]
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF), f"test-{name}")
        if name != "packing":
            assert after.columns == docs.columns
        out.append((docs.collect(), after.collect()))
        docs = after
    rows = lambda x: collections.Counter(map(tuple, x))
    before, after = out[0]
    scored = {r.doc_id: r.predicted for r in toxicity.score_documents(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect()}
    assert rows(after) == rows(r for r in before if not scored[r.doc_id])
    before, after = out[1]
    lead = {i for i, n, c in join_components([(r.doc_id, r.text) for r in before]) if i == c}
    assert rows(after) == rows(r for r in before if r.doc_id in lead)
    before, after = out[2]
    want = {i: (n - gone, gone) for i, n, gone, _, _ in repeats([(r.doc_id, r.text) for r in before])}
    text = {r.doc_id: r.text for r in before}
    assert {r.doc_id for r in after} == set(want)
    for r in after:
        kept, gone = want[r.doc_id]
        assert r.text == text[r.doc_id] if not gone else kept - 6 * want[r.doc_id][1] <= len(r.text.encode()) <= kept
        assert r.n_chars == len(r.text)
    before, after = out[3]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} and max(collections.Counter(r.doc_id for r in after).values()) <= 2
    _, pieces = out[4]
    assert {p.doc_id for p in pieces} == {r.doc_id for r in after}
    whole = corpus_pipeline.run(spark, SF).select("doc_id", "doc_tokens", "length").collect()
    assert sum(p.length for p in whole) == sum(p.length for p in pieces)


def test_registered(spark):
    import __spark_entry__ as e

    q = e.queries()
    assert "pipeline" in q and all(sum(k.startswith(f"op{n}_") for k in q) == 1 for n in range(1, 14))
    assert set(e.oracle_sql()) <= set(q)


@pytest.mark.parametrize("name", ["op2_warc", "op6_topk", "op7_mixing", "op11_clustering", "op12_chat", "op13_negatives"])
def test_oracles(spark, name):
    import duckdb

    import __spark_entry__ as e

    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = e.queries()[name](spark, SF)
    con.execute(e.oracle_sql()[name])
    columns = [c[0] for c in con.description]
    assert sorted(df.columns) == sorted(columns)
    assert collections.Counter(map(tuple, df.select(columns).collect())) == collections.Counter(con.fetchall())


def test_entry_without_the_operators(tmp_path):
    """The entry imports where the folders and the pipeline are gone, and hides no other error."""
    for name in os.listdir(ROOT):
        if name not in (".git", "corpus_pipeline.py", "staffmart", "tests"):
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "staffmart")
    for name in os.listdir(f"{ROOT}/staffmart"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/staffmart/{name}", tmp_path / "staffmart" / name)
    os.remove(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(open(f"{ROOT}/__spark_entry__.py").read())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'absence_pivot' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


def test_every_stage_takes_odd_rows(spark):
    """Nulls in any column, empty and repeated texts, repeated rows and ids, ties, further columns
    that bear the operators' own names; and no rows at all."""
    import corpus_pipeline
    from staffmart.llm.common import materialize
    from tests.llm.plain import frame, odd_documents

    rows = odd_documents(6)
    rows += [rows[0], rows[0], (None, None, None, None, None), (5000, None, None, None, None), (5001, "", None, "s1", 0), (5001, "", None, "s1", 0), (5002, "x" * 300_000, "en", "s2", 300_000)]
    df = frame(spark, rows)
    extra = ("_n", "_k", "component", "component_id", "unit", "salt", "_gone", "_odd", "copies", "length", "offset", "q", "second")
    df = df.withColumns({c: df["text"] for c in extra})
    for docs in (df, df.where("false")):
        total = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            after = materialize(stage(spark, docs, SF), f"odd-{name}")
            if name == "packing":
                assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").distinct().collect()}
                continue
            assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
            assert total == 0 or after.count() > 0.3 * total
            docs = after
        assert (total == 0) == (docs.count() == 0)
