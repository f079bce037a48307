import collections
import hashlib

from pyspark.sql import functions as F

from staffmart.llm import fingerprints as fp
from tests.llm.plain import frame, odd_documents


def expected(docs):
    rows = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, r in enumerate(rows):
        t, after = r[1] or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(t) // 3
        out.append((r[0], len(t), hashlib.sha256((t[:len(t) - k] + after[:k]).encode()).hexdigest()))
    return sorted(map(str, out))


def pairs(text):
    return collections.Counter(p for line in text.split("\n") for p in zip(["", *line.split(" ")], line.split(" ")))


def cosine(a, b):
    x, y = pairs(a), pairs(b)
    dot = lambda p, q: sum(n * q[w] for w, n in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_edits_and_equality(spark):
    docs = odd_documents(4)
    rows = fp.fingerprint_edits(frame(spark, docs), ranges=7).collect()
    assert sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in rows) == expected(docs)
    text = {r[0]: r[1] or "" for r in docs}
    by_text = {}
    for r in rows:
        by_text.setdefault(text[r.doc_id], set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(x) == 1 for x in by_text.values())
    assert len({next(iter(x)) for x in by_text.values()}) == len(by_text)
    # likeness estimates the cosine of the word pairs
    in_order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    after = {r[0]: in_order[(i + 1) % len(docs)][1] or "" for i, r in enumerate(in_order)}
    errors = []
    once = collections.Counter(r[0] for r in docs)
    for r in rows:
        if once[r.doc_id] > 1:
            continue
        t, k = text[r.doc_id], len(text[r.doc_id]) // 3
        errors.append(abs(r.near_next - cosine(t, after[r.doc_id])))
        errors.append(abs(r.near_edited - cosine(t, t[:len(t) - k] + after[r.doc_id][:k])))
    assert sum(errors) / len(errors) < 0.06 and max(errors) < 0.4


def test_few_rows(spark):
    assert fp.fingerprint_edits(frame(spark, []), ranges=3).collect() == []
    (one,) = fp.fingerprint_edits(frame(spark, [(5, "abc def ghi", "en", "s", 1)]), ranges=3).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abc def abc").hexdigest() and one.near_next == 1.0
    nulls = [(None, "b", None, None, 0), (None, "a", None, None, 0)]
    assert sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in fp.fingerprint_edits(frame(spark, nulls), ranges=3).collect()) == expected(nulls)


def test_order_of_paragraphs_insertion_and_deletion(spark):
    df = spark.createDataFrame([(1, "a b c\nd e\nf"), (2, "f\na b c\nd e"), (3, "a b c\nd e"), (4, "f"), (5, "a b c\nd e\ng")], "id long, t string")
    v = fp.vectors(df, "t", ["id"]).select("id", F.struct("n", "lanes", "strong").alias("v"))
    form = {r[0]: r[1] for r in v.select("id", fp.text_form(F.col("v"))).collect()}
    assert form[1] == form[2] and len(set(form.values())) == 4
    wide = v.groupBy().pivot("id", [1, 2, 3, 4, 5]).agg(F.first("v"))
    whole, less = wide.select(fp.text_form(fp.insert(F.col("3"), F.col("4"))), fp.text_form(fp.delete(F.col("1"), F.col("4")))).first()
    assert whole == form[1] and less == form[3]


def test_no_python_on_the_way(spark):
    plan = fp.fingerprint_edits(frame(spark, odd_documents(4)), ranges=3)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD[")) or "Scan ExistingRDD" in plan
    assert "MapIn" not in plan and "EvalPython" not in plan
