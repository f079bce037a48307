import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from staffmart.llm import toxicity
from tests.llm.plain import frame, odd_documents

SF = "/root/testdata/sf0.1"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-3.0, -1.0, -0.5, 0.7, 1.3, 2.9, 4.1]), max_size=14))
def test_segments(scores):
    got = toxicity.segments(np.array(scores))
    assert all(scores[a] > 0 and scores[b] > 0 and abs(sum(scores[a:b + 1]) - s) < 1e-9 for a, b, s in got)
    assert all(x[1] < y[0] for x, y in zip(got, got[1:]))
    best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
    if best > 0:
        assert abs(max(s for _, _, s in got) - best) < 1e-9
    # every positive score lies in a segment, and no segment has a better part
    assert all(any(a <= i <= b for a, b, _ in got) for i, s in enumerate(scores) if s > 0)
    for a, b, s in got:
        assert all(sum(scores[i:j]) <= s + 1e-9 for i in range(a, b + 1) for j in range(i + 1, b + 2))


def test_lambda_and_logistic():
    v, c = np.array([-1.0, 1.0]), np.array([3, 1])
    assert abs(toxicity.fit_lambda(v, c) - np.log(3)) < 1e-6
    x = np.c_[np.ones(200), np.linspace(-2, 2, 200)]
    w = toxicity.fit_logistic(x, (x[:, 1] > 0.5).astype(float))
    assert ((x @ w > 0) == (x[:, 1] > 0.5)).mean() > 0.97


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_documents(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    p, n = np.array([s for s, t in held if t]), np.array([s for s, t in held if not t])
    assert (p >= 0.5).mean() > 0.85 and (n >= 0.5).mean() < 0.02
    assert (p[:, None] > n).mean() + 0.5 * (p[:, None] == n).mean() > 0.93


def small(spark):
    docs = [(i, ("you vile rotten person " if i % 4 == 0 else "a kind word ") + f"about thing{i % 9} here", "en", "s", 1) for i in range(400)]
    return frame(spark, docs), spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (7, 1, None), (5, None, 0)], "doc_id long, quality int, toxic int")


def test_passages_and_stage(spark):
    docs, labels = small(spark)
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in rows)
    for r in rows:
        if r.predicted:
            assert any("you vile rotten person about"[p["first"]:p["last"]].strip() in "you vile rotten person" for p in r.passages)
    kept = toxicity.keep_clean(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {i for i in range(400) if i % 4}


def test_odd_rows(spark):
    docs, labels = small(spark)
    model = toxicity.learn(docs, labels)
    odd = odd_documents(7)
    rows = toxicity.score(frame(spark, odd), model).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
    assert toxicity.score(frame(spark, []), model).collect() == []
    none = toxicity.learn(docs, labels.where("false"))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.learn(docs.where("false"), labels).base > 0
    one_kind = toxicity.learn(docs, labels.where("toxic = 0"))
    assert {r.predicted for r in toxicity.score(docs, one_kind).collect()} == {0}


def test_tokens_of_many_scripts():
    def told(text):
        raw = text.encode()
        starts, ends, row = toxicity.tokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert (row == 0).all()
        return [raw[a:b].decode() for a, b in zip(starts, ends)]

    assert told("“vile” «mean»—x\u00a0y été") == ["vile", "mean", "x", "y", "été"]
    assert told("你好吗。 abc漢字def 一") == ["你好", "好吗", "abc", "漢字", "def", "一"]
    assert told("плохой человек") == ["плохой", "человек"]
    assert told("ไทย") == ["ไท", "ทย"]
    assert told("…、。！") == [] and told("") == []


def test_text_without_spaces_is_judged_whole(spark):
    """Planted words anywhere in sentences without spaces count as they do between spaces."""
    import random

    for space in ("", " "):
        rnd = random.Random(4)
        common = [chr(0x4E00 + i) for i in range(0, 2000, 7)]
        bad = ["鬼魔妖", "殺害毒", "惡罵辱"]
        docs = []
        for i in range(400):
            words = [rnd.choice(common) + rnd.choice(common) for _ in range(30)]
            if i % 4 == 0:
                for w in rnd.sample(bad, 2):
                    words.insert(rnd.randrange(5, len(words)), w)
            docs.append((i, space.join(words), "zh", "s", 1))
        labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
        rows = toxicity.score_documents(frame(spark, docs), labels).collect()
        held = [r for r in rows if r.held_out]
        caught = [r.predicted for r in held if r.doc_id % 4 == 0]
        assert len(caught) > 10 and np.mean(caught) > 0.95, space
        assert not any(r.predicted for r in held if r.doc_id % 4)


def plain_segments(scores, first=0):
    """Maximal scoring segments by their definition: the best one (the shortest and first of equals),
    then those left and right of it."""
    best, at = 0.0, None
    low, low_at, total = 0.0, 0, 0.0
    for i, s in enumerate(scores):
        total += s
        if total - low > best + 1e-12:
            best, at = total - low, (low_at, i)
        if total < low + 1e-12 and total <= low:
            low, low_at = total, i + 1
    if at is None:
        return []
    a, b = at
    return plain_segments(scores[:a], first) + [(first + a, first + b, best)] + plain_segments(scores[b + 1:], first + b + 1)


def test_every_row_against_a_plain_scorer(spark):
    import math
    import sys

    sys.setrecursionlimit(20_000)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    table = {int(k): (t, n) for k, t, n in zip(model.keys, model.toxic, model.weight)}
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    odds = lambda p: math.log(p / (1 - p))
    for r in rows:
        raw = (r.text or "").encode()
        keys, starts, ends, _ = toxicity.token_keys(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        seen, scores = set(), []
        for i in range(len(starts)):
            rate = model.base
            for level in (2, 1, 0):
                t, n = table.get(int(keys[level, i]), (0.0, 0.0))
                rate = (t + toxicity.PRIOR * rate) / (n + toxicity.PRIOR)
            s = max(toxicity.LOWEST, odds(rate) - odds(model.base) - toxicity.DRIFT)
            scores.append(min(s, -toxicity.DRIFT) if int(keys[0, i]) in seen else s)
            seen.add(int(keys[0, i]))
        found = plain_segments(scores)
        bits = [model.lam * s - model.log_k - math.log(max(len(scores), 1)) for _, _, s in found]
        x = (math.log1p(max([0.0, *bits])), math.log1p(sum(b for b in bits if b > 0)))
        p = 1 / (1 + math.exp(-max(-50.0, min(50.0, model.coef[0] + model.coef[1] * x[0] + model.coef[2] * x[1]))))
        assert abs(got[r.doc_id].score - p) < 1e-9 and got[r.doc_id].predicted == int(p >= 0.5)
        assert len(got[r.doc_id].passages) == sum(b > 0 for b in bits)
