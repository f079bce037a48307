"""Plain, slow versions of the operators, and rows with every odd case, for the tests."""

from __future__ import annotations

import collections
import hashlib
import random

LAST = 2**63 - 1


def odd_documents(seed: int = 1, n: int = 120) -> list[tuple]:
    """Documents with shared passages, copies, near copies, nulls, empty and long texts."""
    rnd = random.Random(seed)
    word = [''.join(rnd.choice("abcdeéñü") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    passages = [' '.join(rnd.choice(word) for _ in range(60)) for _ in range(4)]
    texts = []
    for i in range(n):
        t = ' '.join(rnd.choice(word) for _ in range(rnd.randint(0, 90)))
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            t += p[a:rnd.randint(a, len(p))] + rnd.choice(["\n", " "])
        texts.append(t)
        if rnd.random() < 0.2 and t:
            w = t.split(" ")
            w[rnd.randrange(len(w))] = "changed"
            texts.append(' '.join(w))
    texts += ["", " ", None, "x" * 400, "ab" * 200, texts[0], texts[1], "a b", "A  B", "\n\n", "日本語 テキスト", "<s> é <|endoftext|>", ' '.join(word) * 12]
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "s3", None]), len(t or "")) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    return rows + [rows[5], (None, "a null id " * 5, None, "s1", 50)]


DDL = "doc_id long, text string, lang string, source string, n_chars int"
# Names that the operators use inside, as columns of the input.
CLASHES = ("size", "k", "block", "h", "rest", "row", "n", "range", "place", "copy", "target", "label_id", "toxic", "half", "spans", "z", "score")


def frame(spark, rows, clashes: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DDL).repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHES}) if clashes else df


def repeats(docs, length=100):
    """(id, bytes, removed, runs, digest) of each document."""
    seen, out = set(), []
    for doc_id, _, b in sorted((LAST if r[0] is None else r[0], i, (r[1] or "").encode()) for i, r in enumerate(docs)):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        runs = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        out.append((doc_id, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def join_components(docs):
    """(id, set size, component) of each document; -1 for a null id."""
    sets, meet, up = [shingles(r[1]) for r in docs], collections.defaultdict(list), list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        if docs[i][0] is None:
            continue
        common = collections.Counter(j for t in s for j in meet[t])
        for t in s:
            meet[t].append(i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
    least = {}
    for i, r in enumerate(docs):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), LAST), r[0])
    return sorted((-1, len(s), -1) if r[0] is None else (r[0], len(s), least[root(i)]) for i, (r, s) in enumerate(zip(docs, sets)))
