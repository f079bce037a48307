import zlib

import numpy as np

from staffmart.llm import language
from tests.llm.plain import frame, odd_documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in language.identify_documents(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert found.keys() == lang.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in found.items())
    held = [i for i, r in found.items() if r.held_out]
    assert sum(found[i].lang_pred == lang[i] for i in held) > 0.97 * len(held)


def field():
    rnd = np.random.default_rng(3)
    words = {"xx": ["alo", "alu", "ilo"], "yy": ["kret", "krot", "prut"]}
    texts = [" ".join(rnd.choice(words[x], 40)) for x in ("xx", "yy") for _ in range(20)]
    return language.train(texts, ["xx"] * 20 + ["yy"] * 20, ["xx", "yy"], rounds=30)


def test_code_switched_words_and_long_texts():
    f = field()
    buf, offsets = language.text_buffer(__import__("pyarrow").array(["alo ilo alu kret krot prut krot alo alu ilo", "kret " * 500]))
    starts, ends, row = language.words(buf, offsets, language.LETTERS)
    e = f.emissions(buf, starts, ends)
    p = f.marginals(e, row)
    assert p.argmax(axis=1)[:10].tolist() == [0] * 3 + [1] * 4 + [0] * 3 and (p[10:, 1] > 0.9).all()
    # runs chained over a text give what one pass gives
    for r in (0, 1):
        one, _ = language.forward_backward(e[row == r][None], f.first, f.trans)
        one = one[0] / one[0].sum(axis=1, keepdims=True)
        assert np.allclose(p[row == r], one, atol=1e-9)


def test_forward_backward_against_all_paths():
    import itertools

    rnd = np.random.default_rng(1)
    e, first, trans = rnd.random((1, 4, 3)), rnd.random(3), rnd.random((3, 3))
    p, pairs = language.forward_backward(e, first, trans)
    total, want, want_pairs = 0.0, np.zeros((4, 3)), np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=4):
        w = first[path[0]] * np.prod([e[0, i, x] for i, x in enumerate(path)]) * np.prod([trans[a, b] for a, b in zip(path, path[1:])])
        total += w
        for i, x in enumerate(path):
            want[i, x] += w
        for a, b in zip(path, path[1:]):
            want_pairs[a, b] += w
    assert np.allclose(p[0] / p[0].sum(axis=1, keepdims=True), want / total) and np.allclose(pairs, want_pairs / total)


def test_odd_rows(spark):
    docs = odd_documents(5)
    rows = language.identify_documents(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = next(d[1] for d in docs if d[0] == r.doc_id)
        letters = any(c.isalpha() for c in text or "")
        assert (r.lang_pred in ("en", "de")) if letters else (r.lang_pred, r.score) == ("und", 0.0)
    assert language.identify_documents(frame(spark, [])).collect() == []
    unlabelled = [(i, "some words", None, "s", 1) for i in range(4)]
    assert {r.lang_pred for r in language.identify_documents(frame(spark, unlabelled)).collect()} == {"und"}


def test_grams_at_every_position():
    """The middle of a long word counts, whatever it starts and ends with."""
    rnd = np.random.default_rng(4)
    word = lambda x: "unvorhergesehenes" + "".join(rnd.choice({"xx": ["alo", "ilu"], "yy": ["kret", "prut"]}[x], 8)) + "gebundenheiten"
    f = language.train([word(x) + " " + word(x) for x in ("xx", "yy") for _ in range(60)], ["xx"] * 60 + ["yy"] * 60, ["xx", "yy"], rounds=30)
    buf, offsets = language.text_buffer(__import__("pyarrow").array([word(x) for x in ("xx", "yy") for _ in range(10)]))
    starts, ends, row = language.words(buf, offsets, language.LETTERS)
    assert f.emissions(buf, starts, ends).argmax(axis=1).tolist() == [0] * 10 + [1] * 10


def test_switch_inside_unspaced_text(spark):
    """Scripts without spaces: the sentence's middle counts, and a switch inside it is followed."""
    rnd = np.random.default_rng(5)
    chars = {"zh": list("的是不了在人有我他这"), "ja": list("のはにをたがでてとし")}
    text = lambda x, n: "".join(rnd.choice(chars[x], n))
    f = language.train([text(x, 80) for x in chars for _ in range(20)], [x for x in chars for _ in range(20)], list(chars), rounds=30)
    docs = [(1, "のは" + text("zh", 60) + "し"), (2, "的是" + text("ja", 60) + "。")]
    found = language.identify(spark.createDataFrame(docs, "doc_id long, text string"), f).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "zh", 2: "ja"}
    buf, offsets = language.text_buffer(__import__("pyarrow").array(["ab" + "的是不了在人" * 5 + "のはにをたが" * 5 + " cd é"]))
    starts, ends, row = language.cut_unspaced(buf, *language.words(buf, offsets, language.LETTERS))
    assert b"".join(buf[a:b].tobytes() for a, b in zip(starts, ends)) == buf.tobytes().replace(b" ", b"")
    best = f.marginals(f.emissions(buf, starts, ends), row).argmax(axis=1)
    assert best[1:16].tolist() == [0] * 15 and best[16:31].tolist() == [1] * 15


def test_every_language_is_learned(spark):
    """More languages than a 64-bit mask holds, one of them rare and beside many empty texts."""
    rnd = np.random.default_rng(6)
    langs = [f"l{i:02}" for i in range(70)]
    words = {x: ["".join(rnd.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(8)] for x in langs}
    rows = [(1000 * i + j, " ".join(rnd.choice(words[x], 30)), x) for i, x in enumerate(langs) for j in range(4 if x == "l69" else 12)]
    rows += [(900_000 + j, "", "l69") for j in range(3000)]
    found = {r.doc_id: r.lang_pred for r in language.identify_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(found[i] == x for i, t, x in rows if t) > 0.98 * sum(1 for r in rows if r[1])
    assert all(found[i] == x for i, t, x in rows if t and x == "l69")


def test_batches_of_the_sample():
    """Training in batches of few chains learns what whole steps learn."""
    texts, labels = ["alo ilo alu ilu " * 30, "kret krot prut " * 30], ["xx", "yy"]
    f = language.train(texts, labels, labels, rounds=30, batch=language.CHAIN * 2 * 2)
    buf, offsets = language.text_buffer(__import__("pyarrow").array(["alu ilo kret prut"]))
    starts, ends, row = language.words(buf, offsets, language.LETTERS)
    assert f.emissions(buf, starts, ends).argmax(axis=1).tolist() == [0, 0, 1, 1]


@__import__("pytest").mark.parametrize("cells", [1, 64 * 5 * 3, 1 << 21])
def test_slices_of_runs_give_what_one_pass_gives(cells):
    rnd = np.random.default_rng(8)
    k = 5
    f = language.Field([f"l{i}" for i in range(k)], np.zeros((1, k)), rnd.random(k) + 0.1, rnd.random((k, k)) + 0.01, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    sizes = [1, 700, 63, 64, 65, 2, 129, 1000, 3]
    row = np.repeat(np.arange(len(sizes)) * 2, sizes)                   # texts between them have no word
    e = rnd.random((len(row), k)) ** 3 + 1e-6
    seen = np.zeros(len(row), int)
    got = np.empty_like(e)
    for a, b, p in f.scan(row, lambda a, b: e[a:b], cells):
        got[a:b] = p
        seen[a:b] += 1
    assert (seen == 1).all()
    for r in np.unique(row):
        one, _ = language.forward_backward(e[row == r][None], f.first, f.trans)
        assert np.allclose(got[row == r], one[0] / one[0].sum(axis=1, keepdims=True), atol=1e-9)


def test_predictions_against_a_plain_pass_over_every_text(spark):
    """Every row of a table, by emissions of whole texts and one forward-backward pass each."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    f = language.learn(docs)
    got = {r.doc_id: r for r in language.identify(docs, f).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        buf = language.fold_case(np.frombuffer((r.text or "").encode(), np.uint8))
        starts, ends, row = language.cut_unspaced(buf, *language.words(buf, np.array([0, len(buf)]), language.LETTERS))
        if not any(c.isalpha() for c in r.text or ""):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        one, _ = language.forward_backward(f.emissions(buf, starts, ends)[None], f.first, f.trans)
        mean = (one[0] / one[0].sum(axis=1, keepdims=True)).mean(axis=0)
        assert got[r.doc_id].lang_pred == f.languages[int(mean.argmax())] and abs(got[r.doc_id].score - min(1.0, mean.max())) < 1e-9


def test_a_long_text_with_many_languages_needs_bounded_memory():
    import tracemalloc

    rnd = np.random.default_rng(2)
    k = 40
    f = language.Field([f"l{i}" for i in range(k)], rnd.normal(size=(language.FEATURES, k)), rnd.random(k) + 0.1, rnd.random((k, k)) + 0.01, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    words = ["".join(rnd.choice(list("abcdefgh"), 5)) for _ in range(400)]
    peaks = []
    for n in (40_000, 160_000):
        buf = np.frombuffer(" ".join(rnd.choice(words, n)).encode(), np.uint8)
        starts, ends, row = language.words(buf, np.array([0, len(buf)]), language.LETTERS)
        tracemalloc.start()
        sums = f.text_sums(buf, starts, ends, row, 1, cells=1 << 18)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert abs(sums.sum() - n) < 1e-6 * n
    # four times the words: what is added is messages and word places, not words times languages
    assert peaks[1] - peaks[0] < 0.5 * 120_000 * k * 8
