import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from staffmart.llm import suffix_dedup
from tests.llm.plain import LAST, frame, odd_documents, repeats


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3000}, {"block_bytes": 3000, "salt_rows": 4}])
def test_against_every_window(spark, options):
    docs = odd_documents(2) + [(900 + i, odd_documents(2)[3][1], "en", "s", 1) for i in range(3)]
    found = suffix_dedup.removed_spans(frame(spark, docs), **options).collect()
    assert sorted((LAST if r[0] is None else r[0], *r[1:]) for r in found) == repeats(docs)


def test_empty(spark):
    assert suffix_dedup.removed_spans(frame(spark, [])).collect() == []


def test_documents_keep_their_columns(spark):
    docs = odd_documents(3)
    df = frame(spark, docs)
    found = suffix_dedup.remove_repeats(df)
    assert found.schema == df.schema
    rows = found.collect()
    assert len(rows) == len(docs) and all(r.n_chars == len(r.text) for r in rows)
    assert sorted(str((r.doc_id, r.source, r.lang)) for r in rows) == sorted(str((r[0], r[3], r[2])) for r in docs)
    by_id = {r.doc_id: r.text for r in rows}
    seen = {r[0]: r[1] or "" for r in docs}
    assert all(len(by_id[i]) <= len(t) for i, t in seen.items()) and sum(map(len, by_id.values())) < sum(map(len, seen.values()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a" * 150, "ab" * 70, "abc" * 45 + "d", "a" * 99 + "b" + "a" * 60]), min_size=2, max_size=8))
def test_sorting_puts_equal_strings_side_by_side(texts):
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    start = np.arange(len(buf) - suffix_dedup.LENGTH + 1)
    group = start % 2
    order, new = suffix_dedup.equal_strings(buf, start, group)
    raw = buf.tobytes()
    classes = {}
    for i, s in enumerate(start.tolist()):
        classes.setdefault((group[i], raw[s:s + 100]), []).append(i)
    label = np.cumsum(new)
    got = {}
    for i, x in zip(order.tolist(), label.tolist()):
        got.setdefault(x, []).append(i)
    assert sorted(got.values()) == sorted(classes.values())


def test_a_string_has_one_anchor_in_every_block():
    """Few bits of the hash left to compare: ties fall to the first place, in short blocks and long."""
    text = bytes((i * 7 + i // 13) % 5 + 97 for i in range(400))
    alone = np.frombuffer(text, np.uint8)
    padded = np.frombuffer(b"x" * 70_000 + text + b"y" * 3_000_000, np.uint8)
    a = suffix_dedup.anchors(alone, np.array([0, len(alone)]))
    b = suffix_dedup.anchors(padded, np.array([0, 70_000, 70_400, len(padded)]))
    inside = (b[0] >= 70_000) & (b[0] < 70_400)
    assert (b[0][inside] - 70_000).tolist() == a[0].tolist() and b[1][inside].tolist() == a[1].tolist()


def test_halves_of_characters_do_not_make_another(spark):
    passage = "ж" * 10 + "".join(chr(0x430 + i % 32) for i in range(60))
    # documents 2 and 3 end a shared run inside a character: the same lead byte, another second byte
    docs = [(1, passage + "аб", "ru", "s", 1), (2, "я" + passage + "вг", "ru", "s", 1), (3, "ю" + passage + "рс", "ru", "s", 1)]
    rows = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(frame(spark, docs)).collect()}
    assert rows[1] == docs[0][1]
    whole = {r.doc_id: r for r in suffix_dedup.removed_spans(frame(spark, docs)).collect()}
    assert whole[2].n_removed >= 100 and whole[3].n_removed >= 100
    for i, _, *_ in docs[1:]:
        given = docs[i - 1][1]
        left = iter(given)
        assert all(c in left for c in rows[i])          # a subsequence of the text: no character that was not there
    raw = np.frombuffer("жя".encode(), np.uint8)
    assert suffix_dedup._kept_text(raw, np.array([False, True, True, False])) == ""
