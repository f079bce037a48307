import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from staffmart.llm import token_counts
from staffmart.llm.common import text_buffer
from tests.llm.plain import frame, odd_documents

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a  b ", "\n", "a\n\nb c", " \n x", "a\n b", "<s> hi </s>", "▁a ▁", "a\tb\x00c", "日本語 é", "\r\n", "   "]


def test_units_are_proven_and_many_pieces_stand_alone():
    c = token_counts.counter(PATH)
    assert c.divided and c.whole > 10_000
    assert not token_counts.prove_units(["a▁b"]) and not token_counts.prove_units(["a\n"]) and token_counts.prove_units(["▁▁a", "\n"])


def test_odd_texts():
    c = token_counts.UnitCounter(PATH)
    for _ in range(2):
        assert c.count(*text_buffer(pa.array(ODD))).tolist() == [len(c.model.encode(t)) for t in ODD]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab Z.é日\n\t▁<s>0")) | st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=5))
def test_any_text(texts):
    c = token_counts.counter(PATH)
    assert c.count(*text_buffer(pa.array(texts))).tolist() == [len(c.model.encode(t)) for t in texts]


def test_documents(spark):
    docs = odd_documents()
    c = token_counts.counter(PATH)
    found = token_counts.count_tokens(frame(spark, docs), PATH, limit=50).collect()
    want = [(r[0], len((r[1] or "").encode()), n := len(c.model.encode(r[1] or "")), n > 50) for r in docs]
    assert sorted(map(str, found)) == sorted(f"Row(doc_id={a}, n_bytes={b}, n_tokens={n}, over_limit={o})" for a, b, n, o in want)
    assert token_counts.count_tokens(frame(spark, []), PATH).collect() == []
