import zlib

import numpy as np
import pytest

from staffmart.llm import packing
from tests.llm.plain import frame, odd_documents

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    from tokenizers import Tokenizer

    ids_of.t = getattr(ids_of, "t", None) or Tokenizer.from_file(PATH)
    return [*ids_of.t.encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, docs, capacity):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    want = {}
    for r in docs:
        ids = ids_of(r[1])
        want.setdefault((r[0], len(ids)), []).append(ids)
    assert by_doc.keys() == want.keys()
    for key, found in by_doc.items():
        ids = want[key]
        assert sum(p.length for p in found) == sum(map(len, ids))
        for p in found:
            assert any(p.ids_crc32 == zlib.crc32(np.array(x[p.start:p.start + p.length], "<u4").tobytes()) for x in ids)
        if len(ids) == 1:       # each id in exactly one piece
            spans = sorted((p.start, p.start + p.length) for p in found)
            assert spans[0][0] == 0 and spans[-1][1] == len(ids[0]) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for found in by_sequence.values():
        found.sort(key=lambda p: p.offset)
        used = 0
        for p in found:
            assert p.offset == used and p.length > 0
            used += p.length
        assert used <= capacity and (used == capacity or used & (used - 1) == 0)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pieces(spark, capacity):
    docs = odd_documents()
    check(packing.pack_documents(frame(spark, docs), PATH, 2, capacity=capacity, pool_sequences=4).collect(), docs, capacity)


def test_empty(spark):
    assert packing.pack_documents(frame(spark, [])[["doc_id", "text"]], PATH, 2).collect() == []


def test_descending_documents_go_to_the_cheapest_sequence_with_room():
    sequences, left = packing.pack_pool([6, 5, 4, 3, 2], 10, 1.0, 1.0)
    # 4 goes to the cheaper sequence, that of 5; the last document fits nowhere whole and fills the gaps
    assert sequences == [[(0, 0, 6), (3, 0, 3), (4, 1, 1)], [(1, 0, 5), (2, 0, 4), (4, 0, 1)]] and left == []


def test_pool_fills_sequences_and_cuts_only_what_does_not_fit():
    sizes = [700, 300, 999, 10, 500, 500, 123, 2]
    sequences, left = packing.pack_pool(sizes, 1000, 1.0, 1.0)
    assert [sum(p[2] for p in s) for s in sequences] == [1000] * 3
    assert sum(sizes) - 3000 == sum(sizes[d] - a for d, a in left)


def test_word_ids_are_the_librarys():
    from staffmart.llm.common import text_buffer
    import pyarrow as pa

    texts = ["Hello, World!  don't", "ÀÉÎ naïve ß É", "é combined", "a\tb\nc\x0bd\x85e f", "<|endoftext|>x<|startoftext|> <|EndOfText|>", "12345 ½ x²", "", "日本語。テスト", "İI ſ ﬁ Σς", "'S 'Ve I'LL", "a\x00b \x1c c"]
    t = packing.WordTokenizer(PATH)
    for _ in range(2):          # unseen, then remembered words
        flat, n = t.ids(*text_buffer(pa.array(texts)))
        assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [ids_of(x)[:-1] for x in texts]
