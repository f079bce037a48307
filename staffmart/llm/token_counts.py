"""Token counts by the whole-token shortcut.

A text is divided into units that no merge of the vocabulary can cross: a run of spaces with the
characters after it, and each line feed. :func:`prove_units` checks that on the vocabulary's
pieces. Pieces that the library encodes alone as themselves are found once per worker; a unit
equal to one of them counts 1 without any merging. Only the other units are merged, by the
library, each once while it is remembered.

Defined cases: null or empty text has 0 bytes and 0 tokens; a null id stays null; repeated rows
are counted each; special strings inside texts are ordinary text; an empty table gives no rows;
columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.llm.common import blocks, record_batch, ship_code, text_buffer
from staffmart.llm.spans import HashTable, hash_spans

LIMIT = 4096
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
DDL = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_SPACE, _LINE = 32, 10
_COUNTERS: dict[str, UnitCounter] = {}


def prove_units(pieces: list[str]) -> bool:
    """No piece holds a space after another character, or a line feed beside anything: then no
    merge crosses a unit's border."""
    return not any("▁" in p.lstrip("▁") or ("\n" in p and p != "\n") for p in pieces)


def units(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of each unit."""
    if not len(buf):
        return (np.zeros(0, np.int64),) * 3
    space, line = buf == _SPACE, buf == _LINE
    first = line.copy()
    first[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    first[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], len(buf)), np.searchsorted(offsets, starts, "right") - 1


class UnitCounter:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        normal = [i for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i))]
        pieces = [self.model.id_to_piece(i) for i in normal]
        self.divided = prove_units(pieces)
        self.table = HashTable()
        # Which vocabulary strings encode alone as one token: asked of the library, piece by piece.
        texts = [p.replace("▁", " ").encode() for p in pieces]
        texts = [t for t in texts if t.decode(errors="replace").strip(" ") or t]
        whole = [t for t, k in zip(texts, self._merge(texts)) if k == 1]
        self.whole = len(whole)
        self.proven = self._keys_of(whole)

    @staticmethod
    def _keys_of(texts: list[bytes]) -> np.ndarray:
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - np.array([len(t) for t in texts])
        return np.unique(hash_spans(np.frombuffer(b"".join(texts), np.uint8), starts, ends))

    def _merge(self, texts: list[bytes]) -> list[int]:
        """Tokens of each unit by the library, which puts a space before every text: a unit that
        starts with spaces gives one of them up; any other goes behind a line feed, and the
        space and the feed are taken off again."""
        asked, less = [], []
        for t in texts:
            s = t.decode()
            if s == " ":
                asked.append("\n")                 # the space alone, and the feed
            elif s.startswith(" "):
                asked.append(s[1:])
            elif s == "\n":
                asked.append("\n")
            else:
                asked.append("\n" + s)
            less.append(1 if s in (" ", "\n") else 0 if s.startswith(" ") else 2)
        return [len(x) - k for x, k in zip(self.model.encode(asked, num_threads=1), less)]

    def count(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        if not self.divided:                       # a vocabulary with pieces across units: no shortcut
            raw = buf.tobytes()
            return np.array([len(self.model.encode(raw[a:b].decode(), num_threads=1)) for a, b in zip(offsets[:-1], offsets[1:])], np.int64)
        if len(self.table) > self.table.limit:
            self.table.clear()
        # The library puts a space before each text: give the bytes one, and every unit is alike.
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        buf = np.insert(buf, offsets[:-1][full], _SPACE)
        offsets = offsets + np.concatenate(([0], np.cumsum(offsets[1:] > offsets[:-1])))
        starts, ends, row = units(buf, offsets)
        if not len(starts):
            return np.zeros(rows, np.int64)
        keys, first, back = np.unique(hash_spans(buf, starts, ends), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.proven, keys), len(self.proven) - 1)
        n = np.where(self.proven[at] == keys, 1, -1)
        n = np.where(n < 0, self.table.find(keys), n)
        new = np.flatnonzero(n < 0)
        if len(new):
            raw = buf.tobytes()
            n[new] = self._merge([raw[starts[i]:ends[i]] for i in first[new]])
            self.table.add(keys[new], n[new])
        return np.bincount(row, weights=n[back], minlength=rows).astype(np.int64)


def counter(path: str) -> UnitCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = UnitCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than ``limit`` tokens."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(model_path)
        for batch in batches:
            for block in blocks(batch, "text"):
                buf, offsets = text_buffer(block.column(1))
                n = of.count(buf, offsets)
                yield record_batch({"doc_id": block.column(0), "n_bytes": np.diff(offsets), "n_tokens": n, "over_limit": n > limit}, SCHEMA)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, DDL)
