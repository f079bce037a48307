"""Cost-balanced packing of documents into fixed-size token sequences.

A document costs ``linear * n + quadratic * n * n / capacity`` (feed-forward and attention work).
Documents are taken in descending size; each goes to the sequence of lowest cost that still has
room for it. What fits nowhere fills the gaps that are left, cut at their size.

Each input partition packs its own documents, a pool of some hundred sequences at a time, and
carries what is left over into the next pool: no shuffle, and memory of one pool. A partition's
last tokens (fewer than one sequence) go into sequences whose lengths are powers of two, which
need no padding.

Defined cases: null or empty text is the end token alone; a null id stays null; repeated rows are
packed as often as they occur; very long documents are cut into whole sequences, the rest is
packed as a document of its own; an empty table gives no rows; columns other than id and text
are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffmart.llm.common import blocks, ship_code, text_buffer, tidied
from staffmart.llm.spans import LOWER, HashTable, byte_set, hash_spans, words

CAPACITY = 4096
POOL_SEQUENCES = 256
SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_length", pa.int64())])
DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
       "sequence_length long")

# Bytes that always split words for the tokenizer, whatever stands around them.
_NOT_SPLIT = ~byte_set(b" \n\t\r")
# The tokenizer's own pattern, for printable ASCII and Latin-1 letters in lower case.
_PLAIN = re.compile("(?!.*<\\|)[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def _byte_chars() -> dict[int, str]:
    """Byte-level vocabularies write a byte as the character of its code; codes that do not print
    get the code points from 256 on, in order."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_CHARS = {c: "".join(_byte_chars()[b] for b in chr(c).encode()) for c in range(192, 256)}
_TOKENIZERS: dict[str, WordTokenizer] = {}


class WordTokenizer:
    """Ids of white-space separated words, each encoded once while it is remembered.

    The tokenizer's pattern never matches across white space, so a text's ids are its words'
    ids one after the other. Words of printable ASCII and Latin-1 letters are divided by the
    tokenizer's pattern written for these characters and go straight to its merges; composition
    and special tokens cannot occur in them. The library encodes all others as a whole.
    """

    def __init__(self, path: str, fold_case: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.fold_case = fold_case
        self.table = HashTable()
        self.clear()

    def clear(self) -> None:
        self.table.clear()
        self.starts, self.pool, self.used, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.int32), 0, 0

    def _encode(self, text: bytes) -> list[int]:
        word = text.decode()
        if not _PLAIN.fullmatch(word):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        word = word.lower()
        parts = [word] if word.isalpha() else _PARTS.findall(word)
        if not word.isascii():
            parts = [p.translate(_BYTE_CHARS) for p in parts]
        return [t.id for p in parts for t in self.merge(p)]

    def _learn(self, keys: np.ndarray, texts: list[bytes]) -> None:
        at = self.count
        encoded = [self._encode(t) for t in texts]
        ids = np.fromiter(chain.from_iterable(encoded), np.int32)
        ends = self.used + np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        while self.count + len(encoded) + 1 > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
        self.pool[self.used:self.used + len(ids)] = ids
        self.starts[self.count + 1:self.count + 1 + len(encoded)] = ends
        self.used, self.count = self.used + len(ids), self.count + len(encoded)
        self.table.add(keys, np.arange(at, self.count))

    def ids(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All rows' ids, one after the other, and each row's number of ids."""
        if len(self.table) > self.table.limit:
            self.clear()
        # The tokenizer folds case itself; folding first only makes words meet. Special tokens
        # are matched before folding, so a block that may hold one stays as it is.
        if self.fold_case and not ((buf[:-1] == 60) & (buf[1:] == 124)).any():
            buf = LOWER[buf]
        starts, ends, row = words(buf, offsets, _NOT_SPLIT)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        keys, first, back = np.unique(hash_spans(buf, starts, ends), return_index=True, return_inverse=True)
        at = self.table.find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            raw = buf.tobytes()
            self._learn(keys[new], [raw[starts[i]:ends[i]] for i in first[new]])
            at = self.table.find(keys)
        word = at[back]
        size = self.starts[word + 1] - self.starts[word]
        to = np.cumsum(size)
        flat = self.pool[np.arange(to[-1]) + np.repeat(self.starts[word] - (to - size), size)]
        return flat, np.bincount(row, weights=size, minlength=len(offsets) - 1).astype(np.int64)


def tokenizer(path: str) -> WordTokenizer:
    """One per worker process; it keeps its words from task to task."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cost(n: int, capacity: int, linear: float, quadratic: float) -> float:
    return linear * n + quadratic * n * n / capacity


def pack_pool(sizes: list[int], capacity: int, linear: float, quadratic: float) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int]]]:
    """Fill ``sum(sizes) // capacity`` sequences to the brim.

    Returns each sequence's pieces as (document, start, length) and what is left as
    (document, start). A document that is cut keeps its later part.
    """
    n = sum(sizes) // capacity
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    room, costs = [capacity] * n, [0.0] * n
    heap = [(0.0, s) for s in range(n)]
    late: list[int] = []
    for d in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        skipped, size = [], sizes[d]
        while heap and room[heap[0][1]] < size:
            skipped.append(heapq.heappop(heap))
        if heap:
            _, s = heapq.heappop(heap)
            out[s].append((d, 0, size))
            room[s] -= size
            costs[s] += cost(size, capacity, linear, quadratic)
            if room[s]:
                heapq.heappush(heap, (costs[s], s))
        else:
            late.append(d)
        for x in skipped:
            heapq.heappush(heap, x)
    left: list[tuple[int, int]] = []
    gaps = sorted((s for s in range(n) if room[s]), key=lambda s: (costs[s], s))
    at = 0
    for d in late:
        start = 0
        while start < sizes[d] and at < len(gaps):
            s = gaps[at]
            take = min(room[s], sizes[d] - start)
            out[s].append((d, start, take))
            start, room[s] = start + take, room[s] - take
            at += not room[s]
        if start < sizes[d]:
            left.append((d, start))
    return out, left


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class _Packer:
    def __init__(self, capacity: int, linear: float, quadratic: float, first_id: int):
        self.capacity, self.linear, self.quadratic, self.next_id = capacity, linear, quadratic, first_id
        self.docs: list[tuple[int | None, int, np.ndarray, int]] = []   # id, start, ids, tokens of the whole document
        self.tokens = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self._sequence([(doc_id, start, ids[start:start + self.capacity], len(ids))], self.capacity)
        if whole < len(ids):
            self.docs.append((doc_id, whole, ids[whole:], len(ids)))
            self.tokens += len(ids) - whole

    def _sequence(self, pieces: list[tuple], length: int) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next_id, offset, length))
            offset += len(ids)
        self.next_id += 1

    def pack(self) -> None:
        sequences, left = pack_pool([len(x[2]) for x in self.docs], self.capacity, self.linear, self.quadratic)
        cut = lambda d, a, n: (self.docs[d][0], self.docs[d][1] + a, self.docs[d][2][a:a + n], self.docs[d][3])
        for pieces in sequences:
            self._sequence([cut(*p) for p in pieces], self.capacity)
        self.docs = [cut(d, a, self.capacity) for d, a in left]
        self.tokens = sum(len(x[2]) for x in self.docs)

    def close(self) -> None:
        self.pack()
        todo = self.docs[::-1]
        for length in powers_of_two(self.tokens):
            pieces, room = [], length
            while room:
                doc_id, start, ids, total = todo.pop()
                pieces.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    todo.append((doc_id, start + room, ids[room:], total))
                room -= min(room, len(ids))
            self._sequence(pieces, length)
        self.docs, self.tokens = [], 0

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, linear: float = 1.0, quadratic: float = 1.0,
                   pool_sequences: int = POOL_SEQUENCES) -> DataFrame:
    """Pieces of all documents with the sequence and place each went to."""
    ship_code(docs.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = tokenizer(tokenizer_path)
        packer = _Packer(capacity, linear, quadratic, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for block in blocks(batch, "text"):
                flat, counts = words_of.ids(*text_buffer(block.column(1)))
                to = np.cumsum(counts)
                for doc_id, a, b in zip(block.column(0).to_pylist(), (to - counts).tolist(), to.tolist()):
                    packer.add(doc_id, np.append(flat[a:b], np.int32(end_id)))
                    if packer.tokens >= pool_sequences * capacity:
                        packer.pack()
                if packer.rows:
                    yield packer.batch()
        packer.close()
        if packer.rows:
            yield packer.batch()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, DDL)
