"""Exact removal of repeated byte strings by suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier (in a document of
smaller id, or before in the same one). Strings are judged on the input.

Sorting every suffix of the corpus is needless: two equal strings choose the same *anchor*, the
first ``GRAM`` bytes of least hash inside them. So strings meet through their anchor's hash:

1. Documents are written as blocks of about 2 MB. Each block sends one row per anchor hash: the
   hash of the anchor's surroundings (all that the strings of this anchor can see), or a mark if
   these differ inside the block.
2. Per hash, later anchors with equal surroundings are repeats as a whole. Anchors with different
   surroundings need their suffixes sorted; all others (nearly all) are done.
3. These suffixes are sorted per hash by deep-shallow sorting: one sort by ``SHALLOW``
   words, then radix refinement (no tries are built) of the groups with longer common prefixes:
   words that a group shares are skipped, and it is sorted by each word in which it differs. Equal strings stand side
   by side in document order; all but the first are repeats. A hash with many surroundings is
   dealt over salted tasks, each sorts its part; the first of each class goes, as a 128-bit hash
   with its place, to a bucket by that hash, packed in arrays, and meets its likes there.
4. Spans go back to their blocks, and the kept bytes are put together.

The steps are joined by written tables. No row count per key exceeds the number of blocks.

Defined cases: null text is empty; null ids come last in order; equal ids are ordered by place in
the input; texts shorter than ``LENGTH`` keep all bytes; a task's memory grows with the longest
text and the block; an empty table gives no rows; other columns pass through :func:`remove_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffmart.llm.common import blocks, input_partitions, materialize, ship_code, text_buffer, tidied
from staffmart.llm.spans import hash_ranges, hash_windows, mix, prefix_sums

LENGTH, GRAM = 100, 32
LEFT = LENGTH - GRAM                      # an anchor lies at most so far into a string
BLOCK_BYTES = 2 << 20
PLACE_BITS = 32                           # of a block's length; the other bits of a hash order the grams
SHALLOW = 2                               # words of eight bytes
SALT_ROWS = 2048
BATCH_ROWS = 8192
_LAST = 2**63 - 1
_MANY = 0
NOTHING, REPEAT, SORT = 0, 1, 2

ANCHOR_DDL = "h long, c long, n int, block long, doc_id long, place int"
VERDICT_DDL = "block long, h binary, v binary"
FOUND_DDL = "kind int, block long, spans binary, h long, salt int, doc_id long, place int, string binary"
SORTED_DDL = "kind int, block long, spans binary, bucket int, loose binary"
LOOSE = np.dtype([("w1", "<u8"), ("w2", "<u8"), ("doc_id", "<i8"), ("block", "<i8"), ("start", "<i4")])
SPANS_DDL = "block long, spans binary"


# ----------------------------------------------------------------------------- blocks
def to_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of compressed text with the ids and the other columns of their documents."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), rest.alias("rest"))
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("offsets", T.BinaryType()),
                           T.StructField("z", T.BinaryType()), T.StructField("rest", T.ArrayType(rows.schema["rest"].dataType))])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 3)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in blocks(batch, "text", block_bytes):
                known = part.column(0).is_valid().to_numpy(zero_copy_only=False)
                order = np.lexsort((~known, part.column(0).fill_null(_LAST).to_numpy()))       # nulls last
                part = part.take(pa.array(order))
                buf, offsets = text_buffer(part.column(1))
                listed = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), listed(part.column(0)), pa.array([offsets.astype("<i8").tobytes()]),
                     pa.array([codec.compress(buf.tobytes(), asbytes=True)], pa.binary()), listed(part.column(2))],
                    names=["block", "ids", "offsets", "z", "rest"])
                block += 1

    return rows.mapInArrow(run, schema)


def _open(offsets: bytes, z: bytes) -> tuple[np.ndarray, np.ndarray]:
    o = np.frombuffer(offsets, "<i8")
    if not o[-1]:
        return np.zeros(0, np.uint8), o
    return np.frombuffer(pa.Codec("zstd").decompress(z, int(o[-1]), asbytes=True), np.uint8), o


# ----------------------------------------------------------------------------- anchors
def anchors(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash and surroundings of each anchor, and the first and last start of its strings."""
    none = np.zeros(0, np.int64)
    if len(buf) < LENGTH:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    sums = prefix_sums(buf)
    h = hash_windows(sums, GRAM)
    # the least hash of each string's grams, and the place of its first occurrence below it; the
    # same bits of the hash count in every block, so a string has the same anchor wherever it stands
    bits = np.uint64(PLACE_BITS)
    m = h >> bits
    m <<= bits
    m |= np.arange(len(m), dtype=np.uint64)
    width, step = LEFT + 1, 1
    while 2 * step <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    if step < width:
        m = np.minimum(m[:len(m) - (width - step)], m[width - step:])
    size = np.diff(offsets)
    ends = np.repeat(offsets[1:], size)[:len(m)]
    ends -= LENGTH
    start = np.flatnonzero(np.arange(len(m)) <= ends)
    del ends
    if not len(start):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    place = (m[start] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = start[np.r_[new[1:], len(start)] - 1]
    place, first = place[new], start[new]
    row = np.searchsorted(offsets, place, "right") - 1
    low, high = np.maximum(place - LEFT, offsets[row]), np.minimum(place + LENGTH, offsets[row + 1])
    c = mix(hash_ranges(sums, low, high) + mix((place - low).astype(np.uint64) * np.uint64(1000003)))
    return place, h[place], np.where(c == _MANY, np.uint64(1), c), first, last


def _first_of(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (hash, surroundings, place), and which of the ordered is the first of its pair."""
    order = np.lexsort((c, h))
    hs, cs = h[order], c[order]
    return order, np.r_[True, (hs[1:] != hs[:-1]) | (cs[1:] != cs[:-1])] if len(h) else np.zeros(0, bool)


def _keys(ids: list, offsets: np.ndarray, place: np.ndarray) -> np.ndarray:
    known = np.array([_LAST if x is None else x for x in ids], np.int64)
    return known[np.searchsorted(offsets, place, "right") - 1]


def anchor_rows(table: DataFrame) -> DataFrame:
    """One row per block and anchor hash."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, offsets, z in zip(*[c.to_pylist() for c in batch.columns]):
                buf, o = _open(offsets, z)
                place, h, c, _, _ = anchors(buf, o)
                order, first = _first_of(h, c)
                order = order[first]
                hs, cs = h[order], c[order]
                new = np.flatnonzero(np.r_[True, hs[1:] != hs[:-1]]) if len(hs) else np.zeros(0, np.int64)
                n = np.diff(np.r_[new, len(hs)])
                at = place[order[new]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hs[new].view(np.int64)), pa.array(np.where(n > 1, np.uint64(_MANY), cs[new]).view(np.int64)), pa.array(n.astype(np.int32)),
                     pa.array(np.full(len(new), block, np.int64)), pa.array(_keys(ids, o, at)), pa.array(at.astype(np.int32))],
                    names=["h", "c", "n", "block", "doc_id", "place"])

    return table.select("block", "ids", "offsets", "z").mapInArrow(run, ANCHOR_DDL)


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int, rows: int) -> Iterator[pa.Table]:
    """Batches of a stream sorted by its first columns, cut where a key ends."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            t = pa.Table.from_batches(held)
            keys = [t.column(i).to_numpy() for i in range(n_keys)]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            if len(change):
                cuts = [0]
                for x in change.tolist():            # pieces of about `rows`
                    if x - cuts[-1] >= rows:
                        cuts.append(x)
                if cuts[-1] != change[-1]:
                    cuts.append(int(change[-1]))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    yield t.slice(a, b - a)
                held, size = t.slice(cuts[-1]).to_batches(), t.num_rows - cuts[-1]
    if size:
        yield pa.Table.from_batches(held)


def verdicts(rows: DataFrame, parts: int, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Per block: the hashes that are repeats or need sorting (with their number of salts)."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 1, 1 << 18):
            h, c, n, block = (t.column(i).to_numpy() for i in range(4))
            new_h = np.r_[True, h[1:] != h[:-1]]
            new_c = new_h | np.r_[True, c[1:] != c[:-1]]
            group = np.cumsum(new_h) - 1
            total = np.bincount(group, weights=n)[group]
            differ = (np.bincount(group, weights=new_c)[group] > 1) | (np.bincount(group, weights=c == _MANY)[group] > 0)
            v = np.where((c != _MANY) & ~new_c, REPEAT, np.where(differ, SORT + np.ceil(total / salt_rows).astype(np.int64) - 1, NOTHING))
            told = np.flatnonzero(v != NOTHING)
            told = told[np.argsort(block[told], kind="stable")]
            cuts = np.flatnonzero(np.r_[True, block[told][1:] != block[told][:-1]]) if len(told) else []
            out = [(int(block[x[0]]), h[x].astype("<i8").tobytes(), v[x].astype("<i4").tobytes()) for x in np.split(told, cuts[1:])] if len(told) else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["block", "h", "v"])

    return rows.repartition(parts, "h").sortWithinPartitions("h", "c", "doc_id", "block", "place").mapInArrow(run, VERDICT_DDL)


# ----------------------------------------------------------------------------- strings to sort
def _runs(first: np.ndarray, last: np.ndarray) -> bytes:
    """Runs of string starts, neighbours joined."""
    if not len(first):
        return b""
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    new = np.r_[True, first[1:] > last[:-1] + 1]
    return np.stack([first[new], last[np.r_[np.flatnonzero(new)[1:], len(last)] - 1]]).T.astype("<i8").tobytes()


def _runs_by_block(block: np.ndarray, start: np.ndarray) -> list[tuple[int, bytes]]:
    """Runs of string starts, per block."""
    if not len(block):
        return []
    by = np.lexsort((start, block))
    block, start = block[by], start[by]
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    return [(int(block[x[0]]), _runs(start[x], start[x])) for x in np.split(np.arange(len(block)), cuts[1:])]


def find_strings(table: DataFrame, told: DataFrame) -> DataFrame:
    """Kind 0: runs of repeated strings per block. Kind 1: surroundings whose strings need sorting."""
    joined = table.join(told.groupBy("block").agg(F.collect_list(F.struct("h", "v")).alias("told")), "block", "left")

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, offsets, z, told in zip(*[c.to_pylist() for c in batch.columns]):
                buf, o = _open(offsets, z)
                place, h, c, first, last = anchors(buf, o)
                keys = np.frombuffer(b"".join(x["h"] for x in told or ()), "<i8").view(np.uint64)
                v = np.frombuffer(b"".join(x["v"] for x in told or ()), "<i4")
                order = np.argsort(keys)
                keys, v = keys[order], v[order]
                verdict = np.zeros(len(h), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    verdict = np.where(keys[at] == h, v[at], NOTHING)
                order, new = _first_of(h, c)
                repeat = np.ones(len(h), bool)
                repeat[order[new]] = False
                repeat |= verdict == REPEAT
                x = np.flatnonzero(~repeat & (verdict >= SORT))
                salts = (verdict[x] - SORT + 1).astype(np.uint64)
                raw = buf.tobytes()
                n = len(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[0, np.ones(n)].astype(np.int32)), pa.array(np.full(n + 1, block, np.int64)),
                     pa.array([_runs(first[repeat], last[repeat])] + [None] * n, pa.binary()), pa.array([None, *h[x].view(np.int64).tolist()], pa.int64()),
                     pa.array([0, *np.where(salts > 1, c[x] % salts + np.uint64(1), 0).tolist()], pa.int32()), pa.array([None, *_keys(ids, o, place[x]).tolist()], pa.int64()),
                     pa.array([0, *first[x].tolist()], pa.int32()), pa.array([None, *[raw[a:b + LENGTH] for a, b in zip(first[x].tolist(), last[x].tolist())]], pa.binary())],
                    names=["kind", "block", "spans", "h", "salt", "doc_id", "place", "string"])

    return joined.select("block", "ids", "offsets", "z", "told").mapInArrow(run, FOUND_DDL)


def equal_strings(buf: np.ndarray, start: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Deep-shallow sorting of the strings at ``start`` inside each group.

    Returns the strings in sorted order (equal ones in the given order) and which of them differ
    from the one before."""
    data = np.concatenate((buf, np.zeros(16, np.uint8))).astype(np.uint64)
    word = np.zeros(len(buf) + 8, np.uint64)
    for i in range(8):
        word |= data[i:i + len(word)] << np.uint64(56 - 8 * i)
    words = -(-LENGTH // 8)
    low = np.uint64(64 - 8 * (LENGTH - 8 * (words - 1)))

    def key(d: int, at: np.ndarray) -> np.ndarray:
        x = word[at + 8 * d]
        return x >> low << low if d == words - 1 else x

    # shallow: order of the first words
    order = np.lexsort((*[key(d, start) for d in range(SHALLOW - 1, -1, -1)], group))
    new = np.r_[True, np.any([x[1:] != x[:-1] for x in (group[order], *[key(d, start[order]) for d in range(SHALLOW)])], axis=0)]
    # deep: the groups that are left, word by word; a shared word is skipped
    for d in range(SHALLOW, words):
        label = np.cumsum(new) - 1
        size = np.bincount(label)
        deep = np.flatnonzero(size[label] > 1)
        if not len(deep):
            break
        head = np.flatnonzero(new)[label[deep]]
        x = key(d, start[order[deep]])
        differs = np.bincount(label[deep], weights=x != key(d, start[order[head]]), minlength=len(size)) > 0
        branch = deep[differs[label[deep]]]
        if not len(branch):
            continue
        x = key(d, start[order[branch]])
        sort = np.lexsort((x, label[branch]))
        order[branch] = order[branch][sort]
        x, g = x[sort], label[branch]
        new[branch] = np.r_[True, (x[1:] != x[:-1]) | (g[1:] != g[:-1])]
    return order, new


def sort_strings(found: DataFrame, parts: int) -> DataFrame:
    """Kind 0: runs of repeated strings per block. Kind 1: the first strings of salted groups, as
    arrays of ``LOOSE`` records by bucket."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 2, BATCH_ROWS):
            h, salt, doc_id, block, place = (t.column(i).to_numpy() for i in range(5))
            buf, offsets = text_buffer(t.column(5))
            count = np.diff(offsets) - LENGTH + 1
            at = np.repeat(np.arange(len(h)), count)
            inner = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            start = offsets[at] + inner
            group = np.cumsum(np.r_[True, (h[1:] != h[:-1]) | (salt[1:] != salt[:-1])])
            order, new = equal_strings(buf, start, group[at])
            repeat = order[~new]
            runs = _runs_by_block(block[at[repeat]], place[at[repeat]] + inner[repeat])
            loose = order[new]
            loose = loose[salt[at[loose]] > 0]
            records = np.zeros(len(loose), LOOSE)
            if len(loose):
                records["w1"] = hash_ranges(prefix_sums(buf), start[loose], start[loose] + LENGTH)
                w2 = np.zeros(len(loose), np.uint64)
                for i in range(LENGTH):
                    w2 = w2 * np.uint64(0xD1342543DE82EF95) + buf[start[loose] + i].astype(np.uint64) + np.uint64(1)
                records["w2"], records["doc_id"], records["block"], records["start"] = w2, doc_id[at[loose]], block[at[loose]], place[at[loose]] + inner[loose]
            bucket = (records["w1"] >> np.uint64(32)).astype(np.int64) % parts
            by = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.r_[True, bucket[by][1:] != bucket[by][:-1]]) if len(by) else np.zeros(0, np.int64)
            packed = [(int(bucket[x[0]]), records[x].tobytes()) for x in np.split(by, cuts[1:])] if len(by) else []
            out = [(0, x, y, None, None) for x, y in runs] + [(1, None, None, x, y) for x, y in packed]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.binary()))],
                                                 names=["kind", "block", "spans", "bucket", "loose"])

    rows = found.where("kind = 1").select("h", "salt", "doc_id", "block", "place", "string")
    return rows.repartition(parts, "h", "salt").sortWithinPartitions("h", "salt", "doc_id", "block", "place").mapInArrow(run, SORTED_DDL)


def join_salted(sorted_: DataFrame, parts: int) -> DataFrame:
    """Runs of the strings of salted groups that another salt holds earlier."""

    def repeats(held: list[bytes]) -> pa.RecordBatch | None:
        x = np.frombuffer(b"".join(held), LOOSE)
        x = x[np.lexsort((x["start"], x["block"], x["doc_id"], x["w2"], x["w1"]))]
        late = x[1:][(x["w1"][1:] == x["w1"][:-1]) & (x["w2"][1:] == x["w2"][:-1])]
        runs = _runs_by_block(late["block"], late["start"].astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*runs)], names=["block", "spans"]) if runs else None

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        of = None
        for batch in batches:
            for bucket, loose in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != of and held:
                    if (out := repeats(held)) is not None:
                        yield out
                    held = []
                of = bucket
                held.append(loose)
        if held and (out := repeats(held)) is not None:
            yield out

    rows = sorted_.where("kind = 1").select("bucket", "loose")
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(run, SPANS_DDL)


# ----------------------------------------------------------------------------- result
def _covered(n: int, spans: list[bytes]) -> np.ndarray:
    """Which of n bytes the strings that start in the runs cover."""
    runs = np.frombuffer(b"".join(spans), "<i8").reshape(-1, 2)
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, runs[:, 0], 1)
    np.add.at(edge, runs[:, 1] + LENGTH, -1)
    return np.cumsum(edge[:-1]) > 0


def _finish(docs: DataFrame, id_col: str, text_col: str, schema: T.StructType | str, made: Callable[[dict], pa.RecordBatch],
            block_bytes: int, salt_rows: int) -> DataFrame:
    spark = docs.sparkSession
    ship_code(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * input_partitions(docs))
    table = materialize(to_blocks(docs, id_col, text_col, block_bytes), "suffix-blocks")
    told = verdicts(anchor_rows(table), parts, salt_rows)
    found = materialize(find_strings(table.select("block", "ids", "offsets", "z"), told), "suffix-found")
    sorted_ = materialize(sort_strings(found, parts), "suffix-sorted")
    spans = (found.where("kind = 0").select("block", "spans").unionByName(sorted_.where("kind = 0").select("block", "spans"))
             .unionByName(join_salted(sorted_, parts)).groupBy("block").agg(F.collect_list("spans").alias("spans")))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {f: batch.column(j)[i] for j, f in enumerate(batch.schema.names)}
                buf, offsets = _open(row["offsets"].as_py(), row["z"].as_py())
                gone = _covered(len(buf), row["spans"].as_py() or [])
                yield made({"ids": row["ids"].values, "rest": row["rest"].values, "buf": buf, "offsets": offsets, "gone": gone})

    return table.join(spans, "block", "left").select("ids", "offsets", "z", "rest", "spans").mapInArrow(run, schema)


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                  salt_rows: int = SALT_ROWS) -> DataFrame:
    """Per document: bytes, removed bytes and runs, and the digest of what is kept."""

    def made(x: dict) -> pa.RecordBatch:
        gone, offsets, buf = x["gone"], x["offsets"], x["buf"]
        rows = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            g = gone[a:b]
            n = int(g.sum())
            spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if n else 0
            rows.append((b - a, n, spans, hashlib.sha256((buf[a:b][~g] if n else buf[a:b]).tobytes()).hexdigest()))
        return pa.RecordBatch.from_arrays([x["ids"], *[pa.array(c) for c in zip(*rows)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _finish(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text",
                   "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", made, block_bytes, salt_rows)


def _kept_text(raw: np.ndarray, gone: np.ndarray) -> str:
    """The kept runs, each decoded by itself: halves of two characters never make a third."""
    if not gone.any():
        return raw.tobytes().decode()
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True])).astype(np.int8)))
    return "".join(raw[a:b].tobytes().decode("utf-8", "ignore") for a, b in edge.reshape(-1, 2))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeats taken out of its text. Characters cut by a span's edge go as a
    whole; ``chars_col``, if there, is counted anew."""

    def made(x: dict) -> pa.RecordBatch:
        kept = [_kept_text(x["buf"][a:b], x["gone"][a:b]) for a, b in zip(x["offsets"][:-1], x["offsets"][1:])]
        columns = dict(zip((f.name for f in x["rest"].type), x["rest"].flatten())) | {text_col: pa.array(kept, pa.string())}
        if chars_col in columns:
            columns[chars_col] = pa.array([len(t) for t in kept], columns[chars_col].type)
        return pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    names = docs.columns
    return _finish(docs, id_col, text_col, docs.schema, made, BLOCK_BYTES, SALT_ROWS)
