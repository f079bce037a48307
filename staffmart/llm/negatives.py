"""Hard negatives by slot-decomposed selection.

For every anchor and each of its positives, negatives are wanted whose score lies in a window
under the positive's score. The windows of an anchor overlap, so searching each by itself would
read the scores once per positive. Instead the positives' upper limits, in descending order, split
the scores into disjoint slots: slot i holds the scores up to the i-th limit and above the next.
Combiners keep the k best per slot, and every score falls into one slot only. The best of a window
are the best of all scores up to its upper limit, which is a suffix of the slots: merging the slots
from the window's own downwards and taking k answers every window, and the lower limit then only
cuts that list's end.

Positives are found first, by the same blocks: candidates are dealt into groups by a hash of their
row, anchors into blocks; a task holds one group and one block. Inside a group, a label's anchors
meet that label's rows for positives, and all rows of other labels for negatives. A hot label is
spread over all groups like any other. Vectors are integers, floor(scale * x); scores are exact for
components of any size (in doubles while that is exact, else in Python integers).

Defined cases: rows with a null id or label take no part, nor do vectors that are null, empty or
hold null or non-finite components (also after scaling); only vectors of equal length meet; an
anchor that repeats as the same row answers once, and never finds rows of its own id; rows that
repeat are found each; anchors without positives, and windows that are empty or hold nothing, give
no rows; scores beyond a long are held at its ends; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffmart.llm.common import materialize, ship_code
from staffmart.llm.vectors import by_size, matrix, products, scaled, to_binary

ANCHOR_EVERY, POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 50, 5, 3, 50, 95, 256
GROUP_ROWS, ANCHOR_ROWS, AT_ONCE = 4096, 4096, 128
FOUND_DDL = "anchor long, label string, mark binary, slot int, vec_id long, score long"


def labelled_vectors(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """vec_id, label, dim and vec (integer-valued doubles) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, lengths, flat = scaled(batch.column(2), scale)
            ids, labels = (batch.column(i).take(pa.array(row)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(lengths, pa.int32()), to_binary(flat, lengths)], names=["vec_id", "label", "dim", "vec"])

    given = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    return given.where("vec_id is not null and label is not null").mapInArrow(run, "vec_id long, label string, dim int, vec binary")


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and columns of each row's k largest allowed scores, one rank after the other; of equal
    scores the first column."""
    left = np.where(allowed, scores, -np.inf)
    row = np.arange(len(left))
    for _ in range(min(k, left.shape[1])):
        at = left[row].argmax(axis=1)
        some = left[row, at] > -np.inf
        row, at = row[some], at[some]
        if not len(row):
            return
        yield row, at
        left[row, at] = -np.inf


def top_slots(scores: np.ndarray, allowed: np.ndarray, upper: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slot, rows and columns of the k best per row and slot. ``upper`` has each row's limits in
    descending order (missing ones -inf), ``floor`` the least score that any window takes."""
    allowed = allowed & (scores <= upper[:, :1]) & (scores >= floor[:, None])
    for slot in range(upper.shape[1]):
        inside = allowed & (scores <= upper[:, slot:slot + 1])
        if slot + 1 < upper.shape[1]:
            inside &= scores > upper[:, slot + 1:slot + 2]
        for row, at in best(scores, inside, k):
            yield slot, row, at


def _frame(parts: list[tuple[np.ndarray, ...]], anchors: pd.DataFrame) -> pd.DataFrame:
    """Rows of the found (anchor row, slot, id, score) parts."""
    at, slot, ids, score = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(4))
    found = anchors.iloc[at.astype(np.int64)]
    return pd.DataFrame({"anchor": found["vec_id"].to_numpy(), "label": pd.Series(found["label"].to_numpy(object), dtype=object), "mark": pd.Series(found["mark"].to_numpy(object), dtype=object),
                         "slot": slot.astype("int32"), "vec_id": ids.astype("int64"), "score": score.astype("int64")})


def _blocks(rows: pd.DataFrame, anchors: pd.DataFrame, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor rows, ids of the rows they meet, exact scores and which pairs count, in bounded steps:
    a label's anchors with that label's rows (``same``), or all anchors with all rows, of which
    those of other labels count."""
    rows = rows.sort_values("vec_id", kind="stable").reset_index(drop=True)
    vectors, ids = matrix(list(rows["vec"])), rows["vec_id"].to_numpy()
    asked, own = matrix(list(anchors["vec"])), anchors["vec_id"].to_numpy()
    labels = pd.factorize(pd.concat([rows["label"], anchors["label"]]))[0]
    labels, theirs = labels[:len(ids)], labels[len(ids):]
    if same:
        of_label = rows.groupby(labels).indices
        pairs = [(places, of_label[x]) for x, places in anchors.reset_index(drop=True).groupby(theirs).indices.items() if x in of_label]
    else:
        pairs = [(np.arange(len(own)), np.arange(len(ids)))]
    for places, columns in pairs:
        for a in by_size(asked[places]):
            for c in by_size(vectors[columns]):
                col = columns[c]
                for at in range(0, len(a), AT_ONCE):
                    some = places[a[at:at + AT_ONCE]]
                    counts = (ids[col][None, :] != own[some][:, None]) & ((labels[col][None, :] == theirs[some][:, None]) == same)
                    yield some, ids[col], products(asked[some], vectors[col]), counts


def _search(rows: DataFrame, anchors: DataFrame, asked: int, total: int, group_rows: int, anchor_rows: int,
            search: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """``search`` over every group of rows and block of anchors."""
    groups, blocks = max(1, math.ceil(total / group_rows)), max(1, math.ceil(asked / anchor_rows))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "vec"), F.lit(n)).cast("int")
    left = rows.select("*", deal(groups).alias("g"), each(blocks).alias("b"))
    right = anchors.select("*", deal(blocks).alias("b"), each(groups).alias("g"))
    return left.groupBy("g", "b", "dim").cogroup(right.groupBy("g", "b", "dim")).applyInPandas(search, FOUND_DDL)


def mine_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: str | Column = "label", anchor_every: int = ANCHOR_EVERY,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
                   group_rows: int = GROUP_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each anchor
    (id divisible by ``anchor_every``) and each of its ``positives`` best rows of the same label, the
    ``negatives`` best rows of other labels with low% to high% of the positive's score."""
    ship_code(rows.sparkSession)
    label = F.col(label) if isinstance(label, str) else label
    rows = materialize(labelled_vectors(rows, id_col, vector_col, label, scale), "negatives-vectors")
    anchors = materialize(rows.where(F.col("vec_id") % anchor_every == 0).distinct().withColumn("mark", F.unhex(F.md5("vec"))), "negatives-anchors")
    total, asked = rows.agg(F.count("vec_id"), F.count(F.when(F.col("vec_id") % anchor_every == 0, 1))).first()
    empty = _frame([], pd.DataFrame({"vec_id": np.zeros(0, np.int64), "label": [], "mark": []}))

    def find_positives(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return empty
        return _frame([(some[row], np.zeros(len(row)), ids[at], scores[row, at]) for some, ids, scores, allowed in _blocks(a, b, True)
                       for row, at in best(scores, allowed, positives)], b)

    def find_negatives(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return empty
        limits = list(b["upper"])
        upper = np.full((len(b), max(map(len, limits))), -np.inf, object if max(abs(x[0]) for x in limits) >= 2**53 else float)
        for i, x in enumerate(limits):
            upper[i, :len(x)] = x
        floor = b["floor"].to_numpy()
        return _frame([(some[row], np.full(len(row), slot), ids[at], scores[row, at]) for some, ids, scores, allowed in _blocks(a, b, False)
                       for slot, row, at in top_slots(scores, allowed, upper[some], floor[some], negatives)], b)

    key = ["anchor", "label", "mark"]
    first = lambda *more: F.row_number().over(Window.partitionBy(*key, *more).orderBy(F.desc("score"), "vec_id"))
    found = _search(rows, anchors, asked, total, group_rows, anchor_rows, find_positives)
    # limits as whole numbers: 100 * score <= high * positive and 100 * score >= low * positive
    at_most, at_least = F.expr(f"floor(cast(score as decimal(20,0)) * {high} / 100)").cast("long"), F.expr(f"ceil(cast(score as decimal(20,0)) * {low} / 100)").cast("long")
    windows = materialize(found.withColumn("place", first()).where(F.col("place") <= positives).select(*key, "place", "vec_id", "score", at_least.alias("least"), at_most.alias("most"))
                          .where("least <= most"), "negatives-windows")
    asks = windows.groupBy(*key).agg(F.sort_array(F.collect_set("most"), asc=False).alias("upper"), F.min("least").alias("floor"))
    anchors = materialize(anchors.withColumnRenamed("vec_id", "anchor").join(asks, key).withColumnRenamed("anchor", "vec_id"), "negatives-asks")
    slots = _search(rows, anchors, asked, total, group_rows, anchor_rows, find_negatives)
    slots = slots.withColumn("place", first("slot")).where(F.col("place") <= negatives)
    # the slots' lists in descending order; a window's own list is the suffix from its slot on
    lists = slots.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", F.col("score").alias("score")))).alias("slots"))
    suffix = F.slice(F.filter("slots", lambda x: x["score"] <= F.col("most")), 1, negatives)
    taken = windows.join(lists, key).select("anchor", "vec_id", "score", F.posexplode(F.filter(suffix, lambda x: x["score"] >= F.col("least"))).alias("at", "negative"))
    return taken.select(F.col("anchor").alias("anchor_id"), F.col("vec_id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
                        F.col("negative.vec_id").alias("negative_id"), F.col("score").alias("positive_score"), F.col("negative.score").alias("negative_score"))


NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""
