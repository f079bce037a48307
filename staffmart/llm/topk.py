"""Exact top-k inner products by vector-approximation files.

Vectors become integers, floor(scale * x). Candidates are dealt into groups by a hash of their
components, so that equal vectors meet and only those that can be among any k best stay. A group's
approximation is written once: every dimension is cut into ``CELLS`` cells of equal width, a power
of two that keeps nearly all components inside, and ``TAILS`` cells at either end whose width grows
with their distance; a vector is its cell numbers, a byte each, beside the cells' borders.

1. Scan: a block of queries meets the groups of a slice one after the other, and keeps per query the
   k highest lower bounds so far. Cell numbers are multiplied as they are, bytes by bytes
   (``bytewise``): that gives an upper bound with the cells' width, and the query's own rounding to
   bytes, added. Only vectors that it leaves above the k-th highest lower bound get bounds from
   their cells' borders; vectors far outside of the bytes always get those. A cell of width one
   holds a single integer, so bounds of vectors inside such cells meet. Of many pairs, those with a
   few groups are scanned first, and give all tasks a lower bound to begin with.
2. The k-th highest lower bound over all slices cuts the survivors once more.
3. Only survivors' exact vectors are fetched, by row number, and read in descending order of upper
   bound until the k-th score found is above every bound that is left.

Bounds are doubles with their rounding added; scores are exact for components of any size (in
doubles while that is exact, else in Python integers). A task holds one slice's cells and one block
of queries, both of bounded size, whatever the size of the table.

Defined cases: vectors that are null, empty or hold null or non-finite components (also after
scaling) take no part, nor do rows with a null id; only vectors of equal length are compared;
repeated rows are candidates each, a query that repeats answers once, and never finds rows of its
own id; ties go to the smaller id; scores beyond a long are held at its ends and tie there; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staffmart.llm.bytewise import bytewise
from staffmart.llm.common import materialize, ship_code
from staffmart.llm.vectors import matrix, products, scaled, to_binary

K, SCALE, QUERY_EVERY = 5, 256, 50
GROUP_ROWS, QUERY_ROWS, CELLS, TAILS, SALTS, SALTED_ROWS = 4096, 1 << 16, 248, 4, 8, 1024
#: Bytes of the cells of a slice and of a block of queries; pairs of a task; pairs from which a few
#: groups are scanned first, and how many; queries and vectors
#: that are multiplied at once; components whose borders are looked up at once; survivors held.
SLICE_BYTES, BLOCK_BYTES, TASK_PAIRS, FIRST_PAIRS, FIRST_GROUPS = 32 << 20, 32 << 20, 1 << 36, 1 << 38, 16
ROWS, COLUMNS, LOOKED_UP, HELD = 2048, 512, 1 << 20, 1 << 21
#: Steps that a vector's components may lie beyond the cells of one step, to be multiplied as bytes.
LIMIT, SEEN, BEYOND = 2.0**63, -2**31, 64
VECTOR_DDL = "vec_id long, dim int, vec binary, candidate boolean"
FILE_DDL = "g int, dim int, place binary, ids binary, cells binary, borders binary"
BLOCK_DDL = "b int, dim int, q binary, query_ids binary, queries binary, sure binary"
FOUND_DDL = "q long, place long, upper double, lower double"
SCORE_DDL = "q long, vec_id long, score long"


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int, k: int = K) -> DataFrame:
    """vec_id, dim and the integer components (as doubles) of the vectors that take part, and
    whether they stay candidates beside the equal vectors of their batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, lengths, flat = scaled(batch.column(1), scale)
            ids, vec = batch.column(0).take(pa.array(row)), to_binary(flat, lengths)
            same = vec.dictionary_encode()
            stays = np.ones(len(vec), bool)
            if len(same.dictionary) < len(vec):
                stays[:] = False
                stays[distinct_enough(pd.DataFrame({"vec_id": ids.to_numpy(), "vec": same.indices.to_numpy()}), k).index] = True
            yield pa.RecordBatch.from_arrays([ids, pa.array(lengths, pa.int32()), vec, pa.array(stays)], names=["vec_id", "dim", "vec", "candidate"])

    given = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return given.where("vec_id is not null").mapInArrow(run, VECTOR_DDL)


def cell_starts(n: int) -> np.ndarray:
    """Where cells begin, in steps: ``n`` of one step around zero, tails growing sixteenfold."""
    tail = n // 2 * 16.0 ** np.arange(TAILS + 1)
    return np.concatenate((-tail[:0:-1], np.arange(-(n // 2), n // 2), tail[:-1]))


def cells(vectors: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers of each component, and the borders: number of cells, step, least and largest
    value of every dimension. A step is the least power of two that leaves few components to the
    tails, so that a few components far out leave no wide cell to others."""
    few = max(1, round(0.06 * len(vectors) / vectors.shape[1]))
    usual = np.sort(np.abs(vectors), axis=0)[max(0, len(vectors) - 1 - few)]
    step = 2.0 ** np.maximum(0, np.frexp(usual / (n // 2 - 0.5))[1])
    at = np.floor(vectors / step)
    inside = (at >= -(n // 2)) & (at < n // 2)
    number = (np.where(inside, at, 0) + n // 2 + TAILS).astype(np.uint8)
    number[~inside] = np.maximum(0, np.searchsorted(cell_starts(n), at[~inside], "right") - 1)
    return number, np.stack((np.full(len(step), float(n)), step, vectors.min(axis=0), vectors.max(axis=0)))


def edges(borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest integer of every cell, a row per dimension."""
    n, step, least, largest = borders[0, 0], *borders[1:, :, None]
    starts = cell_starts(int(n))
    low, high = starts * step, np.append(starts[1:], np.inf) * step - 1
    low[:, 0] = -np.inf
    return np.maximum(low, least), np.minimum(high, largest)


def beyond_bytes(number: np.ndarray, borders: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How many steps, all in all, the components of each vector may lie outside of the cells of one step."""
    n = int(borders[0, 0])
    row, d = np.nonzero((number < TAILS) | (number >= TAILS + n))
    cell, step = number[row, d], borders[1, d]
    far = np.maximum(high[d, cell] / step - (n // 2 - 1), -(n // 2) - low[d, cell] / step)
    return np.bincount(row, far, len(number))


def rounding(sizes: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """What rounding may take from a bound of queries with these sums of absolute components:
    nothing while doubles are exact."""
    with np.errstate(over="ignore"):
        mass = sizes * np.abs(borders[2:]).max()
    return np.where(mass < 2.0**51, 0, 1e-12 * mass)


def held(upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds within a long's ends, also where they went beyond doubles."""
    return np.clip(np.nan_to_num(upper, nan=np.inf, posinf=np.inf, neginf=-np.inf), -LIMIT, LIMIT), np.clip(np.nan_to_num(lower, nan=-np.inf, posinf=np.inf, neginf=-np.inf), -LIMIT, LIMIT)


def all_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of each query's product with every vector between low and high."""
    with np.errstate(all="ignore"):
        middle, around = queries @ ((low + high) / 2).T, np.abs(queries) @ ((high - low) / 2).T + slack[:, None]
        return held(middle + around, middle - around)


def bounds(queries: np.ndarray, number: np.ndarray, borders: np.ndarray, highest: bool) -> np.ndarray:
    """Upper (or lower) bounds of the inner products of every query and vector, rounding included."""
    low, high = (x[np.arange(number.shape[1]), number] for x in edges(borders))
    return all_bounds(queries, low, high, rounding(np.abs(queries).sum(axis=1), borders))[not highest]


def pair_bounds(queries: np.ndarray, number: np.ndarray, low: np.ndarray, high: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of each query's product with the vector beside it."""
    at = number + np.arange(number.shape[1]) * low.shape[1]
    with np.errstate(all="ignore"):
        one, other = queries * low.take(at), queries * high.take(at)
        return held(np.maximum(one, other).sum(axis=1) + slack, np.minimum(one, other).sum(axis=1) - slack)


class Block:
    """A block of queries, and what is left of the groups that it has met."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, k: int, sure: np.ndarray | None = None):
        self.queries, self.query_ids, self.k = queries, query_ids, k
        self.lower, self.sure = np.full((len(queries), k), -np.inf), np.full(len(queries), -np.inf) if sure is None else sure
        self.found: list[tuple[np.ndarray, ...]] = []
        self.held, self.step, self.sizes = 0, None, np.abs(queries).sum(axis=1)

    def rounded(self, step: np.ndarray) -> None:
        """Queries in units of the steps, rounded to bytes, and what that and the cells' width may
        take from a bound."""
        if self.step is not None and (self.step == step).all():
            return
        self.step, n = step, len(self.queries)
        self.bytes, self.unit, self.off, self.width, self.mass, self.most = np.empty(self.queries.shape, np.int8), *(np.empty(n) for _ in range(5))
        for at in range(0, n, ROWS):
            some = slice(at, at + ROWS)
            with np.errstate(all="ignore"):
                exact = self.queries[some] * step
                self.most[some] = np.abs(exact).max(axis=1)
                self.unit[some] = np.maximum(1, self.most[some] / 127)
                near = np.rint(np.nan_to_num(exact / self.unit[some, None], nan=0, posinf=127, neginf=-127))
                self.bytes[some] = near
                self.off[some] = np.sqrt(((exact - near * self.unit[some, None]) ** 2).sum(axis=1))
                self.width[some] = np.maximum(exact, 0) @ ((step - 1) / step)
                self.mass[some] = np.abs(exact).sum(axis=1)

    def needed(self, longest: float, beyond: float) -> np.ndarray:
        """The least product of bytes that a survivor among vectors of at most that length can have,
        if their components lie at most ``beyond`` steps, all in all, outside of the bytes."""
        with np.errstate(all="ignore"):
            large = np.where(self.mass < 2.0**43, 0, 1e-9 * (np.abs(self.sure) + 256 * self.mass))
            least = (self.sure - self.width - self.off * (longest * (1 + 1e-9)) - self.most * (beyond * (1 + 1e-9)) - large) / self.unit
            least -= 1e-6 * np.abs(least) * ((self.off > 0) | (beyond > 0)) + 0.5
            least[~(self.sure > -LIMIT) | np.isnan(least)] = -np.inf
        return np.clip(np.ceil(least), SEEN + 256, 2.0**31 - 256).astype(np.int32)

    def meet(self, place: np.ndarray, ids: np.ndarray, number: np.ndarray, borders: np.ndarray) -> None:
        """Survivors of one group."""
        n, dim = int(borders[0, 0]), number.shape[1]
        self.rounded(borders[1])
        low, high = edges(borders)
        slack = rounding(self.sizes, borders)
        beyond = beyond_bytes(number, borders, low, high)
        plain, near, odd = (np.flatnonzero(x) for x in (beyond == 0, (beyond > 0) & (beyond <= BEYOND), ~(beyond <= BEYOND)))
        if dim >= 1 << 17:      # sums of products beyond 32 bits
            plain, near, odd = plain[:0], near[:0], np.arange(len(ids))

        def look(q: np.ndarray, at: np.ndarray) -> None:
            some = max(1, LOOKED_UP // dim)
            for i in range(0, len(q), some):
                a, b = q[i:i + some], at[i:i + some]
                self.take(a, place[b], ids[b], *pair_bounds(self.queries[a], number[b], low, high, slack[a]))

        for columns in (x[start:start + COLUMNS] for x in (plain, near) for start in range(0, len(x), COLUMNS)):
            few = 2 * self.k
            code = np.clip(number[columns].astype(np.int16) - (TAILS + n // 2), -(n // 2), n // 2 - 1).astype(np.int8)
            reach = float(np.sqrt((code.astype(np.float64) ** 2).sum(axis=1).max())), float(beyond[columns].max())
            multiply, left, need = bytewise(code), [], self.needed(*reach)
            for at in range(0, len(self.queries), ROWS):
                product = multiply(self.bytes[at:at + ROWS])
                new = np.flatnonzero(self.sure[at:at + ROWS] == -np.inf)
                if len(new) and len(columns) > few:    # the nearest give a first k-th lower bound
                    first = np.argpartition(product[new], -few, axis=1)[:, -few:]
                    look(at + np.repeat(new, few), columns[first.ravel()])
                    product[new[:, None], first] = SEEN
                    need = self.needed(*reach)
                least = need[at:at + ROWS].astype(product.dtype)
                row = np.flatnonzero(product.max(axis=1) >= least)
                if len(row):
                    which, column = np.divmod(np.flatnonzero(product[row] >= least[row, None]), len(columns))
                    left.append((at + row[which], columns[column]))
            if left:
                look(*(np.concatenate(x) for x in zip(*left)))
        for start in range(0, len(odd), COLUMNS):
            columns = odd[start:start + COLUMNS]
            between = [x[np.arange(dim), number[columns]] for x in (low, high)]
            for at in range(0, len(self.queries), ROWS):
                some = slice(at, at + ROWS)
                upper, lower = all_bounds(self.queries[some], *between, slack[some])
                least = self.sure[some].copy()
                new = np.flatnonzero(least == -np.inf)
                if len(new) and len(columns) > self.k:
                    others = np.where(self.query_ids[at + new, None] == ids[columns], -np.inf, lower[new])
                    least[new] = np.partition(others, -self.k, axis=1)[:, -self.k]
                row, column = np.nonzero(upper >= least[:, None])
                self.take(at + row, place[columns[column]], ids[columns[column]], upper[row, column], lower[row, column])

    def take(self, q: np.ndarray, place: np.ndarray, ids: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        """Keep these pairs, each met once, unless their bound is too low already."""
        keep = (upper >= self.sure[q]) & (self.query_ids[q] != ids)
        q, place, upper, lower = q[keep], place[keep], upper[keep], lower[keep]
        if not len(q):
            return
        self.found.append((q, place, upper, lower))
        self.held += len(q)
        order = np.lexsort((-lower, q))
        q, lower = q[order], lower[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        many = np.diff(np.r_[first, len(q)])
        rank, slot = np.arange(len(q)) - np.repeat(first, many), np.repeat(np.arange(len(first)), many)
        new = np.full((len(first), self.k), -np.inf)
        new[slot[rank < self.k], rank[rank < self.k]] = lower[rank < self.k]
        best = np.sort(np.concatenate((self.lower[q[first]], new), axis=1), axis=1)[:, -self.k:]
        self.lower[q[first]], self.sure[q[first]] = best, np.maximum(self.sure[q[first]], best[:, 0])
        if self.held > 2 * HELD:
            self.cut()

    def cut(self) -> None:
        """Drop what has meanwhile got below the k-th highest lower bound."""
        q, place, upper, lower = (np.concatenate(x) for x in zip(*self.found))
        keep = upper >= self.sure[q]
        self.found, self.held = [(q[keep], place[keep], upper[keep], lower[keep])], int(keep.sum())

    def left(self) -> tuple[np.ndarray, ...]:
        """Query row, place and bounds of what is left, handed over."""
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        self.cut()
        out, self.found, self.held = self.found[0], [], 0
        return out


def survivors(queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, number: np.ndarray, borders: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per query: its number, and the vectors of one group that may be among its k best, with their
    bounds."""
    block = Block(queries, query_ids, k)
    block.meet(np.arange(len(ids)), ids, number, borders)
    q, at, upper, lower = block.left()
    for i in np.unique(q):
        yield int(i), at[q == i], upper[q == i], lower[q == i]


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)


class Reader:
    """The k best of one query, from exact vectors that come in descending order of bound."""

    def __init__(self, query: np.ndarray, k: int):
        self.query, self.k = query, k
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, object)
        self.read, self.certain = 0, False

    def take(self, ids: np.ndarray, vectors: list[bytes], upper: np.ndarray) -> None:
        """Read on, until the k-th score is above every bound that is left."""
        at = 0
        while at < len(ids) and not self.certain:
            if len(self.ids) == self.k and self.scores[-1] > upper[at]:
                self.certain = True
                break
            to = min(len(ids), at + max(self.k, self.read))
            scores = np.concatenate((self.scores, products(self.query, matrix(vectors[at:to]))[0].astype(object)))
            found = np.concatenate((self.ids, ids[at:to]))
            top = best_of(scores, found, self.k)
            self.ids, self.scores = found[top], scores[top]
            self.read, at = self.read + to - at, to


def distinct_enough(a: pd.DataFrame, k: int) -> pd.DataFrame:
    """Rows that can be among any query's k best: of equal vectors those of the k + 1 smallest ids
    (one may be the query's own), and k of each id, since only the id decides between them."""
    a = a.sort_values("vec_id", kind="stable")
    copies = a.groupby("vec", sort=False)
    few_ids = copies["vec_id"].rank("dense") <= k + 1
    return a[few_ids & (a.groupby(["vec", "vec_id"], sort=False).cumcount() < k)]


def approximation_file(vectors: DataFrame, groups: int, k: int, n_cells: int = CELLS) -> DataFrame:
    """The cells of all vectors, a row per group: what is scanned instead of the vectors."""

    def pack(a: pd.DataFrame) -> pd.DataFrame:
        a = distinct_enough(a, k)
        number, borders = cells(matrix(list(a["vec"])), n_cells)
        as_bytes = lambda x: [x.tobytes()]
        return pd.DataFrame({"g": [a["g"].iat[0]], "dim": [a["dim"].iat[0]], "place": as_bytes(a["place"].to_numpy("<i8")), "ids": as_bytes(a["vec_id"].to_numpy("<i8")),
                             "cells": as_bytes(number), "borders": as_bytes(borders.astype("<f8"))})

    group = F.pmod(F.xxhash64("vec"), F.lit(groups)).cast("int")
    return vectors.where("candidate").select("vec_id", "dim", "vec", "place", group.alias("g")).groupBy("g", "dim").applyInPandas(pack, FILE_DDL)


def query_blocks(asked: DataFrame, blocks: int, parts: int) -> DataFrame:
    """The queries and scores that their k best are sure to reach, at most ``parts`` rows per block
    and dimension."""

    def pack(a: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"b": [a["part"].iat[0] % blocks], "dim": [a["dim"].iat[0]], "q": [a["q"].to_numpy("<i8").tobytes()], "query_ids": [a["vec_id"].to_numpy("<i8").tobytes()],
                             "queries": [b"".join(a["vec"])], "sure": [a["sure"].to_numpy("<f8").tobytes()]})

    return asked.withColumn("part", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks * parts)).cast("int")).groupBy("part", "dim").applyInPandas(pack, BLOCK_DDL)


def dealt_evenly(spark: SparkSession, n: int) -> list[int]:
    """A number for each of ``n`` partitions that a repartition by it puts there, alone."""
    places = spark.range(64 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("place")).agg(F.min("id").alias("id"))
    return [row["id"] for row in places.orderBy("place").collect()]


def scan(file: DataFrame, blocks: DataFrame, n_slices: int, n_blocks: int, k: int) -> DataFrame:
    """Survivors of every block of queries in every slice of groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, asked, block, numbers = None, [], None, None

        def told() -> Iterator[pa.RecordBatch]:
            q, place, upper, lower = block.left()
            for at in range(0, len(q), 1 << 16):
                some = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (numbers[q[some]], place[some], upper[some], lower[some])], names=["q", "place", "upper", "lower"])

        for batch in batches:
            for i in range(batch.num_rows):
                t, dim, kind = (batch.column(c)[i].as_py() for c in range(3))
                x, ids, rows, borders = (np.frombuffer(batch.column(c)[i].as_buffer(), of) for c, of in ((3, "<i8"), (4, "<i8"), (5, np.uint8), (6, "<f8")))
                if task != (t, dim):
                    if block is not None:
                        yield from told()
                    task, asked, block = (t, dim), [], None
                if kind == 0:
                    asked.append((x, ids, rows.view("<f8").reshape(-1, dim), borders))
                    continue
                if block is None and asked:
                    numbers, query_ids, queries, sure = (np.concatenate(y) for y in zip(*asked))
                    block, asked = Block(queries, query_ids, k, sure), []
                if block is not None:
                    block.meet(x, ids, rows.reshape(-1, dim), borders.reshape(-1, dim))
                    if block.held > HELD:
                        block.cut()
                        if block.held > HELD:     # survivors by the million: handed on as they are
                            yield from told()
        if block is not None:
            yield from told()

    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tasks = F.lit(dealt_evenly(file.sparkSession, n_slices * n_blocks)).cast("array<bigint>")      # longs, as they were hashed
    task = (F.element_at(tasks, (F.col("slice") * n_blocks + F.col("b") + 1).cast("int"))).alias("t")
    left = blocks.withColumn("slice", each(n_slices)).select(task, "dim", F.lit(0).alias("kind"), F.col("q").alias("x"), F.col("query_ids").alias("ids"), F.col("queries").alias("rows"), F.col("sure").alias("borders"))
    right = file.withColumn("slice", F.col("g") % n_slices).withColumn("b", each(n_blocks)).select(task, "dim", F.lit(1).alias("kind"), F.col("place").alias("x"), "ids", F.col("cells").alias("rows"), "borders")
    return left.unionByName(right).repartition(n_slices * n_blocks, "t").sortWithinPartitions("t", "dim", "kind").mapInArrow(run, FOUND_DDL)


def top_k(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_every: int = QUERY_EVERY, k: int = K, scale: int = SCALE,
          group_rows: int = GROUP_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k highest scores among all other rows."""
    spark = rows.sparkSession
    ship_code(spark)
    vectors = materialize(integer_vectors(rows, id_col, vector_col, scale, k).withColumn("place", F.monotonically_increasing_id()), "topk-vectors")
    is_query = F.col("vec_id") % query_every == 0
    asked = materialize(vectors.where(is_query).select("vec_id", "dim", "vec").distinct().withColumn("q", F.monotonically_increasing_id()), "topk-queries")
    total, bytes_ = vectors.where("candidate").agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("dim").cast("long")), F.lit(0))).first()
    n_asked, asked_bytes = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("dim") * F.lit(8).cast("long")), F.lit(0))).first()
    n_groups = max(1, math.ceil(total / group_rows))
    n_blocks = max(1, math.ceil(n_asked / query_rows), math.ceil(asked_bytes / BLOCK_BYTES))
    n_tasks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(total * n_asked / TASK_PAIRS))
    n_slices = min(n_groups, max(math.ceil(n_tasks / n_blocks), math.ceil(bytes_ / SLICE_BYTES)))
    file = materialize(approximation_file(vectors, n_groups, k), "topk-cells")
    parts = max(1, math.ceil(n_asked / n_blocks / GROUP_ROWS))
    told, first, head = asked.withColumn("sure", F.lit(float("-inf"))), None, F.col("g") < FIRST_GROUPS
    if total * n_asked > FIRST_PAIRS and n_groups > FIRST_GROUPS:     # a few groups' k-th lower bounds, for all tasks to begin with
        few = min(FIRST_GROUPS, max(1, math.ceil(spark.sparkContext.defaultParallelism / n_blocks)))
        first = materialize(scan(file.where(head), query_blocks(told, n_blocks, parts), few, n_blocks, k), "topk-first")
        nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("lower")))
        sure = first.withColumn("nth", nth).where(F.col("nth") == k).select("q", F.col("lower").alias("sure"))
        told, file = asked.join(sure, "q", "left").fillna(float("-inf"), ["sure"]), file.where(~head)
    left = materialize(scan(file, query_blocks(told, n_blocks, parts), n_slices, n_blocks, k), "topk-bounds")
    left = left.unionByName(first) if first is not None else left
    by_query = Window.partitionBy("q")
    every = by_query.orderBy(F.desc("lower")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = left.withColumn("sure", F.nth_value("lower", k).over(every)).where("sure is null or upper >= sure").withColumn("n", F.count(F.lit(1)).over(by_query)).select("q", "place", "upper", "n")
    # exact vectors of the survivors alone
    read = left.join(vectors.select("place", "vec_id", "vec"), "place").join(asked.select("q", F.col("vec").alias("query")), "q")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one: tuple[int, int, Reader] | None = None

        def told() -> pa.RecordBatch:
            q, _, reader = one
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(reader.ids), q)), pa.array(reader.ids), pa.array(reader.scores.astype(np.int64))], names=["q", "vec_id", "score"])

        for batch in batches:
            q, ids, upper, salt = (batch.column(i).to_numpy() for i in (0, 1, 3, 5))
            vectors, query = batch.column(2).to_pylist(), batch.column(4)
            cut = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (salt[1:] != salt[:-1])]) if len(q) else []
            for a, b in zip(cut, [*cut[1:], len(q)]):
                if one is None or one[:2] != (q[a], salt[a]):
                    if one is not None:
                        yield told()
                    one = int(q[a]), int(salt[a]), Reader(matrix([query[int(a)].as_py()]), k)
                one[2].take(ids[a:b], vectors[a:b], upper[a:b])
        if one is not None:
            yield told()

    # a query that very many vectors may answer is read by several tasks
    salt = F.when(F.col("n") > SALTED_ROWS, F.pmod(F.hash("place"), F.lit(SALTS))).otherwise(0)
    read = read.withColumn("salt", salt).repartition("q", "salt").sortWithinPartitions("q", "salt", F.desc("upper"))
    found = read.select("q", "vec_id", "vec", "upper", "query", "salt").mapInArrow(score, SCORE_DDL)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k).join(asked.select("q", F.col("vec_id").alias("query_id")), "q")
            .select("query_id", "rank", "vec_id", "score"))


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
