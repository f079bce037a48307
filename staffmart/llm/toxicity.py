"""Toxic passages by maximum-scoring segments.

Tokens are runs of letters in lower case; punctuation and spaces outside ASCII end a run like those
inside it. In scripts that put no spaces between words, every two neighbouring code points are a
token, so that a word is met wherever it stands in a sentence. A token's score is its log-odds of standing in a toxic
rather than a clean text, by the numbers of texts that hold it, with Dirichlet priors: the base rate is the prior of a token's first
four bytes, these are the prior of its first six, these of the word. A constant is taken off, so
that clean text drifts down; a word that a text repeats scores as neutral from then on.

One linear scan finds every maximal scoring segment of a text (segments that cannot be made
better by longer or shorter ones). Extreme-value calibration makes scores comparable over text
lengths: for a text of n tokens, ``lam * score - ln(K * n)`` has a Gumbel law on clean texts;
``lam`` solves mean(exp(lam * s)) = 1 over clean tokens and K is fitted to the best segments of
clean texts. A logistic model over the best segment and the sum of all significant ones gives
the probability of label 1.

Labels are learned from a bounded sample (``SAMPLE_TOXIC``, ``SAMPLE_CLEAN`` documents, in the
order of a hash of their ids); the calibration is fitted on one half of it with the log-odds of
the other. The
token table holds every token that ``LEAST_COUNT`` of the sampled texts have; it and the sample's
ids are what is broadcast.

Defined cases: null or empty texts have no segment and the score of such texts; labels with null
id or value are not learned from, of repeated labels the larger counts; without labels of both
kinds every score is 0; repeated rows are scored each; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffmart.llm.common import blocks, materialize, ship_code, text_buffer, tidied
from staffmart.llm.language import UNSPACED
from staffmart.llm.spans import LETTERS, fold_case, hash_ranges, prefix_sums, words

SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 12000
LEAST_COUNT = 3
PRIOR, DRIFT, LOWEST = 2.0, 0.7, -1.5
FOLDS = 5
_GAMMA = 0.5772156649015329
COUNT_DDL = "k long, half int, toxic long, clean long"
SCORE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()),
                          ("passages", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])))])
SCORE_DDL = "doc_id long, score double, predicted int, passages array<struct<first: long, last: long, score: double>>"


def only_letters(buf: np.ndarray) -> np.ndarray:
    """The text with spaces in place of characters outside ASCII that are no letters: Latin-1 signs,
    general and CJK punctuation, full-width signs, symbols. Positions stay."""
    if len(buf) < 2 or not (buf >= 0xC2).any():
        return buf
    out = buf.copy()
    lead = np.flatnonzero(buf >= 0xC2)
    x, y, z = buf[lead], *(buf[np.minimum(lead + i, len(buf) - 1)] for i in (1, 2))
    two = (x == 0xC2) & ~np.isin(y, (0xAA, 0xB5, 0xBA)) | (x == 0xC3) & np.isin(y, (0x97, 0xB7))
    three = (x == 0xE2) & ((y <= 0xAF) | (y == 0xB8) | (y == 0xB9))
    three |= (x == 0xE3) & (y == 0x80) & ~((z >= 0x85) & (z <= 0x87))
    three |= (x == 0xEF) & ((y == 0xB8) | (y == 0xBF) | (y == 0xBC) & ((z <= 0x8F) | (z >= 0x9A) & (z <= 0xA0) | (z >= 0xBB)) | (y == 0xBD) & ((z == 0x80) | (z >= 0x9B) & (z <= 0xA5)))
    for at, n in ((lead[two], 2), (lead[three], 3)):
        for i in range(n):
            out[np.minimum(at + i, len(buf) - 1)] = 0x20
    return out


def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of all tokens, in order."""
    text = only_letters(buf)
    starts, ends, row = words(text, offsets, LETTERS)
    if not len(starts) or not (text >= 0xE0).any():
        return starts, ends, row
    inside = np.zeros(len(text) + 1, np.int64)
    inside[starts] += 1
    inside[ends] -= 1
    at = np.union1d(np.flatnonzero((np.cumsum(inside[:-1]) > 0) & ((text & 0xC0) != 0x80)), starts)      # code points of words
    x, y = text[at], text[np.minimum(at + 1, len(text) - 1)]
    un = (x >= 0xE3) & (x <= 0xE9)
    for first, low, high in UNSPACED:
        un |= (x == first) & (y >= low) & (y <= high)
    if not un.any():
        return starts, ends, row
    owner = np.searchsorted(starts, at, "right") - 1
    follows = np.r_[owner[1:] == owner[:-1], False]                  # the next code point is of the same word
    end = np.where(follows, np.r_[at[1:], 0], ends[owner])           # of the code point
    pair = un & follows & np.r_[un[1:], False]                       # begins a pair
    alone = un & ~pair & ~np.r_[False, pair[:-1]]
    spaced = ~un & np.r_[True, (owner[1:] != owner[:-1]) | un[:-1]]  # begins a stretch of letters of other scripts
    stretch = np.cumsum(un | spaced)                                 # its last code point ends it
    last = np.searchsorted(stretch, stretch, "right") - 1
    take = pair | alone | spaced
    stop = np.where(pair, end[np.minimum(np.arange(len(at)) + 1, len(at) - 1)], np.where(alone, end, end[last]))
    return at[take], stop[take], row[owner[take]]


def token_keys(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys (words, first six bytes, first four bytes) of all tokens, and starts, ends and row."""
    starts, ends, row = tokens(buf, offsets)
    if not len(starts):
        return np.zeros((3, 0), np.uint64), starts, ends, row
    sums = prefix_sums(fold_case(buf))
    salt = lambda i: np.uint64(0x632BE59BD9B4E019 * (i + 1) % 2**64)
    keys = [hash_ranges(sums, starts, ends), *(hash_ranges(sums, starts, np.minimum(ends, starts + n)) ^ salt(n) for n in (6, 4))]
    return np.stack(keys), starts, ends, row


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, toxic: int, clean: int) -> DataFrame:
    """Text and label of a bounded number of labelled documents that are not held out."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).where("label_id is not null and toxic is not null")
             .where(~held_out(F.col("label_id"))).groupBy("label_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64("label_id", F.lit("toxic"))
    few = lambda value, n: marks.where(F.col("toxic") == value).orderBy(order).limit(n)
    chosen = few(1, toxic).unionByName(few(0, clean)).withColumn("half", F.pmod(F.xxhash64("label_id", F.lit("half")), F.lit(2)).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("text", "toxic", "half")


def count_tokens(rows: DataFrame) -> DataFrame:
    """Numbers of toxic and clean texts that hold each key."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = [batch.filter(pa.compute.equal(batch.column(2), h)) for h in (0, 1)]
            for half, block in ((h, b) for h in (0, 1) for b in blocks(halves[h], "text")):
                keys, _, _, row = token_keys(*text_buffer(block.column(0)))
                label = block.column(1).to_numpy(zero_copy_only=False)
                k, back = np.unique(keys.ravel(), return_inverse=True)
                # a key counts once in a text, however often the text repeats it
                pair = np.unique(back * block.num_rows + np.tile(row, 3))
                back, row = pair // block.num_rows, pair % block.num_rows
                toxic = np.bincount(back, weights=label[row], minlength=len(k)).astype(np.int64)
                both = np.bincount(back, minlength=len(k))
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(np.full(len(k), half, np.int32)), pa.array(toxic), pa.array(both - toxic)],
                                                 names=["k", "half", "toxic", "clean"])

    part = lambda name, *on: F.sum(F.when(F.lit(True) if not on else F.col("half") == 0, F.col(name)).otherwise(0))
    return (rows.select("text", "toxic", "half").mapInArrow(run, COUNT_DDL).groupBy("k")
            .agg(part("toxic").alias("toxic"), part("clean").alias("clean"), part("toxic", 0).alias("toxic0"), part("clean", 0).alias("clean0")))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """Every maximal scoring segment (first, last, score) of a sequence, in linear time."""
    found: list[list] = []          # first, last, sum before, sum up to the end, previous with a smaller sum before
    total = 0.0
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    for i in np.flatnonzero(scores > 0).tolist():
        total = float(sums[i])
        first, last, left, right = i, i, total, float(sums[i + 1])
        at = len(found) - 1
        while True:
            while at >= 0 and found[at][2] >= left:
                at = found[at][4]
            if at < 0 or found[at][3] >= right:
                found.append([first, last, left, right, at])
                break
            first, left = found[at][0], found[at][2]     # join with everything since that segment
            before = found[at][4]
            del found[at:]
            at = before
    return [(a, b, r - lft) for a, b, lft, r, _ in found]


@dataclass
class Model:
    """What scoring needs: sorted keys with their counts, and the calibration."""

    keys: np.ndarray
    weight: np.ndarray      # occurrences of each key
    toxic: np.ndarray       # of these, in toxic texts
    base: float
    lam: float = 1.0
    log_k: float = 0.0
    coef: tuple[float, float, float] = (-50.0, 0.0, 0.0)

    def rates(self, keys: np.ndarray) -> np.ndarray:
        """Smoothed toxic rate of tokens from their (3, n) keys."""
        rate = np.full(keys.shape[1], self.base)
        for level in (2, 1, 0):
            at = np.minimum(np.searchsorted(self.keys, keys[level]), len(self.keys) - 1)
            hit = self.keys[at] == keys[level]
            t, n = np.where(hit, self.toxic[at], 0.0), np.where(hit, self.weight[at], 0.0)
            rate = (t + PRIOR * rate) / (n + PRIOR)
        return rate

    def scores(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(keys.shape[1], LOWEST)
        rate = self.rates(keys)
        return np.maximum(LOWEST, np.log(rate / (1 - rate)) - math.log(self.base / (1 - self.base)) - DRIFT)

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> tuple[float, float]:
        """The best segment's and the sum of all significant segments' calibrated scores."""
        bits = [self.lam * s - self.log_k - math.log(max(n, 1)) for _, _, s in found]
        return math.log1p(max(0.0, *bits, 0.0)), math.log1p(sum(b for b in bits if b > 0))

    def probability(self, evidence: tuple[float, float]) -> float:
        z = self.coef[0] + self.coef[1] * evidence[0] + self.coef[2] * evidence[1]
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _per_document(model: Model, block: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Token scores, starts and ends of each row's tokens."""
    buf, offsets = text_buffer(block.column(block.schema.get_field_index("text")))
    keys, starts, ends, row = token_keys(buf, offsets)
    scores = model.scores(keys)
    # a word that the text has had before tells nothing new: it scores as neutral
    new = np.zeros(len(row), bool)
    _, group = np.unique(keys[0], return_inverse=True)
    new[np.unique(group * block.num_rows + row, return_index=True)[1]] = True
    scores = np.where(new, scores, np.minimum(scores, -DRIFT))
    cuts = np.searchsorted(row, np.arange(block.num_rows + 1))
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        yield scores[a:b], starts[a:b] - offsets[i], ends[a:b] - offsets[i]


def _statistics(rows: DataFrame, model: Model) -> DataFrame:
    """Per sampled text: label, tokens, best segment and segments; token scores as a histogram."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                out = []
                for label, (s, _, _) in zip(block.column(1).to_pylist(), _per_document(model, block)):
                    values, n = np.unique(np.round(s, 1), return_counts=True)
                    out.append({"toxic": label, "n": len(s), "found": [x[2] for x in segments(s)], "values": values.tolist(), "counts": n.tolist()})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("toxic", pa.int32()), ("n", pa.int64()), ("found", pa.list_(pa.float64())), ("values", pa.list_(pa.float64())), ("counts", pa.list_(pa.int64()))]))

    return rows.select("text", "toxic").mapInArrow(run, "toxic int, n long, found array<double>, values array<double>, counts array<long>")


def fit_lambda(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of mean(exp(lam * s)) = 1."""
    p = counts / counts.sum()
    if not (values > 0).any() or p @ values >= 0:
        return 1.0
    low, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if p @ np.exp(np.minimum(mid * values, 500)) > 1 else (mid, high)
    return low


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Model:
    """Fit the token table and the calibration on a bounded sample."""
    ship_code(docs.sparkSession)
    rows = materialize(sample(docs, labels, toxic, clean), "toxic-sample")
    table = count_tokens(rows).where(F.col("toxic") + F.col("clean") >= LEAST_COUNT).toArrow().to_pandas()
    keys = table["k"].to_numpy(np.int64).view(np.uint64)
    table, keys = table.iloc[(order := np.argsort(keys))], keys[order]
    size = {(r[0], r[1]): float(r[2]) for r in rows.groupBy("toxic", "half").count().collect()}
    base = lambda *halves: min(0.9, max(1e-4, sum(size.get((1, h), 0.0) for h in halves) / max(1.0, sum(size.get((x, h), 0.0) for x in (0, 1) for h in halves))))
    column = lambda name: table[name].to_numpy(np.float64)
    # calibrated on one half with the token table of the other; scoring then uses all the sample
    model = Model(keys, column("toxic0") + column("clean0"), column("toxic0"), base(0))
    stats = _statistics(rows.where("half = 1"), model).toArrow().to_pandas()
    y = stats["toxic"].to_numpy(np.float64)
    if not len(y) or y.min() == y.max() or not len(keys):
        return model
    ok = stats[stats["toxic"] == 0]
    values, back = np.unique(np.concatenate(ok["values"].to_list()), return_inverse=True)
    counts = np.bincount(back, weights=np.concatenate(ok["counts"].to_list()))
    if len(values):
        model.lam = fit_lambda(values, counts)
    best = np.array([max(f, default=0.0) for f in ok["found"]])
    model.log_k = float(np.mean(model.lam * best - np.log(np.maximum(ok["n"], 1)))) - _GAMMA
    x = np.array([(1.0, *model.evidence([(0, 0, s) for s in f], n)) for f, n in zip(stats["found"], stats["n"])])
    return Model(keys, column("toxic") + column("clean"), column("toxic"), base(0, 1), model.lam, model.log_k, tuple(fit_logistic(x, y)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted and the significant passages (byte positions) of every text."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for block in blocks(batch, "text"):
                out = []
                for doc_id, (s, starts, ends) in zip(block.column(0).to_pylist(), _per_document(model, block)):
                    found = segments(s)
                    floor = model.log_k + math.log(max(len(s), 1))
                    p = model.probability(model.evidence(found, len(s)))
                    out.append({"doc_id": doc_id, "score": p, "predicted": int(p >= 0.5),
                                "passages": [{"first": int(starts[a]), "last": int(ends[b]), "score": v} for a, b, v in found if model.lam * v > floor]})
                yield pa.RecordBatch.from_pylist(out, schema=SCORE_SCHEMA)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCORE_DDL)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, whose text is not predicted toxic."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])
            keep = [model.probability(model.evidence(segments(s), len(s))) < 0.5
                    for block in blocks(texts, "text") for s, _, _ in _per_document(model, block)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document with a model learned from the labels that are not held out."""
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
