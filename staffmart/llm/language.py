"""Language identification by a linear-chain conditional random field over words.

Each word is labelled with a language. A word's features are its first and last one to three
bytes, its two- and three-byte n-grams at every position, the word itself, and for each language whether the word
is in that language's lexicon; they are hashed into ``FEATURES`` weights per language. Learned
transitions join neighbours, so single words that fit several languages take that of the words
around them, and switches inside a text are followed. The forward-backward algorithm gives each
word's distribution; a text's is their mean. In scripts without spaces between words, pieces of
``POINTS`` code points (punctuation among them) stand for words.

Texts of any length are labelled whole: words are cut into runs of ``RUN`` whose 4 x 4 transfer
products are chained, so that all runs of a block advance together and the result is that of one
pass over the text. Runs are taken in slices of bounded size, forwards and then backwards; between
them only the messages into each run are kept, so memory does not grow with words times languages.

The field is trained on the driver on a bounded sample: up to ``SAMPLE`` documents per language
(those first by a hash of their ids), ``SAMPLE_CHARS`` characters of each, cut into pieces that
are strung together across languages, as code-switched text is. Every language is learned: with
many of them, the sample has about ``SAMPLE_ALL`` documents, ``SAMPLE_LEAST`` of each language at
least, and each step takes a batch of ``BATCH`` words times languages, so that the driver's memory
grows only with the weights, the lexicon and that least sample.

Defined cases: null texts and texts without a letter are ``und`` with score 0; rows with null
lang or null id are not learned from; a null id is not held out; without learnable rows every
text is ``und``; repeated rows are predicted each; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffmart.llm.common import blocks, record_batch, ship_code, text_buffer
from staffmart.llm.spans import LETTERS, fold_case, hash_ranges, mix, prefix_sums, words

SAMPLE, SAMPLE_CHARS, SAMPLE_ALL, SAMPLE_LEAST = 300, 1500, 1 << 13, 16
FEATURES, LEXICON, POINTS, CELLS = 1 << 15, 3000, 2, 1 << 20
# lead byte and range of the next one, besides E3 to E9, of scripts without spaces between words
UNSPACED = ((0xE0, 0xB8, 0xBF), (0xE1, 0x80, 0x82), (0xE1, 0x9E, 0x9F), (0xE1, 0xA5, 0xAA), (0xE2, 0xBA, 0xBF), (0xEF, 0xA4, 0xAB), (0xEF, 0xBC, 0xBE), (0xF0, 0xA0, 0xB3))
SCAN_CELLS = 1 << 21           # words times languages that are worked on at once
RUN, PIECE, CHAIN, BATCH, EPOCHS = 64, 8, 32, 1 << 22, 2
FOLDS, HELD = 3, 1
UNKNOWN = "und"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
DDL = "doc_id long, lang_pred string, score double"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD, F.lit(False))


def cut_unspaced(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with runs of scripts that put no spaces between words (Thai, Lao, Tibetan, Burmese,
    Khmer, Chinese, Japanese) cut into pieces of ``POINTS`` code points."""
    if not len(starts) or not (buf >= 0xE0).any():
        return starts, ends, row
    word = np.zeros(len(buf) + 1, np.int64)
    word[starts] += 1
    word[ends] -= 1
    at = np.flatnonzero((np.cumsum(word[:-1]) > 0) & ((buf & 0xC0) != 0x80))      # code points of words
    at = np.union1d(at, starts)
    x, y = buf[at], buf[np.minimum(at + 1, len(buf) - 1)]
    un = (x >= 0xE3) & (x <= 0xE9)
    for lead, low, high in UNSPACED:
        un |= (x == lead) & (y >= low) & (y <= high)
    if not un.any():
        return starts, ends, row
    owner = np.searchsorted(starts, at, "right") - 1
    new = np.r_[True, (owner[1:] != owner[:-1]) | (un[1:] != un[:-1])]
    opens = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(opens, np.diff(np.r_[opens, len(at)]))
    new |= un & (place % POINTS == 0)
    first, owner = at[new], owner[new]
    return first, np.minimum(np.r_[first[1:], len(buf)], ends[owner]), row[owner]


def word_features(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of words, one word after the other, and each word's offsets. Every word has
    one at least."""
    numbers, owners = [], []
    every, size = np.arange(len(starts)), ends - starts

    def add(first: np.ndarray, last: np.ndarray, kind: int, owner: np.ndarray) -> None:
        h = mix(hash_ranges(sums, first, last) + np.uint64(kind * 0x9E3779B97F4A7C15 % 2**64))
        numbers.append((h % np.uint64(FEATURES)).astype(np.int32))
        owners.append(owner)

    whole = hash_ranges(sums, starts, ends)
    add(starts, ends, 0, every)
    for n in (1, 2, 3):
        ok = every[size >= n]
        add(starts[ok], starts[ok] + n, n, ok)
        add(ends[ok] - n, ends[ok], 3 + n, ok)
    for n in (2, 3):
        count = np.maximum(size - n + 1, 0)
        owner = np.repeat(every, count)
        first = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        add(first, first + n, 5 + n, owner)
    if len(lexicon):
        low, count = np.searchsorted(lexicon, whole), np.searchsorted(lexicon, whole, "right")
        count -= low
        owner = np.repeat(every, count)
        k = listed[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(owner))]
        numbers.append((mix((k + 77).astype(np.uint64)) % np.uint64(FEATURES)).astype(np.int32))
        owners.append(owner)
    owner = np.concatenate(owners)
    return np.concatenate(numbers)[np.argsort(owner, kind="stable")], np.r_[0, np.cumsum(np.bincount(owner, minlength=len(starts)))]


def weight_sums(weights: np.ndarray, f: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each word's summed weights, some features at a time, however long the words are."""
    out = np.zeros((len(offsets) - 1, weights.shape[1]))
    step = max(1, CELLS // weights.shape[1])
    for i in range(0, len(f), step):
        part = f[i:i + step]
        low, high = np.searchsorted(offsets, i, "right"), np.searchsorted(offsets, i + len(part))
        out[low - 1:high] += np.add.reduceat(weights[part], np.r_[0, offsets[low:high] - i])
    return out


def forward_backward(e: np.ndarray, first: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (n, t, L) and summed pair marginals (L, L) of equally long chains with emission
    factors ``e``."""
    n, t, k = e.shape
    a, b, scale = np.empty_like(e), np.empty_like(e), np.empty((n, t))
    x = first * e[:, 0]
    for i in range(t):
        if i:
            x = (a[:, i - 1] @ trans) * e[:, i]
        scale[:, i] = x.sum(axis=1)
        a[:, i] = x / scale[:, i, None]
    b[:, -1] = 1
    pairs = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        y = e[:, i + 1] * b[:, i + 1] / scale[:, i + 1, None]
        pairs += trans * (a[:, i].T @ y)
        b[:, i] = y @ trans.T
    return a * b, pairs


@dataclass
class Field:
    """Weights of the random field; ``listed`` has the language of each entry of ``lexicon``."""

    languages: list[str]
    weights: np.ndarray
    first: np.ndarray
    trans: np.ndarray
    lexicon: np.ndarray
    listed: np.ndarray

    def emissions(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Emission factors of words; equal words are worked out once."""
        sums = prefix_sums(buf)
        _, at, back = np.unique(hash_ranges(sums, starts, ends), return_index=True, return_inverse=True)
        out = np.empty((len(at), len(self.languages)))
        to = np.cumsum(ends[at] - starts[at])
        i = 0
        while i < len(at):
            part = at[i:max(i + 1, int(np.searchsorted(to, (to[i - 1] if i else 0) + (1 << 17), "right")))]
            out[i:i + len(part)] = weight_sums(self.weights, *word_features(sums, starts[part], ends[part], self.lexicon, self.listed))
            i += len(part)
        out = np.exp(np.clip(out - out.max(axis=1, keepdims=True), -40, 0))
        return out[back]

    def marginals(self, e: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Each word's distribution from all words' emission factors; ``row`` is each word's text,
        ascending."""
        out = np.empty_like(e)
        for a, b, p in self.scan(row, lambda a, b: e[a:b]):
            out[a:b] = p
        return out

    def text_sums(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, rows: int, cells: int = SCAN_CELLS) -> np.ndarray:
        """Each text's summed distributions of its words."""
        out = np.zeros((rows, len(self.languages)))

        def emitted(a: int, b: int) -> np.ndarray:
            base = starts[a]
            return self.emissions(buf[base:ends[b - 1]], starts[a:b] - base, ends[a:b] - base)

        for a, b, p in self.scan(row, emitted, cells):
            for j in range(p.shape[1]):
                out[:, j] += np.bincount(row[a:b], weights=p[:, j], minlength=rows)
        return out

    def scan(self, row: np.ndarray, emitted: Callable[[int, int], np.ndarray], cells: int = SCAN_CELLS) -> Iterator[tuple[int, int, np.ndarray]]:
        """Distributions of the words [a, b), in slices of whole runs from the last to the first.

        ``emitted(a, b)`` gives words' emission factors. A first pass takes the message into every
        run from the left, a second one, backwards, that from the right and the words between; each
        holds one slice of words, and of the rest only the messages (a row of languages per run)."""
        n, k = len(row), len(self.languages)
        new_row = np.r_[True, row[1:] != row[:-1]]
        begin = np.flatnonzero(new_row)
        place = np.arange(n) - np.repeat(begin, np.diff(np.r_[begin, n]))
        head = np.flatnonzero(place % RUN == 0)                    # first word of each run
        del place, begin
        size, opens = np.diff(np.r_[head, n]), new_row[head]
        left, right = np.ones((len(head), k)), np.ones((len(head), k))
        level = lambda y: y / np.maximum(y.max(axis=-1, keepdims=True), 1e-300)
        step_ = max(1, cells // (RUN * k))
        slices = [(r, min(r + step_, len(head))) for r in range(0, len(head), step_)]

        def opened(first: int, last: int) -> _Runs:
            a, b = int(head[first]), int(head[last - 1] + size[last - 1])
            return _Runs(self, emitted(a, b), head[first:last] - a, size[first:last], opens[first:last])

        def ranks(first: int, last: int, starts: np.ndarray) -> Iterator[np.ndarray]:
            """Runs of a slice by their distance from a start, from 1 on."""
            at = np.flatnonzero(starts)
            rank = np.arange(last - first) - np.repeat(at, np.diff(np.r_[at, last - first]))
            order = np.argsort(rank, kind="stable")
            cuts = np.searchsorted(rank[order], np.arange(1, int(rank.max()) + 2))
            for low, high in zip(cuts[:-1], cuts[1:]):
                yield first + order[low:high]

        carry = runs = None
        for first, last in slices:
            runs = None                                             # one slice at a time
            runs = opened(first, last)
            if first and not opens[first]:
                left[first] = level(left[first - 1] @ carry)
            for to in ranks(first, last, np.r_[True, opens[first + 1:last]]):
                left[to] = level(np.einsum("ni,nij->nj", left[to - 1], runs.product[to - 1 - first]))
            carry = runs.product[-1]
        for first, last in reversed(slices):
            if last < len(head):
                runs = None
                runs = opened(first, last)                          # the last slice is still at hand
            # backwards, a run starts anew if the next one opens a text (or lies beyond the slice)
            starts = np.r_[True, opens[first + 1:last][::-1]]
            for to in ranks(0, last - first, starts):
                to = last - 1 - to
                right[to] = level(np.einsum("nij,nj->ni", runs.product[to + 1 - first], right[to + 1]))
            if first and not opens[first]:
                right[first - 1] = level(runs.product[0] @ right[first])
            yield int(head[first]), int(head[last - 1] + size[last - 1]), runs.words(left[first:last], right[first:last])


class _Runs:
    """Runs of words side by side, and the product of each run's transfer matrices."""

    def __init__(self, field: Field, e: np.ndarray, head: np.ndarray, size: np.ndarray, opens: np.ndarray):
        self.field, self.n, self.opens = field, len(e), opens
        self.at = head[:, None] + np.arange(RUN)
        self.inside = np.arange(RUN) < size[:, None]
        # words past a run's end change nothing
        self.x = np.where(self.inside[:, :, None], e[np.minimum(self.at, self.n - 1)], 1.0)
        k = e.shape[1]
        self.product = np.broadcast_to(np.eye(k), (len(head), k, k))
        for i in range(RUN):
            self.product = self.step(i, self.product)

    def step(self, i: int, m: np.ndarray) -> np.ndarray:
        """Message rows ``m`` (runs, r, k) moved over word i of each run."""
        moved = m @ self.field.trans
        if i == 0:
            moved = np.where(self.opens[:, None, None], m.sum(axis=2, keepdims=True) / m.shape[2] * self.field.first, moved)
        moved = moved * self.x[:, i, None, :]
        moved = np.where(self.inside[:, i, None, None], moved, m)
        return moved / np.maximum(moved.max(axis=(1, 2), keepdims=True), 1e-300)

    def words(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Each word's distribution, given the messages into the runs."""
        forward = np.empty((RUN, *left.shape))
        m = left[:, None, :]
        for i in range(RUN):
            m = self.step(i, m)
            forward[i] = m[:, 0]
        out = np.empty((self.n, left.shape[1]))
        b = right
        for i in range(RUN - 1, -1, -1):
            ok = self.inside[:, i]
            both = forward[i] * b
            out[self.at[ok, i]] = both[ok] / np.maximum(both[ok].sum(axis=1, keepdims=True), 1e-300)
            back = (self.x[:, i] * b) @ self.field.trans.T
            b = np.where(ok[:, None], back / np.maximum(back.max(axis=1, keepdims=True), 1e-300), b)
        return out


def train(texts: list[str], labels: list[str], languages: list[str], rounds: int = 60, seed: int = 7, rate: float = 0.3, ridge: float = 1e-4, batch: int = BATCH) -> Field:
    """Maximum likelihood with a quadratic penalty, by adaptive gradient steps."""
    k = len(languages)
    column = pa.array(texts, pa.string())
    buf, offsets = text_buffer(column)
    buf = fold_case(buf)
    starts, ends, row = cut_unspaced(buf, *words(buf, offsets, LETTERS))
    number = {x: i for i, x in enumerate(languages)}
    gold = np.array([number[x] for x in labels])[row]
    sums = prefix_sums(buf)
    h = hash_ranges(sums, starts, ends)
    _, at, word = np.unique(h, return_index=True, return_inverse=True)
    keys, listed = [], []
    by_language = np.argsort(gold, kind="stable")
    for lang, part in enumerate(np.split(by_language, np.cumsum(np.bincount(gold, minlength=k))[:-1])):
        ids, n = np.unique(h[part], return_counts=True)
        keys.append(ids[np.argsort(-n, kind="stable")[:LEXICON]])
        listed.append(np.full(len(keys[-1]), lang))
    keys, listed = np.concatenate(keys), np.concatenate(listed)
    order = np.argsort(keys, kind="stable")
    keys, listed = keys[order], listed[order]
    # pieces of a few words, shuffled over all texts, make chains that switch language
    rng = np.random.default_rng(seed)
    pieces = np.array_split(np.arange(len(starts)), max(1, len(starts) // PIECE))
    order = np.concatenate([pieces[i] for i in rng.permutation(len(pieces))])
    if len(order):
        order = np.resize(order, -(-len(order) // CHAIN) * CHAIN).reshape(-1, CHAIN)    # the last chain goes on with the first words
    f, to = word_features(sums, starts[at], ends[at], keys, listed)
    weights, first, trans = np.zeros((FEATURES, k)), np.zeros(k), np.zeros((k, k))
    squares = [np.full_like(w, 1e-8) for w in (weights, first, trans)]
    chains = max(1, batch // (CHAIN * k))
    parts = -(-len(order) // chains)
    for turn in range(max(rounds, EPOCHS * parts) if parts > 1 else rounds * parts):
        some = order[turn % parts * chains:][:chains]
        labels_ = gold[some]
        ids, word_ = np.unique(word[some], return_inverse=True)
        word_ = word_.ravel()
        size = np.diff(to)[ids]
        ends_ = np.cumsum(size)
        part = f[np.repeat(to[ids] - (ends_ - size), size) + np.arange(int(ends_[-1]))]
        e = weight_sums(weights, part, np.r_[0, ends_])[word_].reshape(*some.shape, k)
        e = np.exp(np.maximum(e - e.max(axis=2, keepdims=True), -300))
        p, pairs = forward_backward(e, np.exp(first - first.max()), np.exp(trans - trans.max()))
        p /= p.sum(axis=2, keepdims=True)
        off = -p
        np.put_along_axis(off, labels_[:, :, None], np.take_along_axis(off, labels_[:, :, None], 2) + 1, 2)
        first_off = off[:, 0].sum(axis=0)
        off = off.reshape(-1, k)
        seen_pairs = np.bincount((labels_[:, :-1] * k + labels_[:, 1:]).ravel(), minlength=k * k).reshape(k, k)
        g = np.stack([np.bincount(part, weights=np.repeat(np.bincount(word_, weights=off[:, j], minlength=len(ids)), size), minlength=FEATURES) for j in range(k)], axis=1)
        grads = (g - ridge * len(word_) * weights / 100, first_off, seen_pairs - pairs)
        for w, d, sq in zip((weights, first, trans), grads, squares):
            d = d / len(word_)
            sq += d * d
            w += rate * d / np.sqrt(sq)
    return Field(languages, weights, np.exp(first - first.max()), np.exp(trans - trans.max()), keys, listed)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE) -> Field | None:
    """A field trained on a bounded sample of the rows with a language that are not held out."""
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.char_length("text") > 0) & ~held_out(F.col("doc_id"))))
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return None
    per_language = min(per_language, max(SAMPLE_LEAST, SAMPLE_ALL // len(counts)))
    order = F.xxhash64("doc_id", F.lit("language"))
    # about twice the sample by hash threshold, then the first of each language
    share = F.element_at(F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, 2.0 * per_language / r["count"])))]), F.col("lang"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(1_000_000)) / 1e6 < share
    start = F.pmod(order, F.greatest(F.char_length("text") - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    picked = rows.where(part).select("lang", F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("text"), order.alias("o"))
    picked = picked.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("o"))).where(F.col("place") <= per_language).orderBy("o").collect()
    kept: dict[str, list[str]] = {}
    for r in picked:
        kept.setdefault(r["lang"], []).append(r["text"])
    languages = sorted(kept)
    texts = [(t, x) for x in languages for t in kept[x]]
    return train([t for t, _ in texts], [x for _, x in texts], languages) if texts else None


def identify(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every text."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        # messages take languages squared for each run, the rest languages for each word
        k = len(field.languages) if field is not None else 1
        limit = max(1 << 12, (2 << 20) * 8 // max(8, k) * 64 // max(64, k))
        for batch in batches:
            for block in blocks(batch, "text", limit):
                buf, offsets = text_buffer(block.column(1))
                buf = fold_case(buf)
                starts, ends, row = cut_unspaced(buf, *words(buf, offsets, LETTERS))
                langs, score = np.full(block.num_rows, UNKNOWN, object), np.zeros(block.num_rows)
                if field is not None and len(starts):
                    n = np.bincount(row, minlength=block.num_rows)
                    mean = field.text_sums(buf, starts, ends, row, block.num_rows) / np.maximum(n, 1)[:, None]
                    letter = np.bincount(row, weights=buf[starts] < 128, minlength=block.num_rows) > 0
                    for i in np.flatnonzero((n > 0) & ~letter).tolist():      # no word starts with an ASCII letter
                        letter[i] = any(c.isalpha() for c in block.column(1)[i].as_py())
                    best = mean.argmax(axis=1)
                    langs[letter] = np.array(field.languages, object)[best[letter]]
                    score[letter] = np.clip(mean[np.flatnonzero(letter), best[letter]], 0, 1)
                yield record_batch({"doc_id": block.column(0), "lang_pred": langs, "score": score}, SCHEMA)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, DDL)


def identify_documents(docs: DataFrame) -> DataFrame:
    """Predictions for every document by a field learned from those that are not held out."""
    found = identify(docs, learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
