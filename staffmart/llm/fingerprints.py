"""Homomorphic multiset hash of a document's paragraphs, in DataFrame operations only.

A fingerprint is a wide vector summed over the paragraphs (lines) of a text:

* ``STRONG`` lanes of 32 bits, hashed from each paragraph as a whole and summed modulo 2**32.
  Texts with the same paragraphs in any order agree in them.
* ``LANES`` counting lanes (two to a 64-bit sum, modulo 2**32 each). A paragraph adds, for each of
  its word pairs, one random bit per lane. With n pairs, ``2 * lane - n`` is a sum of random
  signs, so the cosine of two such vectors estimates the cosine of the multisets of pairs.

All lanes are sums, so a paragraph is inserted or deleted by adding or subtracting its own vector
(:func:`insert`, :func:`delete`), and equality does not depend on order.

Neighbours in descending id are found without a global order: ids are cut into ranges at
quantiles, each range also gets a copy of the next range's first row, and a window runs inside
each range. That one exchange also serves the sums and the comparison with the next document.

Defined cases: null text is empty; an empty text is one empty paragraph; null ids come last in
descending order; equal ids are ordered by text; the row after the last is the first, so a single
row is its own neighbour; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEEDS = 2                                  # 64 counting lanes each
LANES, STRONG = 64 * SEEDS, 8
_PAIR = (1 << 32) + 1
_LOW = (1 << 32) - 1


def _paragraph_rows(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One row per pair of neighbouring words in a paragraph; the first word has a pair of its own."""
    paragraphs = df.select(*keys, F.explode(F.split(text, "\n")).alias("_p"))
    words = paragraphs.select(*keys, F.xxhash64("_p").alias("_ph"), F.split("_p", " ").alias("_w"))
    pairs = F.arrays_zip(F.concat(F.array(F.lit("")), F.col("_w")).alias("a"), F.col("_w").alias("b"))
    # the zip is one longer than the words: its last pair has no second word
    return (words.select(*keys, "_ph", F.posexplode(pairs).alias("_i", "_x")).where(F.col("_x.b").isNotNull())
            .select(*keys, "_ph", "_i", F.col("_x.a").alias("_a"), F.col("_x.b").alias("_b")))


def vectors(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys`` beside ``n`` (pairs), ``lanes`` (packed sums) and ``strong`` of each text."""
    rows = _paragraph_rows(df, text, keys)
    hashes = [F.xxhash64(F.lit(s), F.col("_a"), F.col("_b")).alias(f"_h{s}") for s in range(SEEDS)]
    rows = rows.select(*keys, "_i", "_ph", *hashes)
    sums = [F.sum(F.shiftrightunsigned(f"_h{s}", j).bitwiseAND(F.lit(_PAIR))).alias(f"_l{s}_{j}") for s in range(SEEDS) for j in range(32)]
    lane = lambda i: F.shiftrightunsigned(F.xxhash64(F.lit(i // 2), F.col("_ph")), 32 * (i % 2)).bitwiseAND(F.lit(_LOW))
    strong = [F.sum(F.when(F.col("_i") == 0, lane(i)).otherwise(F.lit(0))).alias(f"_s{i}") for i in range(STRONG)]
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums, *strong)
    return out.select(*keys, "n", F.array(*[f"_l{s}_{j}" for s in range(SEEDS) for j in range(32)]).alias("lanes"),
                      F.array(*[F.col(f"_s{i}").bitwiseAND(F.lit(_LOW)) for i in range(STRONG)]).alias("strong"))


def insert(a: Column, b: Column) -> Column:
    """Sum of two vectors (struct n, lanes, strong): the fingerprint of both texts' paragraphs."""
    return F.struct((a["n"] + b["n"]).alias("n"), F.zip_with(a["lanes"], b["lanes"], lambda x, y: x + y).alias("lanes"),
                    F.zip_with(a["strong"], b["strong"], lambda x, y: (x + y).bitwiseAND(F.lit(_LOW))).alias("strong"))


def delete(a: Column, b: Column) -> Column:
    """What is left of ``a`` without the paragraphs of ``b``."""
    return F.struct((a["n"] - b["n"]).alias("n"), F.zip_with(a["lanes"], b["lanes"], lambda x, y: x - y).alias("lanes"),
                    F.zip_with(a["strong"], b["strong"], lambda x, y: (x - y).bitwiseAND(F.lit(_LOW))).alias("strong"))


def text_form(v: Column) -> Column:
    """A vector as a hexadecimal string."""
    wide = lambda xs, n: F.array_join(F.transform(xs, lambda x: F.lpad(F.lower(F.hex(x)), n, "0")), "")
    return F.concat(F.lpad(F.lower(F.hex(v["n"])), 8, "0"), wide(v["strong"], 8), wide(v["lanes"], 16))


def _signs(v: Column) -> Column:
    """The counting lanes as sums of signs."""
    part = lambda shift: F.transform(v["lanes"], lambda x: F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(_LOW)) * 2 - v["n"])
    return F.concat(part(0), part(32))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the sign sums of two vectors, 0 to 1; equal vectors have 1."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, p: s + p)
    x, y = a["signs"], b["signs"]
    cosine = dot(x, y) / F.sqrt(F.greatest(dot(x, x) * dot(y, y), F.lit(1.0)))
    return (F.when((a["n"] == b["n"]) & (a["lanes"] == b["lanes"]) & (a["strong"] == b["strong"]), F.lit(1.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine))))


def with_next(docs: DataFrame, id_col: str, text_col: str, ranges: int) -> DataFrame:
    """doc_id, text and next_text, beside the range and place of each row. Rows marked ``copy``
    repeat the first row of the next range."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = sorted(set(base.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges)))
    bounds = F.array(*[F.lit(int(c)) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    base = base.withColumn("range", F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col("doc_id"))), F.lit(0)))
    # At most `ranges` rows: the largest id of each range, in descending order of ranges.
    tops = [(r["range"], r["top"]) for r in base.groupBy("range").agg(F.max("doc_id").alias("top")).orderBy(F.desc("range")).collect()]
    before = {}                                # top of a range -> the range that it follows
    for (r, _), (_, top) in zip(tops, tops[1:] + tops[:1]):
        before[top] = r
    known = [t for t in before if t is not None]
    after = F.element_at(F.create_map(*[F.lit(x) for t in known for x in (t, before[t])]), F.col("doc_id")) if known else F.lit(None)
    after = F.coalesce(after, F.lit(before.get(None, 0)))
    wanted = F.col("doc_id").isin(known)
    wanted = (wanted | F.col("doc_id").isNull()) if None in before else wanted
    copies = base.where(wanted).withColumn("range", after.cast("int")).withColumn("copy", F.lit(True))
    w = Window.partitionBy("range").orderBy("copy", F.desc_nulls_last("doc_id"), "text")
    return (base.withColumn("copy", F.lit(False)).unionByName(copies)
            .select("*", F.row_number().over(w).alias("place"), F.lead("text").over(w).alias("next_text")))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last third replaced by the start of
    the next document), with the likeness of the two and of neighbours."""
    spark = docs.sparkSession
    ranges = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs, id_col, text_col, ranges)
    n = F.char_length("text")
    k = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - k), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), k))
    texts = rows.select("range", "place", "copy", "doc_id", n.cast("long").alias("n_chars"), F.posexplode(F.array(F.col("text"), edited)).alias("which", "body"))
    texts = texts.select("range", "place", "copy", "doc_id", "n_chars", "which", "body", F.when(F.col("which") == 1, F.sha2("body", 256)).alias("sha"))
    keys = ["range", "place", "copy", "doc_id", "n_chars", "which", "sha"]
    v = vectors(texts, "body", keys)
    own = F.struct("n", "lanes", "strong")
    v = v.select("range", "place", "copy", "doc_id", "n_chars", "which", "sha", own.alias("v"))
    v = v.withColumn("v", F.struct(F.col("v.n"), F.col("v.lanes"), F.col("v.strong"), _signs(F.col("v")).alias("signs")))
    w = Window.partitionBy("range").orderBy("place", "which")
    v = v.select("*", F.lead("v", 1).over(w).alias("edited"), F.lead("v", 2).over(w).alias("next"), F.lead("sha", 1).over(w).alias("edited_sha256"))
    return v.where((F.col("which") == 0) & ~F.col("copy")).select(
        "doc_id", "n_chars", "edited_sha256", text_form(F.col("v")).alias("fingerprint"), text_form(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("v"), F.col("edited")).alias("near_edited"), likeness(F.col("v"), F.col("next")).alias("near_next"))
