"""Mixing sources to target weights, in DataFrame operations only.

Words are aggregated per source; the sources share a total by weight, none above a multiple of
its own size (the excess is shared again by weight, until none is above: the level at which
``sum(min(cap, weight * level))`` meets the total). A source's repetition rate is target / size;
each document is emitted floor(rate) times, plus once more if its seeded hash, read as a number
in [0, 1), is below the rate's fraction. The draw depends on id and seed alone, so reruns agree.

Only one row per source passes through the ordered windows. These rows are written, so that Spark
knows their size before it plans the join in which documents meet their source's row.

Defined cases: null text has 0 words; null sources form a source of their own, last in order; a
null id draws like the empty string; repeated rows count and draw each (alike); a source without
words has target 0 and takes nothing; an empty table gives no rows; other columns are kept by
``mix`` and ignored by the digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffmart.llm.common import materialize

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE_PERCENT, CAP = 150, 2
SEED = "mix"


def n_words(text: Column) -> Column:
    # Words are what is left between white-space runs: counted on the text with each word cut to
    # one character, so no list of words is built.
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, WORDS, "x"), r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> the same with weight and target. One row per source."""
    in_order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    pattern = F.array(*[F.lit(int(w)) for w in weights])
    s = sizes.withColumn("weight", F.element_at(pattern, ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int")))
    # Sources fill up in the order of cap / weight. Before a source, `full` is taken by caps and
    # `open` is the weight still sharing the rest.
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    everything = Window.partitionBy(F.lit(1))
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    total = (F.sum("source_size").over(everything) * share_percent).cast("double") / F.lit(100.0)
    s = (s.withColumn("full", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap)
         .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("level", (total - F.col("full").cast("double")) / F.col("open").cast("double"))
         .withColumn("limit", (F.col("source_size") * cap).cast("double")))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("full", "level"))).over(everything)["level"]
    return s.select("source", "source_size",
                    F.coalesce(F.least("limit", level * F.col("weight")), F.col("limit")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """``docs`` as one struct ``row`` beside size, source_size, target and copies."""
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"))
    sizes = (docs.select(F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"))
             .groupBy("source").agg(F.sum("size").alias("source_size")))
    # one row per source, written: Spark knows its size when it plans, and broadcasts it if that is
    # under its threshold, so that documents are not shuffled by source, the most skewed key there is
    targets = materialize(source_targets(sizes, weights, share_percent, cap).withColumnRenamed("source", "target_source"), "mix-targets")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("target_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"row.{id_col}").cast("string"), F.lit("")))), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))
    whole = F.floor(rate)
    return joined.withColumn("copies", (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("long")).select("row", "size", "source_size", "target", "copies")


def digest(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return mixed.select(F.col(f"row.{id_col}").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mixed documents: each row as often as it is taken."""
    return (mixed.where("copies > 0").select(F.col("row"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*"))


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight FROM s),
f AS (SELECT *, 2 * coalesce(sum(source_size) OVER b, 0) AS "full", sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS "open",
        (sum(source_size) OVER () * 150)::DOUBLE / 100.0 AS total
      FROM w WINDOW b AS (ORDER BY source_size::DOUBLE / weight::DOUBLE, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - "full"::DOUBLE) / "open"::DOUBLE AS lev, (2 * source_size)::DOUBLE AS lim FROM f),
c AS (SELECT lev FROM l WHERE lev * weight <= lim ORDER BY "full", lev LIMIT 1),
t AS (SELECT source, source_size, coalesce(least(lim, (SELECT lev FROM c) * weight), lim) AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
        ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS draw
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""
