"""Writing the mart and its side tables (S4-S10, G12 load audit).

The warehouse dropped and recreated tables and updated them in place. Parquet tables cannot be
updated, so every "update" here is a projection written as a new table version. A full refresh
replaces the whole table, a refresh of some years only their partitions. Written tables also serve as lineage cuts:
reports that share a mart read it back instead of recomputing it, and a lost executor then
costs one stage, not the whole job.

:func:`publish_table` never takes a table away from its readers. A load is written beside the
others; a table of the session catalogue lists the partitions that count, new and kept ones; and the
public name, a view, is pointed at it. That last step alone makes a load visible, all at once. A
run that fails before it leaves the old rows readable.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType, TimestampType

from staffmart.config import LOAD_OK, LOAD_PROBLEM
from staffmart.session import warehouse_path
from staffmart.sources import storage

AUDIT_SCHEMA = StructType(
    [
        StructField("status", StringType(), False),
        StructField("ts", TimestampType(), False),
        StructField("rijen", LongType(), True),
        StructField("tabel", StringType(), True),
        StructField("controles", MapType(StringType(), LongType()), True),
    ]
)


def publish_mart(mart: DataFrame, path: str, partition_by: str = "jaar", only_its_years: bool = False) -> None:
    """Drop and recreate, partitioned by year. With ``only_its_years`` the years present in
    ``mart`` are replaced and the others stay.

    A plain ``repartition(year)`` would send a whole year (with two report years: half the
    mart) through one task; the ``rebalance`` hint clusters rows by year but lets AQE split each
    year into advisory-sized tasks, so files are neither tiny nor one per year.
    """
    (
        mart.hint("rebalance", partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_its_years else "static")
        .partitionBy(partition_by)
        .parquet(path)
    )


def published(spark: SparkSession, table: str) -> dict[str, str]:
    """What :func:`publish_table` noted with a table's current version; empty if there is none."""
    if not spark.catalog.tableExists(table):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _listed(spark: SparkSession, version: str | None) -> list[tuple[str, ...]]:
    """Partition values (the load last) of a version's table."""
    if not version or not spark.catalog.tableExists(version):
        return []
    return [tuple(part.split("=", 1)[1] for part in r["partition"].split("/")) for r in spark.sql(f"SHOW PARTITIONS {version}").collect()]


def publish_table(df: DataFrame, base: str, table: str, partition_by: Sequence[str] = ("jaar",), only_its_partitions: bool = False,
                  emptied: Sequence[tuple] = (), notes: dict[str, str] | None = None) -> DataFrame:
    """S5 without a gap: write ``df`` under ``<base>/<table>`` beside earlier loads, then point the
    view ``table`` at it. With ``only_its_partitions`` the partitions present in ``df`` are replaced
    and the others stay, their files untouched (those of ``emptied`` go even if ``df`` has no row
    of them); otherwise the whole table is. Partition values are plain words and numbers. ``notes``
    become visible with the rows (:func:`published`).

    Files of the version before stay for readers that have begun; older ones go.
    """
    spark, load = df.sparkSession, uuid.uuid4().hex
    path, columns = f"{base}/{table}", [*partition_by, "load"]
    before = published(spark, table)
    if before.get("base") != path:
        before = {}
    # rebalance clusters rows by partition, and AQE splits a large one into advisory-sized tasks
    df.hint("rebalance", *partition_by).withColumn("load", F.lit(load)).write.mode("append").partitionBy(*columns).parquet(path)
    stored = storage.partitions(spark, path, columns)
    new = [p for p in stored if p[-1] == load]
    old = _listed(spark, before.get("version"))
    replaced = {p[:-1] for p in new} | {tuple(map(str, p)) for p in emptied}
    keep = [p for p in old if p[:-1] not in replaced] if only_its_partitions else []
    version = f"{table}_{load}"
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields} | {"load": "string"}
    given = ", ".join(f"`{n}` {types[n]}" for n in [c for c in df.columns if c not in columns] + columns)
    by = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE TABLE {version} ({given}) USING parquet PARTITIONED BY ({by}) LOCATION '{path}'")
    spec = lambda p: "PARTITION (" + ", ".join(f"`{c}` = '{v}'" for c, v in zip(columns, p)) + ")"
    if new or keep:
        spark.sql(f"ALTER TABLE {version} ADD " + " ".join(spec(p) for p in [*new, *keep]))
    notes = {**(notes or {}), "base": path, "version": version, "before": before.get("version", "")}
    told = ", ".join(f"'{k}' = '{v}'" for k, v in notes.items())
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({told}) AS SELECT {', '.join(f'`{c}`' for c in df.columns)} FROM {version}")
    if before.get("before"):
        spark.sql(f"DROP TABLE IF EXISTS {before['before']}")
    needed = {*new, *keep, *old}
    for p in stored:
        if p not in needed:
            storage.delete(spark, "/".join([path, *(f"{c}={v}" for c, v in zip(columns, p))]))
    return spark.table(table)


def append(df: DataFrame, path: str) -> None:
    """``insert into``."""
    df.write.mode("append").parquet(path)


def truncate(spark: SparkSession, path: str, schema: StructType) -> None:
    """Empty the table, keeping its schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared warehouse folder and read it back (cuts the lineage)."""
    path = warehouse_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def update_from(df: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``UPDATE t SET c = u.c FROM t JOIN u ON keys`` as a projection: matched rows take
    the new values, unmatched rows keep theirs, and no row is ever added. Of several updates for
    one key, that with the smallest values counts (NULLs last). Write the result as the next
    table version."""
    values = F.struct(*[x for c in columns for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c).alias(f"_new_{c}"))])
    u = updates.groupBy(*keys).agg(F.min(values).alias("_u")).select(*keys, *[f"_u._new_{c}" for c in columns], F.lit(True).alias("_matched"))
    j = df.join(u, keys, "left")
    out = [
        F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in df.columns
    ]
    return j.select(*out)


def partition_is(columns: Sequence[str], values: Sequence[tuple]) -> Column:
    """Rows of the listed partitions (a NULL value is one of its own); constant, so scans prune by it."""
    one = [functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.lit(x)) for c, x in zip(columns, v)]) for v in values]
    return functools.reduce(operator.or_, one, F.lit(False))


def update_partitions(spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str], updates: DataFrame, keys: list[str], columns: list[str]) -> list[tuple]:
    """S7 on a stored table: :func:`update_from`, rewriting only the partitions with a row that an
    update matches; the files of all others stay. Returns these partitions (there are as many at
    most as the table has). The columns that are set must not be the table's partitions."""
    if set(columns) & set(partition_by):
        raise ValueError("an update in place cannot move rows between partitions")
    stored = spark.read.schema(schema).parquet(path)
    touched = [tuple(r) for r in stored.join(updates.select(*keys), keys, "left_semi").select(*partition_by).distinct().collect()]
    if touched:
        rows = update_from(stored.where(partition_is(partition_by, touched)), updates, keys, columns)
        (rows.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(path))
    return touched


def record_load(spark: SparkSession, audit_path: str, table: str, rows: int | None, ok: bool,
                now: dt.datetime | None = None, figures: dict[str, int] | None = None) -> None:
    """Append one audit row per load, with the feed's status text and the figures that were
    observed while the table was written."""
    stamp = F.lit(now) if now is not None else F.current_timestamp()
    row = spark.range(1).select(F.lit(LOAD_OK if ok else LOAD_PROBLEM).alias("status"), stamp.cast("timestamp").alias("ts"),
                                F.lit(rows).cast("long").alias("rijen"), F.lit(table).alias("tabel"),
                                (F.create_map(*[F.lit(x) for pair in figures.items() for x in pair]) if figures else F.lit(None)).cast("map<string,bigint>").alias("controles"))
    append(row, audit_path)


def load_feed(spark: SparkSession, audit_path: str, n: int = 8) -> DataFrame:
    """Newest audit entries first."""
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit_path).orderBy(F.col("ts").desc()).limit(n)
