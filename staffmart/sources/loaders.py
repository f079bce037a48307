"""Reading personnel tables from real storage.

A :class:`SourceMap` maps each logical table to a location: a parquet/ORC path, a catalogue
name (``catalog.schema.table``, so tables of several databases can be combined), or a JDBC
table read in parallel slices of a numeric column. Explicit schemas keep parquet reads free of
inference.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffmart.sources.schemas import SCHEMAS
from staffmart.sources.tables import NAMES, Tables


# bytes of fixed-size types
LENGTHS = {"integer": 4, "long": 8, "double": 8, "float": 4, "date": 4, "timestamp": 8, "timestamp_ntz": 8, "boolean": 1}


@dataclass(frozen=True)
class Location:
    kind: str                      # "parquet" | "orc" | "table" | "jdbc"
    path: str                      # file path, catalogue name, or JDBC table
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class SourceMap:
    locations: dict[str, Location]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        loc = self.locations[name]
        schema = SCHEMAS.get(name)
        if loc.kind in ("parquet", "orc"):
            reader = spark.read.format(loc.kind).options(**loc.options)
            if schema is not None:
                reader = reader.schema(schema)
            return reader.load(loc.path)
        if loc.kind == "table":
            return spark.table(loc.path)
        if loc.kind == "jdbc":
            return read_jdbc(spark, loc.path, **loc.options)
        raise ValueError(f"unknown source kind {loc.kind!r}")

    def tables(self, spark: SparkSession) -> Tables:
        return Tables(**{n: (lambda n=n: self.read(spark, n)) for n in NAMES if n in self.locations})


def read_jdbc(spark: SparkSession, table: str, url: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int = 64,
              **options) -> DataFrame:
    """JDBC read split into ``num_partitions`` range queries on ``partition_column`` (e.g. the
    month id), so the database is read in parallel instead of through one connection."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions)
        )
    return reader.load()


def inventory(tables: dict[str, DataFrame], name_like: str = "%", column_like: str = "%", counts: dict[str, int | None] | None = None) -> DataFrame:
    """Table / column / type / length inventory with row counts, filtered with case-folded
    LIKE and ordered by table.

    Column metadata comes from the schemas (no data read); ``length`` is the bytes of a fixed-size
    type and -1 for strings. Row counts are given (:func:`stored_inventory`), or one aggregation per
    table, unioned into a single job. They are joined on table and its first column's entry, as the
    catalogue joins a table's own index row: a table without a count keeps NULL.
    """
    spark = next(iter(tables.values())).sparkSession
    meta = [
        (t, f.name, f.dataType.simpleString(), LENGTHS.get(f.dataType.typeName(), 16 if f.dataType.typeName() == "decimal" else -1))
        for t, df in tables.items()
        for f in df.schema.fields
    ]
    cols = spark.createDataFrame(meta, "tabel string, kolomnaam string, type string, length int")
    if counts is not None:
        counted = spark.createDataFrame([(t, t, n) for t, n in counts.items()], "tabel string, _index string, rijen long")
    else:
        each = [df.agg(F.count(F.lit(1)).alias("rijen")).select(F.lit(t).alias("tabel"), F.lit(t).alias("_index"), "rijen") for t, df in tables.items()]
        counted = functools.reduce(DataFrame.unionByName, each)
    # two keys: the table, and the index row that carries the table's own name
    out = cols.withColumn("_index", F.col("tabel")).join(counted, ["tabel", "_index"], "left").drop("_index")
    return out.filter(
        F.upper("tabel").like(name_like.upper()) & F.upper("kolomnaam").like(column_like.upper())
    ).distinct().orderBy("tabel", "kolomnaam")


def stored_rows(spark: SparkSession, table: str) -> int | None:
    """The row count that ``ANALYZE TABLE`` left in the catalogue; None if there is none."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    found = re.search(r"(\d+) rows", told.get("Statistics") or "")
    return int(found[1]) if found else None


def stored_inventory(spark: SparkSession, names: dict[str, str], name_like: str = "%", column_like: str = "%") -> DataFrame:
    """S13 from the catalogue alone: columns of its tables and the row counts of their last
    ``ANALYZE TABLE``. No data is read."""
    return inventory({n: spark.table(t) for n, t in names.items()}, name_like, column_like, {n: stored_rows(spark, t) for n, t in names.items()})
