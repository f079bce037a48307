"""T1 as a stream: a rolling per-key buffer of the newest ``n`` values.

Each micro-batch is folded into the buffers by the rule of the batch form, ``row_number() <= n`` per
key over (old buffers ∪ batch), all on the JVM: Spark limits every key to ``n`` rows per task before
the shuffle, so a key that holds a third of a batch ships at most ``n`` rows per task, and no state
grows beyond ``n`` rows per key.

Buffers lie in buckets by a hash of the key, ``buffers/bucket=<b>/batch=<id>`` under the run folder
(shared storage on a cluster). A batch reads and rewrites only the buckets of its own keys; all
others keep their files. The newest version of a bucket is the largest batch id among its folders, so
finding it lists folders and reads no data. After a batch, a bucket that it wrote keeps its last two
versions: the new one, and the one before for readers under way and for a replay.

A batch reads versions below its own id and overwrites its own, so a replayed batch gives the same
version again, and late rows take their place by time. Readers see committed batches only (Spark's
own commit log). A trigger takes at most ``max_files_per_trigger`` files, so a backlog is worked
off in bounded steps.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType, TimestampNTZType

from staffmart.functions.formatting import clamp
from staffmart.session import ensure_checkpoint_dir
from staffmart.sources import storage
from staffmart.sources.schemas import RAW_SCHEMAS

MAX_FILES = 64
BUCKETS = 64
KEPT = 2                      # versions of a bucket
ROWS = StructType(
    [
        StructField("user_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("event_id", LongType()),
        StructField("value", DoubleType()),
    ]
)
STORED = StructType([*ROWS.fields, StructField("bucket", IntegerType()), StructField("batch", IntegerType())])


def bucket_of(key: str = "user_id", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def newest(rows: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` rows per key (equal rows count once: a file read twice adds nothing)."""
    order = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return rows.dropDuplicates(["user_id", "ts", "event_id"]).withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")


def versions(spark: SparkSession, run_dir: str, buckets: list[int] | None = None) -> dict[int, list[int]]:
    """Batch ids of each bucket's stored versions, newest first, from folder names alone."""
    base = f"{run_dir}/buffers"
    found = [int(n.split("=")[1]) for n in storage.names(spark, base)] if buckets is None else buckets
    return {b: sorted((int(x) for (x,) in storage.partitions(spark, f"{base}/bucket={b}", ["batch"])), reverse=True) for b in found}


def _read(spark: SparkSession, run_dir: str, newest_of: dict[int, int]) -> DataFrame | None:
    """Rows of one version per bucket."""
    base = f"{run_dir}/buffers"
    places = [f"{base}/bucket={b}/batch={v}" for b, v in sorted(newest_of.items())]
    return spark.read.schema(STORED).option("basePath", base).parquet(*places).select(*ROWS.names) if places else None


def fold_batch(batch: DataFrame, batch_id: int, run_dir: str, n: int, buckets: int = BUCKETS) -> list[int]:
    """Write the versions after a micro-batch; returns the buckets of its keys."""
    spark = batch.sparkSession
    rows = batch.select(*ROWS.names)
    touched = sorted(r[0] for r in rows.select(bucket_of(buckets=buckets)).distinct().collect())   # at most ``buckets``
    if not touched:
        return []
    stored = versions(spark, run_dir, touched)
    old = _read(spark, run_dir, {b: max(v) for b in touched if (v := [x for x in stored[b] if x < batch_id])})
    kept = newest(rows if old is None else rows.unionByName(old), n)
    (kept.withColumn("bucket", bucket_of(buckets=buckets)).withColumn("batch", F.lit(batch_id)).repartition("bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{run_dir}/buffers"))
    for b in touched:
        for version in [x for x in stored[b] if x < batch_id][KEPT - 1:]:
            storage.delete(spark, f"{run_dir}/buffers/bucket={b}/batch={version}")
    return touched


def run_rolling_stream(spark: SparkSession, events_dir: str, n: int, *, file_glob: str = "*.parquet", run_dir: str | None = None,
                       max_files_per_trigger: int = MAX_FILES, buckets: int = BUCKETS) -> str:
    """Process every file present in a folder (``availableNow``); return the run folder. Running
    again with the same ``run_dir`` resumes."""
    base = run_dir or f"{ensure_checkpoint_dir(spark)}/rolling/{uuid.uuid4().hex}"
    reader = spark.readStream.schema(RAW_SCHEMAS["events"]).option("pathGlobFilter", file_glob).option("maxFilesPerTrigger", max_files_per_trigger)
    # event time stays a local (zone-less) timestamp: ordering never depends on a session zone
    rows = reader.parquet(events_dir).select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "value")
    query = (
        rows.writeStream.foreachBatch(lambda batch, batch_id: fold_batch(batch, batch_id, base, n, buckets) and None)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return base


def current_buffers(spark: SparkSession, run_dir: str) -> DataFrame:
    """Every key's buffer after the last committed batch: x = position oldest first, y clamped to [0, 100]."""
    commits = [int(x) for x in storage.names(spark, f"{run_dir}/checkpoint/commits") if x.isdigit()]
    last = max(commits) if commits else None
    newest_of = {b: max(v) for b, found in versions(spark, run_dir).items() if (v := [x for x in found if last is None or x <= last])}
    rows = _read(spark, run_dir, newest_of)
    if rows is None:
        rows = spark.createDataFrame([], ROWS)
    oldest_first = Window.partitionBy("user_id").orderBy("ts", "event_id")   # at most n rows per key
    return rows.select(
        "user_id",
        (F.row_number().over(oldest_first) - 1).cast("int").alias("x"),
        clamp("value").alias("y"),
        "event_id",
    )


def rolling_stream_result(spark: SparkSession, events_dir: str, n: int, **kw) -> DataFrame:
    return current_buffers(spark, run_rolling_stream(spark, events_dir, n, **kw))
