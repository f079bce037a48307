"""Helpers the operators share: the shared folder, written tables and code on the workers."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from staffmart.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give this package to the Python workers once per application, wherever the driver runs."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), "staffmart_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: a stage boundary that
    cuts the lineage and survives the loss of an executor."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def input_partitions(df: DataFrame) -> int:
    """Number of input splits of a scan; what shuffles are sized by."""
    return max(1, df.rdd.getNumPartitions())


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, giving the memory that it has freed back to the system when a task
    ends. Workers serve one task after the other, and allocators keep what the largest has freed:
    without this it lies beside the executor's heap for the rest of the application."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)(0)      # glibc has it

    return task


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, one after the other, and each row's offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` bytes of text each (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def record_batch(columns: dict[str, Any], schema: pa.Schema) -> pa.RecordBatch:
    def made(x: Any, kind: pa.DataType) -> pa.Array:
        return x.cast(kind) if isinstance(x, pa.Array) else pa.array(x, kind)

    return pa.RecordBatch.from_arrays([made(columns[f.name], f.type) for f in schema], schema=schema)
