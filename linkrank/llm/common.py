"""Helpers of the operators of this subpackage: shared folder, stored tables, bounded Arrow batches, text access."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, and what lies between it.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of data in one Arrow batch, so that very long texts do not gather in a Python worker.
BATCH_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which executors and driver share; where it is unset, the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("spark.sql.warehouse.dir")
    return str(folder).rstrip("/")


class Work:
    """A new folder of tables in the shared folder. Written tables cut lineage and outlive executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
        bounded_batches(spark)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_BYTES from now on, unless the session has a lower limit."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def _tidy(work: Callable, options: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    try:
        yield from work(batches, **options)
    finally:
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)


def task(work: Callable, **options) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` with its options, for ``mapInArrow``. Python workers live on between tasks; at its end a task gives freed memory back."""
    return partial(_tidy, work, options)


def strings(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    """Texts of a batch, null as the empty text, one at a time."""
    for x in batch.column(column):
        yield x.as_py() or ""


def crc_part(column: str, parts: int):
    """crc32 of an integer id written as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % parts


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.record_batch([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, t.type) for x, t in zip(columns, schema, strict=True)], schema=schema)
