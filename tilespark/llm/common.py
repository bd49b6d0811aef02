"""Helpers shared by the corpus operators: reading, shared storage and vectorised text views."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word pattern of every contract, for Spark's and DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a worker turns into arrays at once; bounds its memory whatever the batch holds.
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def shared_path(spark: SparkSession) -> str:
    """A fresh path in the folder that driver and executors share."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if sc._jsc.sc().getCheckpointDir().isEmpty():  # one machine, as in tests
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="tilespark-"))
        base = sc._jsc.sc().getCheckpointDir().get()
    return f"{base.rstrip('/')}/tilespark-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table in the shared folder, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    path = shared_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's offsets in them, without copies; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def give_back() -> None:
    """Return freed memory to the system: a worker lives on for other tasks, and others need it meanwhile."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def cut(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds at most limit bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offs = utf8(batch.column(batch.schema.get_field_index(text)))[1]
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """cut() of all batches of a task, which gives its memory back when it ends."""
    give_back()  # what a task before this one left
    try:
        yield from cut(batches, text, limit)
    finally:
        give_back()


_WORD_BITS = 32_768  # of the bitmap functions


def marked_slots(rows: DataFrame, slots: int) -> np.ndarray:
    """rows (slot): which of so many slots occur. The driver gets as many bits, packed where they are counted."""
    at = F.col("slot")
    cells = rows.groupBy(F.floor(at / _WORD_BITS).alias("word")).agg(F.bitmap_construct_agg(at % _WORD_BITS).alias("bits"))
    marked = np.zeros((-(-slots // _WORD_BITS), _WORD_BITS), bool)
    for row in cells.collect():  # slots / _WORD_BITS rows at most
        marked[row.word] = np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little")
    return marked.reshape(-1)[:slots]


def sha_hex(column: str = "text"):
    return F.sha2(F.coalesce(F.col(column), F.lit("")), 256)
