"""Shared small helpers: session settings, byte views of Arrow text, row numbering."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import configure, materialise

# Rows and bytes handed to a Python worker at a time; a worker cuts further by bytes.
BATCH_ROWS = 50_000
BATCH_BYTES = "8m"
SLICE_BYTES = 12 << 20
#: Rows of two or three numbers that may be sent to every executor: some 30 MB.
BROADCAST_ROWS = 1_000_000
# Names of the C library's settings.
M_TRIM_THRESHOLD, M_MMAP_THRESHOLD = -1, -3


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{table}.parquet")


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Gather small batches and cut large ones, to about ``size`` bytes of text; one row at least."""
    held, full = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(False).astype(np.int64))
        begin = 0
        while begin < len(ends):
            done = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + size - full, "right")))
            held.append(batch.slice(begin, stop - begin))
            full += int(ends[stop - 1] - done)
            begin = stop
            if full >= size // 2:
                yield joined(held)
                held, full = [], 0
    if held:
        yield joined(held)


def give_back() -> None:
    """Return memory that a worker's earlier tasks have freed to the system, where it can be told to."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only where the C library knows how
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def keep_little() -> None:
    """From now on a worker's freed memory goes back at once instead of waiting for more work."""
    pa.set_memory_pool(pa.system_memory_pool())
    with suppress(OSError, AttributeError):  # only where the C library knows how
        library = ctypes.CDLL("libc.so.6")
        for setting in (M_TRIM_THRESHOLD, M_MMAP_THRESHOLD):
            library.mallopt(setting, 1 << 20)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by it."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        columns = [table[k].to_numpy() for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        begin = 0
        for cut in cuts.tolist():
            yield table.slice(begin, cut - begin).combine_chunks()
            begin = cut
        held = table.slice(begin)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column, nulls as empty texts; offsets start at 0."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bounds - bounds[0], raw[bounds[0] : bounds[-1]]


def checked(side: DataFrame) -> DataFrame:
    """A narrow table, written out and counted: broadcast up to ``BROADCAST_ROWS``, shuffled beyond."""
    side = materialise(side)
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def part_offsets(totals: DataFrame, part: str, size: str) -> DataFrame:
    """(part, before): sums of the parts before each one. One row a partition is collected."""
    rows = sorted((r[part], r[size]) for r in totals.select(part, size).collect())
    before, out = 0, []
    for key, value in rows:
        out.append((key, before))
        before += value
    return totals.sparkSession.createDataFrame(out, f"{part} long, before long")


def numbered(df: DataFrame, *order, name: str = "position") -> DataFrame:
    """Rows with a gapless number from 0 in the given order: a range partitioning, then offsets."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(placed.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    offsets = part_offsets(placed.groupBy(part).agg(F.count("*").alias("_n")), "_part", "_n")
    row = F.col("_at").bitwiseAND((1 << 33) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row a partition
        .withColumn(name, F.col("before") + row)
        .drop("_part", "_at", "before")
    )
