"""Packing by power-of-two decomposition.

A document's ids, with an end id, are cut into pieces whose lengths are powers of two: as many of
the longest as fit, then the binary digits of the rest. Each piece is a sequence of its own, so no
sequence crosses documents and nothing is padded; sequences are numbered by length, longest first,
so a training batch takes a run of equal lengths. A task counts its pieces of each length, so a
number is the pieces before that task plus the place inside it: nothing is sorted or shuffled.

Null and empty texts hold the end id alone. Repeated rows are packed as often as they come. Within a
length, sequences are numbered in the order in which the rows lie. An empty table gives no rows.
Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm import chunks
from riskweave.llm.common import checked, give_back, keep_little, prepare, slices
from riskweave.session import materialise

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END = 0
LONGEST = 1024
#: Bytes of text encoded at a time.
SLICE = 5 << 20
#: Chunks remembered and bytes of text encoded at a time by a lean worker: half the memory, twice the time.
LEAN = 50_000, 3 << 19
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, place long"


def lengths_of(tokens: int, longest: int) -> list[int]:
    """Piece lengths of a document, longest first."""
    rest = tokens % longest
    digits = [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]
    return [longest] * (tokens // longest) + digits


def pieces(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    end: int = END,
    longest: int = LONGEST,
    with_ids: bool = True,
    lean: bool = False,
) -> DataFrame:
    """One row a piece: its place in its document, checksum and, if asked for, its ids.

    With the task that cut it, and its place among that task's pieces of its length. ``lean`` is for
    executors whose memory earlier work has taken up; it changes time and memory only.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")

    room, size = LEAN if lean else (chunks.REMEMBERED, SLICE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, met = TaskContext.get().partitionId(), np.zeros(longest.bit_length(), np.int64)
        if lean:
            keep_little()
        give_back()
        for batch in slices(batches, size=size):
            offsets, ids = chunks.encode(batch["text"], vocabulary, end, room)
            tokens = np.diff(offsets)
            plan = [lengths_of(int(n), longest) for n in tokens]
            count = np.fromiter(map(len, plan), np.int64, len(plan))
            length = np.fromiter((x for p in plan for x in p), np.int64, int(count.sum()))
            ends = np.cumsum(length)  # pieces lie one after another, as their documents do
            data = memoryview(ids.astype("<u4").tobytes())
            cuts = zip((ends - length).tolist(), ends.tolist(), strict=True)
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in cuts]
            kind = np.frexp(length)[1] - 1  # the power of two
            order = np.argsort(kind, kind="stable")
            count_of = np.bincount(kind, minlength=len(met))
            place = np.empty(len(kind), np.int64)
            place[order] = np.arange(len(kind)) - np.repeat(np.cumsum(count_of) - count_of - met, count_of)
            met += count_of
            columns = {
                "doc_id": np_take(batch["doc_id"], np.repeat(np.arange(len(count)), count)),
                "start": pa.array(ends - length - np.repeat(offsets[:-1], count)),
                "length": pa.array(length),
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(np.repeat(tokens, count)),
                "task": pa.array(np.full(len(kind), task), pa.int32()),
                "place": pa.array(place),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.astype(np.int32))
                )
            yield pa.RecordBatch.from_pydict(columns)

    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, PIECE + ", ids array<int>" * with_ids)


def np_take(column: pa.Array, index: np.ndarray) -> pa.Array:
    return column.take(pa.array(index)).cast(pa.int64())


def pack(docs: DataFrame, with_ids: bool = True, **settings) -> DataFrame:
    """``pieces`` with ``sequence_id`` (from 0, longest first) and ``offset`` (always 0)."""
    rows = materialise(pieces(docs, with_ids=with_ids, **settings))
    counts = materialise(rows.groupBy("length", "task").agg(F.count("*").alias("n")))
    longer, base = 0, []
    for length, n in sorted(counts.groupBy("length").agg(F.sum("n")).collect(), reverse=True):  # one row a power of two
        base.append((length, longer))
        longer += n
    base = docs.sparkSession.createDataFrame(base, "length long, base long")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    firsts = counts.withColumn("before", before).join(F.broadcast(base), "length")
    firsts = checked(firsts.select("length", "task", (F.col("base") + F.col("before")).alias("first")))
    out = rows.join(firsts, ["length", "task"]).withColumn("sequence_id", F.col("first") + F.col("place"))
    return out.drop("task", "place", "first").withColumn("offset", F.lit(0).cast("long"))
