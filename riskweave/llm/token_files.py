"""Token ids as frequency ranks in byte-aligned variable-length coding.

Ids are replaced by their rank in the corpus (0: most frequent), and every rank takes 1 to 4
bytes. Lengths go to control bytes, four 2-bit lengths in each, kept apart from the data bytes, so
a decoder reads control bytes through a 256-row table instead of testing each byte. One row a
document: `control` and `data`, with its place `start` among all ids. Rows lie in ascending doc_id
order in folders `part=0, 1, ...`; `rank.parquet` holds rank -> id.

Null and empty texts hold the end id alone. A null doc_id sorts first. Repeated rows are written
as often as they come; rows that share a doc_id take any order. An empty table gives no rows. Only
doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm import chunks
from riskweave.llm.common import byte_view, part_offsets, prepare, slices
from riskweave.session import materialise, shared_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END = 2

# Of each control byte: the four lengths it names.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.uint8)


def encode_ids(docs: DataFrame, vocabulary: str, end: int | None) -> DataFrame:
    """(part, doc_id, before, n_tokens, ids), ordered by doc_id over and within parts.

    ``before``: ids earlier in the part. Ids are little-endian, 4 bytes each. Each part ends with a
    row of its ids' counts: n_tokens is null, and ids holds pairs (id, count).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, seen, part = 0, np.zeros(0, np.int64), None
        for batch in slices(batches):
            part = batch["part"][0].as_py()
            offsets, ids = chunks.encode(batch["text"], vocabulary, end)
            data = pa.py_buffer(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_pydict({
                "part": batch["part"],
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "before": pa.array(before + offsets[:-1]),
                "n_tokens": pa.array(np.diff(offsets)),
                "ids": pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(batch), [None, pa.py_buffer(4 * offsets), data]
                ).cast(pa.binary()),
            })
            before += int(offsets[-1])
            counts = np.bincount(ids)
            if len(counts) > len(seen):
                seen, counts = counts, seen
            seen[: len(counts)] += counts
        used = np.flatnonzero(seen)
        if len(used):
            pairs = np.stack((used, seen[used]), 1).astype("<i8").tobytes()
            row = {"part": [part], "doc_id": [None], "before": [None], "n_tokens": [None], "ids": [pairs]}
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(row.items(), kinds, strict=True)})

    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    rows = rows.withColumn("part", F.spark_partition_id().cast("long"))
    return rows.mapInArrow(run, "part long, doc_id long, before long, n_tokens long, ids binary")


def ranks(encoded: DataFrame) -> DataFrame:
    """(id, n, rank): rank 0 is the most frequent id; ties by id. As many rows as ids in use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = byte_view(batch["ids"])[1].view("<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_pydict({"id": pa.array(pairs[:, 0]), "n": pa.array(pairs[:, 1])})

    counts = encoded.filter("n_tokens is null").select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # No more rows than the vocabulary has ids.
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1)


def compress(values: np.ndarray, offsets: np.ndarray):
    """(control offsets, control, data offsets, data) of the value lists between ``offsets``."""
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    counts = np.diff(offsets)
    controls = np.concatenate(([0], np.cumsum(-(-counts // 4))))
    # Place of each value among 2-bit slots, every list starting at a whole byte.
    slot = np.arange(len(values)) + np.repeat(4 * controls[:-1] - offsets[:-1], counts)
    slots = np.zeros(4 * controls[-1], np.uint8)
    slots[slot] = size - 1
    control = (slots.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    widest = int(size.max(initial=1))
    raw = values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :widest]
    data = raw[np.arange(widest) < size[:, None]]
    return controls, control, np.concatenate(([0], np.cumsum(size, dtype=np.int64)))[offsets], data


def expand(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All values of several lists at once; ``counts``: values of each list."""
    used = -(-counts // 4)
    # Unused slots at the end of each list hold no bytes.
    slot = np.arange(counts.sum()) + np.repeat(4 * (np.cumsum(used) - used) - np.cumsum(counts) + counts, counts)
    size = LENGTHS[control].reshape(-1)[slot]
    widest = int(size.max(initial=1))
    kind = 2 if widest <= 2 else 4
    raw = np.zeros((len(size), kind), np.uint8)
    raw[:, :widest][np.arange(widest) < size[:, None]] = data
    return raw.view(f"<u{kind}").reshape(-1).astype(np.uint32)


def write(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end: int | None = END) -> None:
    """Encode every text, rank ids over all of them, and write the files."""
    spark = prepare(docs.sparkSession)
    encoded = materialise(encode_ids(docs, vocabulary, end))
    ranking = materialise(ranks(encoded))
    encoded = encoded.filter("n_tokens is not null")
    ranking.write.parquet(f"{folder}/rank.parquet")
    order = np.array([tuple(r) for r in ranking.select("id", "rank").collect()], np.int64).reshape(-1, 2)
    to_rank = np.zeros(int(order[:, 0].max(initial=-1)) + 1, np.uint32)
    to_rank[order[:, 0]] = order[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            bounds, raw = byte_view(batch["ids"])
            at, control, stops, data = compress(to_rank[raw.view("<u4")], bounds // 4)
            yield pa.RecordBatch.from_pydict({
                **{c: batch[c] for c in ("part", "doc_id", "before", "n_tokens")},
                "control": binary(at, control),
                "data": binary(stops, data),
            })

    offsets = part_offsets(encoded.groupBy("part").agg(F.sum("n_tokens").alias("n")), "part", "n")
    offsets = offsets.withColumnRenamed("before", "earlier")
    schema = "part long, doc_id long, before long, n_tokens long, control binary, data binary"
    (
        encoded.mapInArrow(run, schema)
        .join(F.broadcast(offsets), "part")  # one row a partition
        .select("part", "doc_id", (F.col("before") + F.col("earlier")).alias("start"), "n_tokens", "control", "data")
        .sortWithinPartitions("part", "start")
        .write.partitionBy("part").parquet(f"{folder}/ids")
    )


def binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    parts = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, parts).cast(pa.binary())


def load(spark: SparkSession, folder: str, digests: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files; with ``digests``, ids_crc32 in place of ids."""
    prepare(spark)
    order = spark.read.parquet(f"{folder}/rank.parquet").select("rank", "id").collect()
    to_id = np.zeros(len(order), np.uint32)  # one entry for each id in use
    for rank, token in order:
        to_id[rank] = token

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            counts = batch["n_tokens"].to_numpy(False)
            ids = to_id[expand(byte_view(batch["control"])[1], byte_view(batch["data"])[1], counts)]
            ends = np.cumsum(counts)
            columns = {c: batch[c] for c in ("doc_id", "start", "n_tokens")}
            if digests:
                raw = memoryview(ids.astype("<u4").tobytes())
                cuts = zip((ends - counts).tolist(), ends.tolist(), strict=True)
                columns["ids_crc32"] = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in cuts], pa.int64())
            else:
                starts = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                columns["ids"] = pa.ListArray.from_arrays(starts, pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_pydict(columns)

    last = "ids_crc32 long" if digests else "ids array<long>"
    return spark.read.schema(
        "doc_id long, start long, n_tokens long, control binary, data binary, part long"
    ).parquet(f"{folder}/ids").drop("part").mapInArrow(run, f"doc_id long, start long, n_tokens long, {last}")


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared place."""
    return f"{shared_folder(spark)}/riskweave-files/{uuid.uuid4().hex}"
