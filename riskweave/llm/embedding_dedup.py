"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to the signs of its products with random directions, sorts all
vectors by the hash read as one number, and compares each with its neighbours in that order: two
vectors at a small angle share a long prefix in some pass. Sorted rows are dealt out in blocks of
``BLOCK`` rows, each with the first ``OVERLAP`` of the next, and a block is compared as one matrix
product. Pairs with cosine >= ``COSINE`` in double precision are links; a block hands on one edge
for each row it has linked, and the passes' edges are united to components.

The number of passes follows the number of vectors, so that a pair at the threshold agrees in the
first bits of some pass with probability ``RECALL``: as many bits as leave ``BLOCK`` / 2 rows or more
together if vectors are evenly spread. Where they are not, or a block ends among them, the rows that
agree do not lie in one block. Such rows are compared in pairs of blocks, but for those of the largest
component found among them, which are joined already; so every pair that agrees is compared or joined,
however dense its surroundings. Equal vectors are compared once.
Links are then counted exactly: every link lies inside a component, and a component is compared
with itself, in pairs of blocks if it is large.

Null and zero vectors, and those with null or non-finite components, link with nothing, nor do
vectors of different lengths. Rows with a null vec_id stay alone, with a null component. Rows that
share a vec_id are distinct vectors of one name: they count as links of each other. An empty table
gives no rows. Only vec_id and embedding are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import graph
from riskweave.llm.common import checked, numbered, prepare, runs
from riskweave.session import materialise

COSINE = 0.9
RECALL = 0.999
BITS = 48
BLOCK = 1_024
OVERLAP = 256
#: Rows of a component that one task compares with as many others, when links are counted.
COMPARED = 256


def prefix_bits(vectors: int) -> int:
    """First bits of a code that leave half a block of rows together, or up to a whole one."""
    return min(BITS, math.floor(max(0.0, math.log2(max(vectors, 1) / (BLOCK / 2)))))


def passes_for(vectors: int, cosine: float, recall: float) -> int:
    """Passes after which a pair at the threshold has met with the wished probability."""
    agree = 1 - math.acos(cosine) / math.pi  # of one bit
    met = agree ** max(0.0, math.log2(max(vectors, 1) / (BLOCK / 2)))
    return 1 if met == 1 else math.ceil(math.log(1 - recall) / math.log(1 - met))


def unit_rows(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    flat = vectors.flatten().to_numpy(False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def by_length(vectors: pa.Array) -> Iterator[np.ndarray]:
    """Row numbers of the vectors of each length."""
    sizes = np.diff(vectors.offsets.to_numpy())
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def hashed(vectors: DataFrame, passes: int) -> DataFrame:
    """Every vector once a pass, with its hash in ``code``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in by_length(batch["embedding"]):
                rows = batch.take(pa.array(at))
                unit = unit_rows(rows["embedding"])
                for p in range(passes):
                    directions = np.random.default_rng([p, unit.shape[1]]).standard_normal((unit.shape[1], BITS))
                    code = (unit @ directions > 0) @ (1 << np.arange(BITS - 1, -1, -1))
                    yield pa.RecordBatch.from_pydict({
                        "pass": pa.array(np.full(len(at), p)), "code": pa.array(code.astype(np.int64)),
                        "rep": rows["rep"], "embedding": rows["embedding"],
                    })

    kind = vectors.schema["embedding"].dataType.simpleString()
    return vectors.select("rep", "embedding").mapInArrow(run, f"pass long, code long, rep long, embedding {kind}")


def labels(linked: np.ndarray) -> np.ndarray:
    """Each row's smallest row in its component."""
    label = np.arange(len(linked))
    while True:  # the smallest label over neighbours, until nothing changes
        now = np.where(linked, label, len(label)).min(1, initial=len(label))
        now = np.minimum(now, label)
        now = now[now]
        if (now == label).all():
            return label
        label = now


def neighbours(ordered: DataFrame, cosine: float) -> DataFrame:
    """Edges (a, b): of each block's linked rows, every row with the smallest it is joined to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["block"]):
            rep = group["rep"].to_numpy(False)
            vectors = group["embedding"].combine_chunks()
            for at in by_length(vectors):
                unit = unit_rows(vectors.take(pa.array(at)))
                label = labels(unit @ unit.T >= cosine)
                joined = np.flatnonzero(label != np.arange(len(at)))
                yield pa.RecordBatch.from_pydict({"a": pa.array(rep[at[label[joined]]]), "b": pa.array(rep[at[joined]])})

    block = F.floor(F.col("position") / BLOCK)
    tail = (F.col("position") % BLOCK < OVERLAP) & (block > 0)
    blocks = F.explode(F.when(tail, F.array(block, block - 1)).otherwise(F.array(block)))
    rows = ordered.select(blocks.alias("block"), "rep", "embedding").repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(run, "a long, b long").distinct()


def crowded(ordered: DataFrame, known: DataFrame, vectors: DataFrame, bits: int, cosine: float) -> DataFrame:
    """Edges (a, b) among rows that agree in their first ``bits`` bits of a pass and lie in no one block.

    Rows outside the largest component of ``known`` among them are compared with all, in pairs of
    blocks numbered from 0; the largest component's blocks have the numbers after these.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["pass", "prefix", "i", "j"]):
            rep, side = group["rep"].to_numpy(False), group["side"].to_numpy(False)
            vectors = group["embedding"].combine_chunks()
            same = group["i"][0].as_py() == group["j"][0].as_py()
            for at in by_length(vectors):
                unit = unit_rows(vectors.take(pa.array(at)))
                linked = unit @ unit.T >= cosine
                if not same:
                    linked &= side[at][:, None] != side[at]
                label = labels(linked)
                joined = np.flatnonzero(label != np.arange(len(at)))
                yield pa.RecordBatch.from_pydict({"a": pa.array(rep[at[label[joined]]]), "b": pa.array(rep[at[joined]])})

    rows = ordered.select("pass", F.shiftright("code", BITS - bits).alias("prefix"), "rep", "position")
    rows = rows.join(checked(known.withColumnRenamed("node", "rep")), "rep", "left")
    rows = materialise(rows.withColumn("component", F.coalesce("component", "rep")))
    parts = rows.groupBy("pass", "prefix", "component").agg(
        F.count("*").alias("n"), F.min("position").alias("low"), F.max("position").alias("high")
    )
    ranges = parts.groupBy("pass", "prefix").agg(
        F.sum("n").alias("size"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.max(F.struct("n", "component")).alias("main"),
    )
    ranges = ranges.filter((F.col("high") >= F.floor(F.col("low") / BLOCK) * BLOCK + BLOCK + OVERLAP) & (F.col("size") > F.col("main.n")))
    ranges = checked(ranges.select(
        "pass", "prefix", F.col("main.component").alias("main"), F.ceil(F.col("main.n") / BLOCK).alias("inside"),
        F.ceil((F.col("size") - F.col("main.n")) / BLOCK).alias("outside"),
    ))
    joined = F.col("component") == F.col("main")
    block = F.when(joined, F.col("outside") + F.pmod(F.xxhash64("rep"), "inside")).otherwise(F.pmod(F.xxhash64("rep"), "outside"))
    last = F.when(joined, F.col("outside")).otherwise(F.col("outside") + F.col("inside")) - 1
    rows = rows.join(ranges, ["pass", "prefix"]).withColumn("block", block)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "pass", "prefix", "rep", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
    ).join(vectors.select("rep", "embedding"), "rep")
    rows = rows.repartition("pass", "prefix", "i", "j").sortWithinPartitions("pass", "prefix", "i", "j")
    return rows.mapInArrow(run, "a long, b long").distinct()


def degrees(members: DataFrame, cosine: float) -> DataFrame:
    """(rep, links): copies of other vectors linked with each, all compared within components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["component", "i", "j"]):
            rep, copies, side = (group[c].to_numpy(False) for c in ("rep", "copies", "side"))
            vectors = group["embedding"].combine_chunks()
            links = np.zeros(len(rep), np.int64)
            same = group["i"][0].as_py() == group["j"][0].as_py()
            for at in by_length(vectors):
                unit = unit_rows(vectors.take(pa.array(at)))
                linked = unit @ unit.T >= cosine
                np.fill_diagonal(linked, False)
                if not same:
                    linked &= side[at][:, None] != side[at]
                links[at] = linked @ copies[at]
            yield pa.RecordBatch.from_pydict({"rep": pa.array(rep), "links": pa.array(links)})

    sizes = materialise(members.groupBy("component").agg(F.ceil(F.count("*") / COMPARED).alias("blocks")))
    rows = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "component", "rep", "copies", "embedding", F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"),
    )
    rows = rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return rows.mapInArrow(run, "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, passes: int | None = None, recall: float = RECALL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    prepare(vectors.sparkSession)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(finite & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    classes = vectors.filter(good).groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    # A number of its own, as rows of different vectors may share a vec_id.
    classes = materialise(materialise(classes).withColumn("rep", F.monotonically_increasing_id()))
    n = classes.count()
    ordered = numbered(hashed(classes, passes or passes_for(n, cosine, recall)), "pass", "code", "rep")
    parts = graph.components(neighbours(ordered, cosine))
    more = materialise(crowded(ordered, parts, classes, prefix_bits(n), cosine))
    if not more.isEmpty():
        parts = graph.components(parts.toDF("a", "b").union(more))
    parts = parts.withColumnRenamed("node", "rep")
    members = materialise(classes.join(parts, "rep"))
    counted = materialise(degrees(members, cosine))
    names = materialise(members.groupBy("component").agg(F.min("first").alias("component_id")))
    linked = members.join(counted, "rep").join(names, "component").select("rep", "links", "component_id")
    known = materialise(
        classes.join(linked, "rep", "left").select(
            "embedding", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component_id", "first").alias("component_id")
        )
    )
    rows = vectors.withColumn("key", F.when(good, F.col("embedding"))).join(
        known.withColumnRenamed("embedding", "key"), "key", "left"
    )
    links = F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0))
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id", links.alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept")
    )
