"""Self join of documents by Jaccard similarity of their word shingles, and its classes.

Shingles are hashed into groups; the counts per group are a document's point. Two documents share
no more shingles than the sum, over groups, of the smaller count. Every comparison is bounded that
way before the texts are compared; R-trees over points do it for whole sets of documents at once,
with the largest count of each group as a node's corner.

Points of unlike texts lie evenly far apart in every direction, so one tree over all of them would
open every node for every query. The trees are therefore kept per bucket, and the buckets lose no
link: in one order of all shingles, two linked documents share one of their first
n - ceil(3n/4) + 1. The order puts shingles last that a sample of documents shows to be frequent;
which ones these are changes the cost only.

1. Sketch each text: set size, digest, point, first shingles. Equal sets are one class.
2. In each bucket the document with the most neighbours leads; every document is compared with those
   that lead in a quarter of its buckets, four at most. These links give first components.
3. Buckets that still hold several components get R-trees, which skip nodes of one component, and
   find all remaining pairs. A bucket above ``BLOCK`` rows is dealt out in pairs of blocks. How many
   buckets a pair shares bounds it once more.

Pairs are verified on whole texts, streamed past the text they share. Components equal those over
all links; the links inside an already joined component are not listed.

Texts without words, and null texts, link with nothing. Rows with a null doc_id get a null
component. Rows that share a doc_id are one node; each keeps its own size. An empty table gives no
rows. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm import chunks, graph
from riskweave.llm.common import checked, give_back, prepare, runs, slices
from riskweave.llm.shingles import common, mixed, shingle_sets
from riskweave.session import materialise

#: Groups of the points in trees. A point is one byte a group; what exceeds a byte is added to the
#: bound whole.
GROUPS = 256
#: One in so many documents is sampled for the order; a shingle in FREQUENT of them goes last.
SAMPLE = 16
FREQUENT = 8
#: Shingles that can be put last: bounds what is sent to the tasks.
LAST = 1_000_000
#: Rows of a bucket that one task compares among themselves; also members checked beside one text.
BLOCK = 1_024
BESIDE = 32
LEAF = 16
#: Bytes of text hashed at a time.
HASHED = 1 << 20


def needed(a, b):
    """Fewest common shingles of two linked sets: J >= 3/4 is I >= 3/7 of the summed sizes."""
    return -(-3 * (a + b) // 7)


def first_ones(n):
    """How many of a set's shingles, in the common order, name its buckets."""
    return n + -3 * n // 4 + 1


def fewest(a: Column, b: Column) -> Column:
    """Fewest first shingles that two linked sets share.

    In the common order one set's first ones end before the other's. Of those, the ones missing in
    the other set are at most all that it misses.
    """
    common = F.ceil(3 * (a + b) / F.lit(7) - 1e-9)
    return F.greatest(F.lit(1), F.least(*(n - F.ceil(3 * n / F.lit(4)) + 1 - n for n in (a, b))) + common)


def point(shingles: np.ndarray) -> tuple[bytes, int]:
    """(counts per group as bytes, shingles not counted)."""
    counts = np.bincount(shingles & np.uint64(GROUPS - 1), minlength=GROUPS)
    held = np.minimum(counts, 255)
    return held.astype(np.uint8).tobytes(), int(counts.sum() - held.sum())


def sketches(docs: DataFrame, last: np.ndarray) -> DataFrame:
    """(doc_id, n, d1, d2, point, excess, first): the last three are null for all but one of a task's equal sets.

    They are null for rows with a null doc_id too, which therefore never stand for their equals.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks.forget()
        give_back()
        seen = set()
        for batch in slices(batches, size=HASHED):
            n, digests, points, firsts = [], [], [], []
            named = batch["doc_id"].is_valid().to_pylist()
            for s, has_id in zip(shingle_sets(batch["text"]), named, strict=True):
                d1 = int(mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) - (1 << 63)
                d2 = int(mixed(s * np.uint64(0xDA942042E4DD58B5)).sum(dtype=np.uint64)) - (1 << 63)
                n.append(len(s))
                digests.append((d1, d2))
                if not len(s) or not has_id or (d1, d2) in seen:
                    points.append((None, None))
                    firsts.append(None)
                    continue
                seen.add((d1, d2))
                points.append(point(s))
                length = first_ones(len(s))
                if len(last):
                    at = np.searchsorted(last, s)
                    at[at == len(last)] = 0
                    is_last = last[at] == s
                    s = np.concatenate((s[~is_last], s[is_last]))
                firsts.append(s[:length].view(np.int64))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "n": pa.array(n, pa.int64()),
                "d1": pa.array([d for d, _ in digests], pa.int64()),
                "d2": pa.array([d for _, d in digests], pa.int64()),
                "point": pa.array([p for p, _ in points], pa.binary()),
                "excess": pa.array([e for _, e in points], pa.int64()),
                "first": pa.array(firsts, pa.list_(pa.int64())),
            })

    schema = "doc_id long, n long, d1 long, d2 long, point binary, excess long, first array<long>"
    return docs.mapInArrow(run, schema)


def frequent(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of shingles that a sample of documents shows to be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks.forget()
        give_back()
        for batch in slices(batches, size=HASHED):
            sets = shingle_sets(batch["text"])
            yield pa.RecordBatch.from_pydict({"shingle": pa.array(np.concatenate(sets).view(np.int64))})

    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    rows = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(LAST)
    found = np.array([r.shingle for r in rows.select("shingle").collect()], np.int64)
    return np.sort(found.view(np.uint64))


def buckets(sketch: DataFrame) -> DataFrame:
    """(token, doc_id, n, near) of every token that two documents hold; ``near``: rows of the token close by.

    Repeated rows of a document, read in different tasks, come as one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, before = ("token", "n", "doc_id"), [np.zeros(0, np.int64)] * 3, None
        for batch in (*batches, None):
            rows = held
            if batch is not None:
                rows = [np.concatenate((h, batch[c].to_numpy(False))) for h, c in zip(held, names, strict=True)]
                new = np.any([c[1:] != c[:-1] for c in rows], axis=0)
                rows = [c[np.concatenate(([True], new))[: len(c)]] for c in rows]
            # The last row waits for its successor.
            held, stop = [c[-1:] for c in rows], len(rows[0]) - (batch is not None)
            if stop <= 0:
                continue
            tokens = rows[0]
            again = np.concatenate(([before is not None and tokens[0] == before], tokens[1:] == tokens[:-1]))
            shared = again.copy()
            shared[:-1] |= again[1:]
            before = tokens[stop - 1]
            kept = np.flatnonzero(shared[:stop])
            group = np.cumsum(~again)[kept]
            near = np.bincount(group)[group]
            columns = {k: pa.array(c[kept]) for k, c in zip(names, rows, strict=True)}
            yield pa.RecordBatch.from_pydict(columns | {"near": pa.array(near)})

    rows = sketch.filter("doc_id is not null and first is not null")
    rows = rows.select(F.explode("first").alias("token"), "n", "doc_id")
    rows = rows.repartition("token").sortWithinPartitions("token", "doc_id", "n")
    return rows.mapInArrow(run, "token long, n long, doc_id long, near long")


def first_pairs(bucket: DataFrame) -> DataFrame:
    """(a, b): each document with the leads of a quarter of its buckets or more; four at most.

    A bucket's lead is the document with the most neighbours in all its buckets: of a group of
    edited copies, the one that the others were made of.
    """
    known = checked(bucket.groupBy("doc_id").agg(F.sum("near").alias("known")))
    lead = bucket.join(known, "doc_id").groupBy("token").agg(F.max(F.struct("known", "doc_id", "n")).alias("x"))
    # As long as the list of buckets, and like it dealt by token: never broadcast.
    lead = lead.select("token", F.col("x.doc_id").alias("a"), F.col("x.n").alias("m"))
    pairs = bucket.join(lead, "token").filter("a <> doc_id and 4 * least(n, m) >= 3 * greatest(n, m)")
    pairs = pairs.groupBy("a", "doc_id", "n").agg(F.count("*").alias("shared"))
    often = pairs.filter("4 * shared >= n - ceil(3 * n / 4) + 1")
    return often.select("a", F.col("doc_id").alias("b")).distinct()


def points_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, GROUPS)


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs whose whole texts' sets link: texts of ``b`` are streamed past the set of ``a``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside, whole = None, []
        for batch in slices(batches, size=HASHED):
            found = []
            rows = zip(batch["a"].to_pylist(), batch["b"].to_pylist(), shingle_sets(batch["text"]), strict=True)
            for a, b, shingles in rows:
                if a != beside:
                    beside, whole = a, []
                if b is None:
                    whole.append(shingles)
                elif any(common(w, shingles) >= max(1, needed(len(w), len(shingles))) for w in whole):
                    found.append((a, b))
            yield pa.RecordBatch.from_pydict({
                "a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())
            })

    pairs = materialise(pairs)
    crowd = materialise(pairs.groupBy("a").agg(F.ceil(F.count("*") / BESIDE).alias("parts")))
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = materialise(docs.join(checked(wanted), "doc_id"))
    members = pairs.join(crowd, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
    members = members.join(texts.withColumnRenamed("doc_id", "b"), "b").select("a", "part", "b", "text")
    leads = crowd.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    leads = leads.join(texts.withColumnRenamed("doc_id", "a"), "a")
    rows = members.unionByName(leads.select("a", "part", F.lit(None).cast("long").alias("b"), "text"))
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return rows.drop("part").mapInArrow(run, "a long, b long").distinct()


class Tree:
    """R-tree over the points of one block, packed in the order of component and size.

    A block holds at most ``BLOCK`` rows or so: leaves of ``LEAF`` rows, and their corners.
    """

    def __init__(self, points, n, excess, component):
        order = np.lexsort((n, component))
        self.order, self.rows = order, [x[order] for x in (points, n, n, excess, component, component)]
        self.starts = np.arange(0, len(n), LEAF)
        ways = (np.maximum, np.minimum, np.maximum, np.maximum, np.minimum, np.maximum)
        self.nodes = [way.reduceat(x, self.starts) for way, x in zip(ways, self.rows, strict=True)]

    def leaf(self, k: int) -> list[np.ndarray]:
        return [x[k * LEAF : (k + 1) * LEAF] for x in self.rows]


def may_link(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Which of the nodes or rows ``a`` can hold a document that links with one under each of ``b``.

    Both are (largest counts, fewest and most shingles, largest excess, least and greatest component).
    """
    shared = np.array([np.minimum(x, b[0]).sum(1, dtype=np.int64) for x in a[0]])
    shared += np.minimum(a[3][:, None], b[3])
    one = (a[4] == a[5])[:, None] & (b[4] == b[5]) & (a[4][:, None] == b[4])
    near = (4 * a[2][:, None] >= 3 * b[1]) & (4 * b[2] >= 3 * a[1][:, None])
    return ~one & near & (shared >= needed(a[1][:, None], b[1]))


def surviving(left: Tree, right: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Rows of both trees, in pairs of different components whose points may link."""
    found = [], []
    for i, j in zip(*np.nonzero(may_link(left.nodes, right.nodes)), strict=True):
        if left is right and j < i:
            continue
        x, y = np.nonzero(may_link(left.leaf(i), right.leaf(j)))
        found[0].append(left.order[x + i * LEAF])
        found[1].append(right.order[y + j * LEAF])
    if not found[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found[0]), np.concatenate(found[1])


def across(rows: DataFrame, sketch: DataFrame) -> DataFrame:
    """(a, b): pairs of different components that their points, and the number of their buckets, let pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["token", "i", "j"]):
            doc, n, excess, component, side = (
                group[c].to_numpy(False) for c in ("doc_id", "n", "excess", "component", "side")
            )
            points = points_of(group["point"])
            sides = [np.flatnonzero(side == s) for s in (0, 1)]
            trees = [Tree(points[at], n[at], excess[at], component[at]) for at in sides if len(at)]
            if len(trees) == 1 and group["i"][0].as_py() != group["j"][0].as_py():
                continue
            x, y = surviving(trees[0], trees[-1])
            x, y = sides[0][x] if len(sides[0]) else sides[1][x], sides[1][y] if len(sides[1]) else sides[0][y]
            x, y = np.where(doc[x] <= doc[y], (x, y), (y, x))
            pairs = np.unique(np.stack((doc[x], doc[y], n[x], n[y])), axis=1)
            weight = group["weight"][0].as_py()
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(pairs[0]), "b": pa.array(pairs[1]),
                "na": pa.array(pairs[2]), "nb": pa.array(pairs[3]),
                "shared": pa.array(np.full(pairs.shape[1], weight)),
            })

    point = sketch.filter("first is not null").select("doc_id", "point", "excess")
    # Blocks i and j of a bucket meet in group (i, j); a row goes to the groups of its block.
    block = F.pmod(F.xxhash64("doc_id", F.lit(1)), "blocks")
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    rows = rows.select(
        "token", "weight", "doc_id", "n", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
    ).join(point, "doc_id")
    rows = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    found = rows.mapInArrow(run, "a long, b long, na long, nb long, shared long")
    found = found.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))
    return found.filter(F.col("shared") >= fewest(F.col("na"), F.col("nb"))).select("a", "b").distinct()


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = materialise(sketches(docs, frequent(docs)))
    classes = sketch.filter("n > 0 and doc_id is not null").groupBy("d1", "d2", "n")
    classes = materialise(classes.agg(F.min("doc_id").alias("rep")))
    firsts = sketch.filter("first is not null and doc_id is not null").select("doc_id", "d1", "d2", "n")
    equal = firsts.join(classes, ["d1", "d2", "n"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    bucket = materialise(buckets(sketch))
    links = materialise(verified(first_pairs(bucket), docs).union(equal))
    known = graph.components(links)
    more = materialise(verified(across(divided(bucket, known), sketch), docs))
    if not more.isEmpty():
        # Links between components, of which one for each pair is enough.
        ends = more
        for c in "ab":
            name = known.select(F.col("node").alias(c), F.col("component").alias("c" + c))
            ends = ends.join(name, c, "left").withColumn("c" + c, F.coalesce("c" + c, c))
        ends = ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
        known = graph.components(known.toDF("a", "b").union(ends))
    sizes = sketch.select("doc_id", "d1", "d2", F.col("n").alias("n"))
    placed = sizes.join(classes, ["d1", "d2", "n"], "left")
    placed = placed.join(known.withColumnRenamed("node", "rep"), "rep", "left")
    return placed.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def divided(bucket: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components; of ``weight`` buckets with the same documents, one."""
    rows = bucket.select("token", "doc_id", "n").join(checked(known.toDF("doc_id", "component")), "doc_id", "left")
    rows = materialise(rows.withColumn("component", F.coalesce("component", "doc_id")))
    kept = rows.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"),
        # Rows are distinct, so none cancels another: (doc_id, n) comes once in a bucket.
        F.bit_xor(F.xxhash64("doc_id", "n")).alias("x"), F.bit_xor(F.xxhash64("doc_id", "n", F.lit(2))).alias("y"),
    ).filter("low <> high")
    kept = kept.groupBy("x", "y", "size").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    kept = checked(kept.select("token", "weight", F.ceil(F.col("size") / BLOCK).alias("blocks")))
    return rows.join(kept, "token")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each group the row with the smallest doc_id, once; all columns as they were.

    Rows without a doc_id are given one by their text, above ordinary ids, for the time of the join:
    they belong to groups as any other and stay only where no row of the group has an id.
    """
    without = F.lit(1 << 62) + F.pmod(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), F.lit(1 << 61))
    name = F.coalesce(F.col("doc_id").cast("long"), without)
    groups = join(docs.select(name.alias("doc_id"), "text"))
    kept = materialise(groups.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("g")))
    again = not kept.filter("n > 1").isEmpty()
    number = next(c for k in range(len(docs.columns) + 1) if (c := f"number{k}") not in docs.columns)
    # Fewer go than stay, and texts are not shuffled for them while they can be sent to the tasks.
    gone = kept.filter("doc_id <> g").select(F.col("doc_id").alias(number))
    rows = docs.withColumn(number, name).join(checked(gone), number, "left_anti")
    return (rows.dropDuplicates([number]) if again else rows).select(docs.columns)
