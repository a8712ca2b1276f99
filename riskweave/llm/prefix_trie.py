"""The trie of conversation prefixes, screened by a count-min sketch.

A node is a distinct sequence of first turns (role, text); its members are the conversations that
start with it. Every prefix has a 128-bit digest: the running exclusive or of hashes of its turns
with their places, so a prefix's parent is known from its last turn alone.

1. Turns are numbered by a range partitioning and offsets; running digests are taken over blocks of
   ``BLOCK`` turns, so one conversation of any length is spread over many tasks.
2. All digests enter a count-min sketch of two rows. A digest's estimate is at least its count, so an
   estimate of one proves a prefix that no other conversation has. All longer prefixes of that
   conversation are single too: such tails are finished where they lie, without a shuffle.
3. Prefixes that may be shared are grouped exactly, merged before the shuffle. The first single node
   of a conversation only looks up who its parent is.
4. Sums over subtrees double their reach each round (children, then nodes 2, 4, 8 levels down), so a
   trie of depth d takes log2(d) rounds over the shared nodes.
5. Numbers of the conversations that end at a node are sorted by ranges, joined to pieces of bounded
   length, and the pieces of a node hashed in their order.

The sketch has ``ROOM`` cells for each prefix, ``CELLS`` a row at most (a bit each when it is sent to
the tasks: 32 MB together). Beyond that, more single prefixes are grouped exactly; results are the same.

Turns go by ``turn``, nulls first; turns equal in that by role, then by a hash of the text. Null role
and text are empty. Repeated rows are turns of their own. Rows without conv_id belong to no conversation
and are left out. Conversations without turns (after ``regrouped``) are members of the root only. An
empty table has no conversations and gives no rows, not even a root. Only conv_id, turn, role and text
are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import checked, numbered, prepare
from riskweave.session import materialise

BLOCK = 4_096
ROOM = 4
CELLS = 1 << 27
#: Cells that are merged and sent together, and ids joined to one piece.
STRIPE = 1 << 16
PIECE = 8_192
#: Conversations share their heads in groups of so many numbers; a head has fewer turns than HEADS.
GROUP = 100
HEADS = 6
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NOBODY = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, size, r1, r2, chars): turns by their place from 1, as hashes of role and text."""
    prepare(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.xxhash64(role, text).alias("r1"),
        F.xxhash64(F.lit(1), text, role).alias("r2"), F.length(text).cast("long").alias("chars"),
    ).filter("conv_id is not null")
    rows = numbered(rows, "conv_id", F.asc_nulls_first("turn"), "role", "r1", "r2")
    first = rows.groupBy("conv_id").agg(F.min("position").alias("first"), F.count("*").alias("size"))
    rows = rows.join(first, "conv_id").withColumn("pos", F.col("position") - F.col("first") + 1)
    return materialise(rows.select("conv_id", "pos", "size", "r1", "r2", "chars"))


def sizes_of(turns: DataFrame) -> DataFrame:
    """(conv_id, size) of every conversation."""
    return turns.filter("pos = 1").select("conv_id", "size")


def regrouped(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and sizes of conversations that begin like the first of their group of ``GROUP`` numbers.

    Conversation c takes the first h turns of the group's first one (all, if it has fewer), then its
    own turns after its first h; h is the crc32 of c in decimal, modulo ``HEADS``.
    """
    start = F.col("conv_id") - F.col("conv_id") % GROUP
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    sizes = sizes_of(turns).select("conv_id", F.col("size").alias("own"), start.alias("start"), h.alias("h"))
    lead = sizes.filter("conv_id = start").select("start", F.col("own").alias("given"))
    sizes = sizes.join(lead, "start", "left").withColumn("head", F.least("h", F.coalesce("given", F.lit(0))))
    sizes = sizes.withColumn("size", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    sizes = materialise(sizes.select("conv_id", "start", "h", "head", "size"))
    rest = turns.drop("size").join(sizes.drop("start"), "conv_id").filter("pos > h")
    rest = rest.withColumn("pos", F.col("pos") - F.col("h") + F.col("head"))
    heads = turns.filter((F.col("pos") < HEADS) & (F.col("conv_id") == start)).drop("size").withColumnRenamed("conv_id", "start")
    heads = heads.join(sizes, "start").filter("pos <= head")
    columns = ["conv_id", "pos", "size", "r1", "r2", "chars"]
    return rest.select(columns).union(heads.select(columns)), sizes.select("conv_id", "size")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, size, x1, x2, p1, p2, chars): digests of every prefix and of its parent."""
    rows = turns.withColumns({
        "t1": F.xxhash64("pos", "r1", "r2"), "t2": F.xxhash64(F.lit(2), "r2", "pos", "r1"),
        "block": F.floor((F.col("pos") - 1) / BLOCK),
    })
    within = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"x{k}": F.bit_xor(f"t{k}").over(within) for k in (1, 2)})
    longest = turns.agg(F.max("size")).first()[0] or 0
    if longest > BLOCK:
        totals = rows.filter(F.col("size") > BLOCK).groupBy("conv_id", "block")
        totals = totals.agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
        earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select("conv_id", "block", *(F.bit_xor(f"s{k}").over(earlier).alias(f"b{k}") for k in (1, 2)))
        rows = rows.join(totals, ["conv_id", "block"], "left")
        rows = rows.withColumns({f"x{k}": F.col(f"x{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))) for k in (1, 2)})
    parent = {f"p{k}": F.col(f"x{k}").bitwiseXOR(F.col(f"t{k}")) for k in (1, 2)}
    rows = rows.withColumns(parent).withColumnRenamed("pos", "depth")
    return materialise(rows.select("conv_id", "depth", "size", "x1", "x2", "p1", "p2", "chars"))


def cells_of(x1: np.ndarray, x2: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A digest's cell in each of the sketch's rows, which lie one after the other."""
    mask = np.uint64(width - 1)
    return x1.view(np.uint64) & mask, (x2.view(np.uint64) & mask) + np.uint64(width)


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """For every cell whether it counts two or more: all that telling singles takes, a bit a cell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.concatenate(cells_of(batch["x1"].to_numpy(), batch["x2"].to_numpy(), width))
            cells, counts = np.unique(both, return_counts=True)
            stripe = (cells // STRIPE).astype(np.int64)
            cuts = np.concatenate(([0], np.flatnonzero(stripe[1:] != stripe[:-1]) + 1, [len(cells)]))
            inside = (cells % STRIPE).astype("<u2")
            out = [(int(stripe[a]), inside[a:b].tobytes(), inside[a:b][counts[a:b] > 1].tobytes())
                   for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if b > a]
            yield pa.RecordBatch.from_pydict({
                "stripe": pa.array([r[0] for r in out], pa.int64()),
                "met": pa.array([r[1] for r in out], pa.binary()), "more": pa.array([r[2] for r in out], pa.binary()),
            })

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, met, more = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"stripe": pa.array([at], pa.int64()), "bits": pa.array([np.packbits(more).tobytes()])})

        for batch in batches:
            for stripe, first, again in zip(*(batch[c].to_pylist() for c in ("stripe", "met", "more")), strict=True):
                if stripe != at:
                    if at is not None:
                        yield done()
                    at, met, more = stripe, np.zeros(STRIPE, bool), np.zeros(STRIPE, bool)
                first = np.frombuffer(first, "<u2")
                more[first[met[first]]] = True
                met[first] = True
                more[np.frombuffer(again, "<u2")] = True
        if at is not None:
            yield done()

    parts = rows.select("x1", "x2").mapInArrow(count, "stripe long, met binary, more binary")
    parts = parts.repartition("stripe").sortWithinPartitions("stripe").mapInArrow(merge, "stripe long, bits binary")
    bits = np.zeros(2 * width // 8, np.uint8)
    for r in parts.toLocalIterator():  # 2 * CELLS bits at most
        bits[r.stripe * STRIPE // 8 : (r.stripe + 1) * STRIPE // 8] = np.frombuffer(r.bits, np.uint8)
    return bits


def screened(rows: DataFrame, cells: int = CELLS) -> DataFrame:
    """Prefixes with ``single`` (proven to belong to one conversation) and ``under`` (so is the parent)."""
    width = max(STRIPE, min(cells, 1 << (ROOM * rows.count()).bit_length()))
    bits = sketch(rows, width)

    def proven(x1: np.ndarray, x2: np.ndarray) -> np.ndarray:
        at = cells_of(x1, x2, width)
        return ~np.logical_and(*(bits[c // np.uint64(8)] >> (7 - (c % np.uint64(8)).astype(np.uint8)) & 1 for c in at))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x1, x2, p1, p2, depth = (batch[c].to_numpy() for c in ("x1", "x2", "p1", "p2", "depth"))
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["single"] = pa.array(proven(x1, x2))
            columns["under"] = pa.array(proven(p1, p2) & (depth > 1))
            yield pa.RecordBatch.from_pydict(columns)

    kind = "conv_id long, depth long, size long, x1 long, x2 long, p1 long, p2 long, chars long, single boolean, under boolean"
    return materialise(rows.mapInArrow(run, kind))


def ended(ends: DataFrame) -> DataFrame:
    """(x1, x2, ends_sha256): of each node's conversations in ascending order, comma between."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x1, x2, ids = (batch[c].to_numpy() for c in ("x1", "x2", "conv_id"))
            new = np.flatnonzero((x1[1:] != x1[:-1]) | (x2[1:] != x2[:-1])) + 1
            cuts = np.unique(np.concatenate((new, np.arange(0, len(ids), PIECE), [len(ids)])))
            spans = [(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "x1": pa.array([x1[a] for a, _ in spans], pa.int64()), "x2": pa.array([x2[a] for a, _ in spans], pa.int64()),
                "first": pa.array([ids[a] for a, _ in spans], pa.int64()),
                "text": pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in spans], pa.string()),
            })

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            out = []
            for a, b, text in zip(*(batch[c].to_pylist() for c in ("x1", "x2", "text")), strict=True):
                if (a, b) != node:
                    if node is not None:
                        out.append((*node, running.hexdigest()))
                    node, running = (a, b), hashlib.sha256(text.encode())
                else:
                    running.update(f",{text}".encode())
            yield rows_of(out)
        if node is not None:
            yield rows_of([(*node, running.hexdigest())])

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = pa.int64(), pa.int64(), pa.string()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["x1", "x2", "ends_sha256"]
        )

    parts = ends.repartitionByRange("x1", "x2", "conv_id").sortWithinPartitions("x1", "x2", "conv_id")
    parts = parts.mapInArrow(pieces, "x1 long, x2 long, first long, text string")
    parts = parts.repartition("x1", "x2").sortWithinPartitions("x1", "x2", "first")
    return parts.mapInArrow(hashed, "x1 long, x2 long, ends_sha256 string")


def subtree_sums(nodes: DataFrame, deepest: int) -> DataFrame:
    """(x1, x2, n_leaves, saved_tokens) over subtrees, from each node's own leaves and savings.

    After a round that began with reach r, a node's sums cover its nodes less than 2r levels down: its
    own, and those of the nodes r levels down. ``j`` is a node's ancestor r levels up.
    """
    values = ["n_leaves", "saved_tokens"]
    reach, rows = 1, nodes.select("x1", "x2", F.col("p1").alias("j1"), F.col("p2").alias("j2"), *values)
    while reach <= deepest:
        below = rows.filter("j1 is not null").groupBy(F.col("j1").alias("x1"), F.col("j2").alias("x2"))
        below = below.agg(*(F.sum(v).alias(f"more_{v}") for v in values))
        up = rows.select(F.col("x1").alias("j1"), F.col("x2").alias("j2"), F.col("j1").alias("k1"), F.col("j2").alias("k2"))
        rows = rows.join(checked(below), ["x1", "x2"], "left").join(checked(up), ["j1", "j2"], "left")
        sums = [(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values]
        rows = materialise(rows.select("x1", "x2", F.col("k1").alias("j1"), F.col("k2").alias("j2"), *sums))
        reach *= 2
    return rows.select("x1", "x2", *values)


def decimal_hash(number: Column) -> Column:
    return F.sha2(number.cast("string").cast("binary"), 256)


def trie(turns: DataFrame, sizes: DataFrame, cells: int = CELLS) -> DataFrame:
    """One row a node: see ``NODE``. ``turns`` as of ``turns_of``, ``sizes`` with every conversation."""
    n_convs, smallest = sizes.agg(F.count("*"), F.min("conv_id")).first()
    spark = turns.sparkSession
    if not n_convs:
        kinds = ("string" if c == "ends_sha256" else "long" for c in NODE)
        return spark.createDataFrame([], ", ".join(f"{c} {kind}" for c, kind in zip(NODE, kinds, strict=True)))
    marked = screened(prefixes(turns), cells)
    shared = marked.filter("not single").groupBy("x1", "x2", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        *(F.max(c).alias(c) for c in ("p1", "p2", "chars")),
    )
    # The root's digest is that of no turns; it has no parent.
    root = [(0, 0, 0, smallest, n_convs, None, None, 0)]
    shared = materialise(shared.union(spark.createDataFrame(root, shared.schema)))
    tops = marked.filter("single and not under")
    children = shared.filter("depth > 0").groupBy("p1", "p2").agg(F.count("*").alias("inner"))
    tails = tops.groupBy("p1", "p2").agg(F.count("*").alias("outer"))
    children = children.join(tails, ["p1", "p2"], "full")
    children = checked(children.select(
        F.col("p1").alias("x1"), F.col("p2").alias("x2"), F.coalesce("inner", F.lit(0)).alias("inner"), F.coalesce("outer", F.lit(0)).alias("outer")
    ))
    n_children = F.coalesce(F.col("inner") + F.col("outer"), F.lit(0))
    nodes = shared.join(children, ["x1", "x2"], "left").withColumns({
        "n_children": n_children, "n_leaves": F.when(n_children == 0, 1).otherwise(F.col("outer")).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
    })
    nodes = materialise(nodes)
    deepest = nodes.agg(F.max("depth")).first()[0]
    ends = marked.filter("not single and depth = size").select("x1", "x2", "conv_id")
    nothing = F.lit(0).cast("long")
    ends = ends.union(sizes.filter("size = 0").select(nothing, nothing, "conv_id"))
    parents = checked(shared.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id")))
    inner = nodes.drop("n_leaves", "saved_tokens").join(checked(subtree_sums(nodes, deepest)), ["x1", "x2"])
    inner = inner.join(checked(ended(ends)), ["x1", "x2"], "left").join(parents, ["p1", "p2"], "left")
    inner = inner.withColumns({
        "ends_sha256": F.coalesce("ends_sha256", F.lit(NOBODY)),
        # A prefix that only seems shared may follow a proven single one, of the same conversation.
        "parent_conv_id": F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")),
    })
    at_end = F.col("depth") == F.col("size")
    alone = {
        "n_convs": F.lit(1).cast("long"), "n_children": F.when(at_end, 0).otherwise(1).cast("long"), "n_leaves": F.lit(1).cast("long"),
        "saved_tokens": nothing, "ends_sha256": F.when(at_end, decimal_hash(F.col("conv_id"))).otherwise(F.lit(NOBODY)),
    }
    tails = marked.filter("single and under").withColumns(alone).withColumn("parent_conv_id", F.col("conv_id"))
    tops = tops.withColumns(alone).join(parents, ["p1", "p2"])
    return inner.select(NODE).union(tops.select(NODE)).union(tails.select(NODE))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    turns = turns_of(conversations)
    return trie(turns, sizes_of(turns))
