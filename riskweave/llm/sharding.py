"""Sharding by sampled splitters.

Rows are ordered by a key: the hash of the text, so that equal texts lie together; a text whose
copies would overfill a range is ordered by its rows' numbers inside, which tell apart rows that
share a doc_id, or have none. A sample drawn with probability in
proportion to size gives quantile boundaries; rows go to the ranges between them, ranges that turn
out overfull are cut again by a sample of their own. Sizes are then summed exactly, over ranges
and within each, and a shard takes an equal stretch of all bytes.

Law `bytes`: sizes of shards are near equal, off by one key at most (a document, or all copies of
a text together if they are under 1/64 of a shard). Null texts have size 1. Rows that share
a text take any order. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import prepare
from riskweave.session import materialise

SHARDS = 16
#: A range or a text's copies may hold this share of a shard.
FINE = 64
#: Sampled keys for each boundary.
SAMPLES = 64
#: Rows for each range: a window over a range sorts no more than a few times these.
RANGE_ROWS = 1_000_000
#: No more ranges than this, as the driver holds a few numbers of each; then ranges grow, and sort on disk.
RANGES = 4_096


def search(splitters: list[tuple[int, int]], high: Column, low: Column) -> Column:
    """Number of splitters at or below the key: a binary search over two constant arrays."""
    if not splitters:
        return F.lit(0)
    highs, lows = (F.lit([x[k] for x in splitters]) for k in (0, 1))
    steps = F.lit([1 << b for b in reversed(range(len(splitters).bit_length()))])

    def step(at: Column, width: Column) -> Column:
        h, s = F.get(highs, at + width - 1), F.get(lows, at + width - 1)
        return F.when((h < high) | ((h == high) & (s <= low)), at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def quantiles(sample: list[tuple[int, int]], ranges: int) -> list[tuple[int, int]]:
    """Distinct boundaries that cut a sorted sample into equal parts."""
    return sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)} if sample else ())


def drawn(rows: DataFrame, share: Column) -> list[tuple[int, int]]:
    """Sorted keys of rows drawn with probability ``share``, by a hash of the row's key."""
    coin = F.pmod(F.xxhash64("h", "row", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return sorted((r.h, r.s) for r in rows.filter(coin < share).select("h", "s").collect())


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    prepare(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
        F.monotonically_increasing_id().alias("row"),
    ))
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    fine = max(1, total // (shards * FINE))
    # Fewer than shards * FINE texts can hold more than that share each.
    heavy = rows.groupBy("h").agg(F.sum("size").alias("of")).filter(F.col("of") > fine).select("h", F.lit(True).alias("heavy"))
    rows = rows.join(F.broadcast(heavy), "h", "left").withColumn(
        "s", F.when(F.col("heavy"), F.col("row")).otherwise(F.lit(-1))
    )
    ranges = min(max(shards * 4, -(-n // RANGE_ROWS)), RANGES)
    splitters = quantiles(drawn(rows, F.col("size") * (ranges * SAMPLES / max(total, 1))), ranges)
    ranged = rows.withColumn("range", search(splitters, F.col("h"), F.col("s")))
    weight = total / ranges
    full = {r["range"]: r["of"] for r in ranged.groupBy("range").agg(F.sum("size").alias("of")).collect()}
    over = {k: -(-v // int(weight + 1)) for k, v in full.items() if v > 2 * weight}
    if over:  # at most ranges / 2 of them
        share = F.coalesce(*(F.when(F.col("range") == k, F.lit(SAMPLES * v / full[k])) for k, v in over.items()))
        sample = drawn(ranged.filter(F.col("range").isin(*over)), share * F.col("size"))
        edges = [None, *splitters, None]
        for k, parts in over.items():
            low, high = edges[k], edges[k + 1]
            inside = [x for x in sample if (low is None or x >= low) and (high is None or x < high)]
            splitters += quantiles(inside, parts)
        splitters = sorted(set(splitters))
        ranged = rows.withColumn("range", search(splitters, F.col("h"), F.col("s")))
    return placed(ranged, shards, total)


def placed(ranged: DataFrame, shards: int, total: int) -> DataFrame:
    """Shard and slot of every row, from exact sums over ranges and running sums within each."""
    spark = ranged.sparkSession
    before, sums = 0, []
    for r in sorted(ranged.groupBy("range").agg(F.sum("size").alias("of")).collect()):
        sums.append((r["range"], before))
        before += r["of"]
    starts = spark.createDataFrame(sums, "range int, before long")
    key = Window.partitionBy("range").orderBy("h", "s")
    row = Window.partitionBy("range").orderBy("h", "s", "row").rowsBetween(Window.unboundedPreceding, 0)
    # A key's rows share the place where the key begins, so they share a shard.
    begun = F.col("before") + F.sum("size").over(key) - F.sum("size").over(Window.partitionBy("range", "h", "s"))
    rows = (
        ranged.join(F.broadcast(starts), "range")  # one row a range
        .withColumn("shard", F.least(F.floor(begun * F.lit(shards) / F.lit(max(total, 1))), F.lit(shards - 1)).cast("int"))
        .withColumn("at", F.count("*").over(row))
    )
    rows = materialise(rows.select("doc_id", "size", "text_crc32", "range", "shard", "at"))
    # A shard is a run of ranges, cut at most at its two ends: a slot counts from the shard's first row.
    spans = rows.groupBy("range", "shard").agg(F.min("at").alias("first"), F.count("*").alias("n")).collect()
    filled, bases = dict.fromkeys(range(shards), 0), []
    for r in sorted(spans):
        bases.append((r["range"], r["shard"], filled[r["shard"]] - r["first"]))
        filled[r["shard"]] += r["n"]
    bases = spark.createDataFrame(bases, "range int, shard int, base long")
    return rows.join(F.broadcast(bases), ["range", "shard"]).select(  # a few rows a range
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("at") + F.col("base")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
