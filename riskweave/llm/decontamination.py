"""Benchmark decontamination: SimHash fingerprints of item-sized windows, then exact similarity.

A window is as many words of a document as the benchmark item has (the whole document, if shorter).
A document is contaminated by an item if one of its windows has weighted Jaccard similarity >= 3/4
with it: shingles of five words (all words, if an item has fewer), weighted by their number of
occurrences, common weight over joint weight.

1. Distinct texts' shingles meet the benchmark's. Only windows with enough common shingles to reach
   the similarity with an item can count; and moving a window right to its next common shingle loses
   none, so only windows that begin at one, or end with the text, are taken, each with its item.
2. Windows and items get 64-bit SimHashes. Fingerprints are cut into ``RADIUS`` + 1 blocks; two
   within ``RADIUS`` bits agree in one block at least, so joining on (item, block, bits) finds all
   of a window's items within the radius.
3. Survivors are compared exactly.

The radius is safe for pairs in which no shingle repeats and both sides have ``SHORT`` shingles or
more: at the threshold 17 % of the bits differ, 11 with a deviation of 3. Fingerprints of other pairs
prove nothing (one heavy shingle can turn every bit), so those go from step 1 to step 3.

Words are runs of characters other than ASCII white space, A-Z lower-cased. Null and empty texts
are clean. Items with equal words are compared once and reported under each of their ids; items with
a null id count as one item that ``item_ids`` does not list; items without words match nothing. Each
row is judged by its own text, whatever rows share its doc_id, and also with a null doc_id. Empty
tables give no rows, or clean ones. Only doc_id, text, and item_id, text are read, so other columns
cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import prepare
from riskweave.session import materialise

WIDTH = 5
RADIUS = 30
BITS = 64
SHORT = 24
#: Places of a text whose windows travel in one row.
STRETCH = 256
#: The benchmark's shingles are broadcast up to this many rows of 40 bytes.
BROADCAST_ROWS = 500_000
#: Counters of 20 bits, three to a long, so that adding never reaches the sign: a million shingles.
LANES, LANE = 3, 20


def word_hashes(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    words = F.array_remove(F.split(lower, r"[\x20\x09-\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(hashes: Column, width: int, begin: Column, end: Column) -> Column:
    """Hashes of the shingles that begin at places ``begin`` to ``end``, inclusive."""
    at = F.transform(
        F.sequence(begin, end), lambda i: F.xxhash64(F.lit(width), *(F.get(hashes, i + k) for k in range(width)))
    )
    return F.when(end >= begin, at).otherwise(F.array().cast("array<bigint>"))


def set_bits(hashes: Column, places: range) -> Column:
    """How many hashes have each of the bits set, in lanes of one long."""

    def spread(x: Column) -> Column:
        bit = [F.shiftleft(F.shiftrightunsigned(x, p).bitwiseAND(1), LANE * k) for k, p in enumerate(places)]
        return sum(bit[1:], bit[0])

    return F.aggregate(hashes, F.lit(0).cast("long"), lambda total, x: total + spread(x))


def simhash(hashes: Column) -> Column:
    """The sign, for each bit, of how often shingles have it set or not."""
    out = F.lit(0).cast("long")
    for first in range(0, BITS, LANES):
        places = range(first, min(first + LANES, BITS))
        counts = set_bits(hashes, places)
        for k, place in enumerate(places):
            count = F.shiftrightunsigned(counts, LANE * k).bitwiseAND((1 << LANE) - 1)
            bit = F.lit(1 << place if place < 63 else -(1 << 63)).cast("long")
            out = out.bitwiseOR(F.when(2 * count > F.size(hashes), bit).otherwise(F.lit(0).cast("long")))
    return out


def text_key(text: Column) -> list[Column]:
    """Two hashes that stand for a text; null is as empty."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(plain).alias("t"), F.xxhash64(F.lit(1), plain).alias("u")]


def sound(hashes: Column) -> Column:
    """Whether a fingerprint says something: many shingles, none of them twice."""
    return (F.size(hashes) >= SHORT) & (F.size(F.array_distinct(hashes)) == F.size(hashes))


def items_of(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, w, k, hashes, print, sound) of distinct items: number, size in words, shingle width, shingles.

    And (item, item_id) with all their ids.
    """
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_hashes(F.col("text")).alias("h"))
    rows = rows.withColumn("w", F.size("h")).filter("w > 0").withColumn("k", F.least("w", F.lit(WIDTH)))
    rows = rows.withColumn("item", F.xxhash64("h"))
    rows = materialise(rows)
    ids = materialise(rows.select("item", "item_id").distinct())
    items = materialise(rows.drop("item_id").dropDuplicates(["item"]))
    by_width = [
        items.filter(F.col("k") == k).withColumn("hashes", shingles(F.col("h"), k, F.lit(0), F.col("w") - k))
        for k in range(1, WIDTH + 1)
    ]
    out = by_width[0]
    for part in by_width[1:]:
        out = out.union(part)
    hashes = F.col("hashes")
    out = out.select("item", "w", "k", "hashes", simhash(hashes).alias("print"), sound(hashes).alias("sound"))
    return materialise(out), ids


def starts(docs: DataFrame, items: DataFrame) -> DataFrame | None:
    """(t, u, item, w, k, start) of the windows with enough shingles in common with the item, of w words."""
    marks = items.select("item", "w", "k", F.size("hashes").alias("size"), F.explode("hashes").alias("hash")).distinct()
    marks = materialise(marks)
    if marks.count() <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    widths = [r.k for r in items.select("k").distinct().collect()]  # five at most
    hashed = docs.select(*text_key(F.col("text")), word_hashes(F.col("text")).alias("h")).withColumn("n", F.size("h"))
    found = None
    for k in widths:
        rows = hashed.filter(F.col("n") >= k)
        rows = rows.select("t", "u", "n", F.posexplode(shingles(F.col("h"), k, F.lit(0), F.col("n") - k)).alias("at", "hash"))
        found = rows if found is None else found.union(rows)
    if found is None:
        return None
    places = found.join(marks, "hash").groupBy("t", "u", "item", "w", "k", "size", "n").agg(
        F.sort_array(F.collect_set("at")).alias("at")
    )
    # Common shingles that a similarity of 3/4 takes: 3/7 of both sizes.
    need = F.ceil((F.least("n", "w") - F.col("k") + 1 + F.col("size")) * 3 / F.lit(7) - 1e-9).cast("int")
    last = F.greatest(F.col("n") - F.col("w"), F.lit(0))
    places = places.withColumn("need", need).withColumn("last", last)
    inside = F.filter("at", lambda p, j: (p <= F.col("last")) & F.coalesce(
        F.get("at", j + F.col("need") - 1) <= p + F.col("w") - F.col("k"), F.lit(False)
    ))
    at_end = F.size(F.filter("at", lambda p: p >= F.col("last"))) >= F.col("need")
    begins = F.when(at_end, F.array_union(inside, F.array("last"))).otherwise(inside)
    return materialise(places.select("t", "u", "item", "w", "k", F.explode(begins).alias("start")))


def windows_of(docs: DataFrame, begins: DataFrame) -> DataFrame:
    """(window, t, u, w, k, start, hashes, print, sound) of the chosen windows, each once and numbered."""
    stretch = F.floor(F.col("start") / STRETCH)
    chosen = begins.select("t", "u", "w", "k", "start").distinct().groupBy("t", "u", stretch.alias("stretch"))
    chosen = materialise(chosen.agg(F.collect_list(F.struct("w", "k", "start")).alias("windows")))
    wanted = chosen.select("t", "u").distinct()
    # Texts that come in many rows are merged before they meet their windows.
    texts = docs.select(*text_key(F.col("text")), "text").join(wanted, ["t", "u"]).dropDuplicates(["t", "u"])
    texts = materialise(texts.select("t", "u", word_hashes(F.col("text")).alias("h")))
    rows = texts.join(chosen, ["t", "u"])
    rows = materialise(rows.select("t", "u", "h", F.explode("windows").alias("x")).select("t", "u", "h", "x.*"))
    end = F.least(F.col("start") + F.col("w"), F.size("h"))
    hashes = F.array().cast("array<bigint>")
    for k in range(1, WIDTH + 1):
        hashes = F.when(F.col("k") == k, shingles(F.col("h"), k, F.col("start"), end - k)).otherwise(hashes)
    rows = materialise(rows.select("t", "u", "w", "k", "start", hashes.alias("hashes")))
    rows = rows.withColumns({"print": simhash(F.col("hashes")), "sound": sound(F.col("hashes"))})
    return materialise(rows.withColumn("window", F.monotonically_increasing_id()))


def blocks(name: str) -> Column:
    """The fingerprint's blocks as (place, bits)."""
    edges = [BITS * b // (RADIUS + 1) for b in range(RADIUS + 2)]
    return F.explode(F.array(*(
        F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(name, low).bitwiseAND((1 << (high - low)) - 1).alias("bits"))
        for b, (low, high) in enumerate(zip(edges, edges[1:], strict=False))
    )))


def near(links: DataFrame, windows: DataFrame, items: DataFrame) -> DataFrame:
    """The (window, item) of ``links`` whose fingerprints are within the radius, by way of equal blocks."""
    left = links.join(windows.select("window", "print"), "window")
    left = left.select("window", "item", "print", blocks("print").alias("x")).select("window", "item", "print", "x.*")
    right = items.select("item", F.col("print").alias("other"), blocks("print").alias("x")).select("item", "other", "x.*")
    pairs = left.join(right, ["item", "block", "bits"])
    pairs = pairs.filter(F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= RADIUS)
    return pairs.select("window", "item").distinct()


def matches(begins: DataFrame, windows: DataFrame, items: DataFrame) -> DataFrame:
    """(t, u, item, similarity) of texts with a window whose fingerprint and then shingles match."""
    numbers = windows.select("t", "u", "w", "k", "start", "window", "sound")
    links = begins.join(numbers, ["t", "u", "w", "k", "start"]).select("window", "item", "sound")
    links = links.join(items.select("item", F.col("sound").alias("other")), "item")
    links = materialise(links.select("window", "item", (F.col("sound") & F.col("other")).alias("sound")))
    told = near(links.filter("sound").drop("sound"), windows, items)
    pairs = materialise(told.union(links.filter("not sound").drop("sound")))
    ours = windows.select("window", F.size("hashes").alias("a"), F.explode("hashes").alias("hash"))
    ours = ours.groupBy("window", "a", "hash").agg(F.count("*").alias("x"))
    theirs = items.select("item", F.size("hashes").alias("b"), F.explode("hashes").alias("hash"))
    theirs = materialise(theirs.groupBy("item", "b", "hash").agg(F.count("*").alias("y")))
    common = pairs.join(materialise(ours), "window").join(theirs, ["item", "hash"])
    common = common.groupBy("window", "item", "a", "b").agg(F.sum(F.least("x", "y")).alias("c"))
    joint = F.col("a") + F.col("b") - F.col("c")
    similar = common.filter(4 * F.col("c") >= 3 * joint).withColumn("similarity", F.col("c") / joint)
    similar = similar.join(windows.select("window", "t", "u"), "window")
    return similar.groupBy("t", "u", "item").agg(F.max("similarity").alias("similarity"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(t, u, item_ids, n_items, similarity) of contaminated texts."""
    prepare(docs.sparkSession)
    docs = docs.select("text")
    items, ids = items_of(benchmark)
    begins = starts(docs, items)
    if begins is None:
        kind = "t long, u long, item_ids array<bigint>, n_items long, similarity double"
        return docs.sparkSession.createDataFrame([], kind)
    found = matches(begins, windows_of(docs, begins), items).join(ids, "item")
    unnamed = F.max(F.col("item_id").isNull().cast("long"))
    found = found.groupBy("t", "u").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), unnamed.alias("unnamed"), F.max("similarity").alias("similarity")
    )
    return found.select("t", "u", "item_ids", (F.size("item_ids") + F.col("unnamed")).alias("n_items"), "similarity")


def mark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, similarity) of every row."""
    found = materialise(contaminated(docs, benchmark))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text"))).join(found, ["t", "u"], "left")
    return rows.select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        "item_ids", F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    found = materialise(contaminated(docs, benchmark).select("t", "u"))
    t, u = text_key(F.col("text"))
    return docs.join(found, (t == found["t"]) & (u == found["u"]), "left_anti").select(docs.columns)
