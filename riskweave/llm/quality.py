"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow boosted trees are grown on labelled rows; every path from a root to a node is a rule, a
conjunction of bounds on statistics. A lasso logistic regression over the rules keeps few of them.
The model is a list of (rule, weight) and compiles to one Spark column expression.

Statistics are taken over whole texts. Labels train at most ``TRAIN_ROWS`` rows, those with the
smallest hash of doc_id among the rows offered; scoring covers every row.

Empty, blank and null texts have statistics of 0 and get a score like any other. Rows without a
label, or with a null doc_id, do not train; of several labels of one doc_id, the largest counts.
Repeated rows are scored as often as they come. An empty table gives no rows; without labels of
both kinds, every score is the share of label 1, or 0.5. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm import chunks
from riskweave.llm.common import byte_view, give_back, prepare, slices
from riskweave.llm.shingles import BASE, BYTES, INVERSE, powers
from riskweave.session import materialise

TRAIN_ROWS = 20_000
TREES = 20
DEPTH = 3
LASSO = 0.002
#: Bytes of text measured at a time; the arrays made of them take some 30 times as many.
SLICE = 1 << 20
STATISTICS = (
    "log_bytes", "log_words", "word_length", "capitals", "digits", "signs", "marks", "bangs", "high_bytes",
    "distinct_words", "top_word", "repeats", "line_words", "distinct_lines", "marked_words", "stops",
)


def table(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars.encode())] = 1
    return out


KINDS = {
    "capitals": table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": table("0123456789"),
    "signs": table("#$%&*+/<=>@\\^_`{|}~"), "marks": table(".,;:?"), "bangs": table("!"),
    "high_bytes": (np.arange(256) >= 128).astype(np.int64), "stops": table("."),
}
MARKED = table("#$%&*!|<>{}=") > 0


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Every statistic of each whole text."""
    bounds, data = byte_view(column)
    first, words, size = chunks.cut(column, signs=False)
    n_words = np.diff(first)
    some, full = np.maximum(n_words, 1), np.maximum(size, 1)
    codes = words.indices.to_numpy(False)
    doc = np.repeat(np.arange(len(size)), n_words)
    # How often each distinct word of a text occurs there.
    pairs, counts = np.unique(doc * (len(words.dictionary) + 1) + codes, return_counts=True)
    owner = pairs // (len(words.dictionary) + 1)
    top = np.zeros(len(size), np.int64)
    np.maximum.at(top, owner, counts)
    same = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    ends = np.append(chunks.starts_of(bounds, data, signs=False)[1:], len(data))
    last = data[ends - 1] if len(data) else data
    lines = line_hashes(bounds, data)
    out = {
        "log_bytes": np.log1p(size), "log_words": np.log1p(n_words), "word_length": size / some,
        "distinct_words": np.bincount(owner, minlength=len(size)) / some, "top_word": top / some,
        "repeats": np.bincount(doc[1:][same], minlength=len(size)) / some,
        "marked_words": np.bincount(doc[MARKED[last]], minlength=len(size)) / some,
        "line_words": n_words / np.maximum([len(x) for x in lines], 1),
        "distinct_lines": np.array([len(np.unique(x)) / max(len(x), 1) for x in lines]),
    }
    for name, kind in KINDS.items():
        sums = np.concatenate(([0], np.cumsum(kind[data])))
        out[name] = (sums[bounds[1:]] - sums[bounds[:-1]]) / full
    return {name: np.asarray(out[name], np.float64) for name in STATISTICS}


def line_hashes(bounds: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """A hash of every line of each text, by running sums of mixed bytes."""
    breaks = np.flatnonzero(data == 10)
    begins = np.zeros(len(data) + 1, bool)
    begins[breaks + 1] = begins[bounds] = True
    starts = np.flatnonzero(begins[:-1])
    ends = np.append(starts[1:], len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTES[data] * powers(BASE, len(data)), dtype=np.uint64)))
    hashes = (sums[ends] - sums[starts]) * powers(INVERSE, len(data))[starts]
    at = np.searchsorted(starts, bounds)
    return [hashes[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def measure(batches: Iterator[pa.RecordBatch], whole: bool = False) -> Iterator[pa.RecordBatch]:
    """The work of one task of ``measured``."""
    chunks.forget()
    give_back()
    for batch in slices(batches, size=SLICE):
        found = {k: pa.array(v) for k, v in statistics(batch["text"]).items()}
        carried = {c: batch[c] for c in ("text", "_row") if whole}
        yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"].cast(pa.int64())} | found | carried)


def measured(docs: DataFrame, whole: bool = False) -> DataFrame:
    """(doc_id, text statistics) of every row; if ``whole``, also text, and its other columns in ``_row``."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")] if whole else []
    rows = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_none"), *others).alias("_row"))
    schema = "doc_id long, " + ", ".join(f"{name} double" for name in STATISTICS)
    if whole:
        schema += f", text string, _row {rows.schema['_row'].dataType.simpleString()}"
    return rows.mapInArrow(partial(measure, whole=whole), schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction of bounds, ``low < statistic <= high``."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        parts = []
        for name, low, high in self.bounds:
            if low > float("-inf"):
                parts.append(F.col(name) > low)
            if high < float("inf"):
                parts.append(F.col(name) <= high)
        return reduce(Column.__and__, parts)


@dataclass(frozen=True)
class Model:
    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        """Probability of label 1, as one column expression."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def paths(node, bounds: dict[str, tuple[float, float]]) -> Iterator[Rule]:
    """The rules of a tree: its root's bounds grow with every split on the way down."""
    if bounds:
        yield Rule(tuple((name, *bounds[name]) for name in sorted(bounds)))
    if node.numDescendants():
        split = node.split()
        name, threshold = STATISTICS[split.featureIndex()], split.threshold()
        low, high = bounds.get(name, (float("-inf"), float("inf")))
        yield from paths(node.leftChild(), bounds | {name: (low, min(high, threshold))})
        yield from paths(node.rightChild(), bounds | {name: (max(low, threshold), high)})


def fit(train: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, limit: int = TRAIN_ROWS) -> Model:
    """Rules from statistics and ``label`` (0 or 1); at most ``limit`` rows, chosen by hash."""
    train = train.filter("doc_id is not null and label in (0, 1)")
    rows = materialise(train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    counts = {int(r.label): r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        ones, total = counts.get(1, 0), sum(counts.values())
        share = min(max(ones / total, 1e-6), 1 - 1e-6) if total else 0.5
        return Model((), float(np.log(share / (1 - share))))
    rows = rows.coalesce(2)
    frame = rows.select(array_to_vector(F.array(*STATISTICS)).alias("features"), F.col("label").cast("double").alias("label"))
    learner = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, maxBins=64, minInstancesPerNode=5)
    boosted = learner.fit(frame.persist())
    frame.unpersist()
    rules = sorted({rule for t in boosted.trees for rule in paths(t._java_obj.rootNode(), {})}, key=lambda r: r.bounds)
    hits = rows.select(
        array_to_vector(F.array(*(r.column().cast("double") for r in rules))).alias("features"),
        F.col("label").cast("double").alias("label"),
    ).persist()
    fitted = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(hits)
    hits.unpersist()
    kept = [(r, float(w)) for r, w in zip(rules, fitted.coefficients.toArray(), strict=True) if abs(w) > 1e-6]
    return Model(tuple(kept), float(fitted.intercept))


def held_out() -> Column:
    """Rows no label of which is learnt: crc32 of doc_id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def trained(found: DataFrame, labels: DataFrame) -> Model:
    """A model of the measured rows whose labels are not held out."""
    labels = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("label"))
    narrow = found.filter(~held_out()).select("doc_id", *STATISTICS)  # no texts in the join
    return fit(narrow.join(materialise(labels), "doc_id"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, trained on the labels that are not held out."""
    prepare(docs.sparkSession)
    found = materialise(measured(docs))
    model = trained(found, labels)
    scored = found.select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the classifier does not reject, with all their columns.

    Statistics ride along with the rows, so that no row is looked up again by its doc_id.
    """
    prepare(docs.sparkSession)
    found = materialise(measured(docs, whole=True))
    kept = found.filter(trained(found, labels).score() >= 0.5)
    return kept.select(*(c if c in ("doc_id", "text") else F.col("_row")[c].alias(c) for c in docs.columns))
