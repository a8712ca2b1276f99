"""Boosting against plain loops over rows, and preprocessing against plain NumPy."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskweave.operators import boosting, preprocessing
from riskweave.operators.preprocessing import ExactPreprocessor

GROWTH = boosting.Growth(rounds=6, depth=3, rate=0.3, rows=0.8, columns=0.7, seed=5)


def table(spark, seed, n, parts):
    """Rows of skewed, tied, two-valued and constant features; the label depends on two of them."""
    source = np.random.default_rng(seed)
    x = np.column_stack([
        source.normal(size=n), source.integers(0, 5, n), source.exponential(size=n).round(2), source.integers(0, 2, n), np.full(n, 3.0),
    ])
    y = (x[:, 0] + x[:, 1] - 2 + source.normal(size=n) > 0).astype(float)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, y double").repartition(parts)
    frame = frame.withColumn("features", array_to_vector(F.array(*"abcde"))).withColumn("draw", F.xxhash64("id"))
    draws = {r.id: r.draw for r in frame.select("id", "draw").collect()}
    return frame, x, y, np.array([draws[i] for i in range(n)], np.int64).view(np.uint64)


def plain_edges(x):
    out = []
    for column in x.T:
        values = np.sort(column)
        distinct = np.unique(values)
        if len(distinct) <= boosting.BINS:
            out.append(distinct[:-1])
        else:
            before = np.searchsorted(values, distinct, "left")
            cell = before * boosting.BINS // len(values)
            out.append(np.array([distinct[cell == c].max() for c in np.unique(cell)])[:-1])
    return out


def plain_trees(x, y, draw, weights, margin, growth):
    """The same rules, node by node over rows."""
    edges, w = plain_edges(x), np.where(y == 1, weights[1], weights[0])
    margins, out = np.full(len(y), margin), []
    for turn in range(growth.rounds):
        used = boosting.drawn(draw, turn, growth)
        columns = boosting.columns_of(turn, x.shape[1], growth)
        p = 1 / (1 + np.exp(-margins))
        g, h = w * (p - y), w * p * (1 - p)
        tree, nodes = [], [(np.ones(len(y), bool), 0)]
        steps = np.zeros(len(y))
        while nodes:
            rows, depth = nodes.pop(0)
            own = rows & used
            total = g[own].sum() ** 2 / (h[own].sum() + boosting.L2)
            best = None
            for f in columns if depth < growth.depth else []:
                for cut in edges[f]:
                    low = own & (x[:, f] <= cut)
                    high = own & ~(x[:, f] <= cut)
                    if min(h[low].sum(), h[high].sum()) < boosting.LEAST:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + boosting.L2) for s in (low, high)) - total
                    if gain > 1e-6 and (best is None or gain > best[0] * (1 + 1e-9)):
                        best = gain, int(f), float(cut)
            tree.append((best[1], best[2]) if best else None)
            if best:
                passes = x[:, best[1]] <= best[2]
                nodes += [(rows & passes, depth + 1), (rows & ~passes, depth + 1)]
            else:
                steps[rows] = -growth.rate * g[own].sum() / (h[own].sum() + boosting.L2)
        margins = margins + steps
        out.append(tree)
    return out, margins


def test_trees_equal_plain_loops_and_sets_do_not_meet(spark, monkeypatch):
    """Two training sets in one run, dealt out differently, each as if alone."""
    monkeypatch.setattr(boosting, "BINS", 32)
    monkeypatch.setattr(boosting, "CUT", 3)
    (f1, *one), (f2, *two) = table(spark, 1, 400, 3), table(spark, 2, 150, 2)
    sets = [(f1, (1.0, 1.5), 0.2), (f2, (1.0, 1.0), -0.1)]
    found = boosting.train(sets, "y", "draw", GROWTH)
    for trees, (x, y, draw), (frame, weights, margin) in zip(found, (one, two), sets):
        want, margins = plain_trees(x, y, draw, weights, margin, GROWTH)
        got = [[(f, t) if f >= 0 else None for f, t in zip(tree["feature"], tree["threshold"])] for tree in trees]
        assert got == want
        scored = boosting.BoostedModel.of(trees, margin, 5).transform(frame).orderBy("id").collect()
        assert [r.margin for r in scored] == pytest.approx(margins.tolist())
        assert all(r.probability[1] == pytest.approx(1 / (1 + np.exp(-r.margin))) for r in scored)


def test_dealing_out_does_not_change_trees(spark):
    grown = []
    for parts in (1, 5):
        frame = table(spark, 3, 300, parts)[0]
        trees = boosting.train([(frame, (1.0, 1.0), 0.0)], "y", "draw", GROWTH)[0]
        grown.append([(t["feature"], t["threshold"], t["left"]) for t in trees])
    assert grown[0] == grown[1]


def test_bins_of_many_values_are_cut_at_exact_ranks(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BINS", 10)
    frame, x, *_ = table(spark, 4, 500, 3)
    for got, want in zip(boosting.bin_edges([frame], 5)[0], plain_edges(x)):
        assert got.tolist() == want.tolist()


def test_histograms_add_up_row_by_row():
    source, growth = np.random.default_rng(9), boosting.Growth(rows=0.7, depth=3)
    n, offsets = 500, np.array([0, 4, 6, 13])
    bins = np.column_stack([source.integers(0, s, n) for s in np.diff(offsets)]).astype(np.uint8)
    label, draw = source.integers(0, 2, n).astype(float), source.integers(0, 2**63, n).astype(np.uint64)
    block = boosting.Block(0, bins, label, np.where(label == 1, 3.0, 1.0), draw, source.normal(size=n))
    tree = boosting.new_tree()  # 0 splits into 1, a leaf, and 2, which splits into 3 and 4
    tree |= {"feature": [2, -1, 0, -1, -1], "bin": [3, -1, 1, -1, -1], "left": [1, -1, 3, -1, -1], "right": [2, -1, 4, -1, -1]}
    want = np.zeros((2, 2, 13))
    for r in np.flatnonzero(boosting.drawn(draw, 4, growth)):
        if bins[r, 2] > 3:
            p = 1 / (1 + np.exp(-block.margin[r]))
            for f in range(3):
                at = int(bins[r, 0] > 1), offsets[f] + bins[r, f]
                want[0][at] += block.weight[r] * (p - label[r])
                want[1][at] += block.weight[r] * p * (1 - p)
    assert boosting.histogram(block, tree, [3, 4], offsets, 4, growth) == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_a_features_bins_lie_together(spark):
    frame, x, y, _ = table(spark, 6, 200, 2)
    edges = boosting.bin_edges([frame], 5)[0]
    found = boosting.blocks(frame, "y", "draw", (1.0, 2.0), 0, edges, 0.0).collect()
    assert sum(len(b.label) for b in found) == 200 and all(b.bins.T.flags.c_contiguous for b in found)
    want = np.column_stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)])
    assert sorted(map(tuple, np.vstack([b.bins for b in found]))) == sorted(map(tuple, want))


def test_ranks_with_one_range_are_counted_once(spark, monkeypatch):
    """An odd number of values has one middle rank; so has an even number until the ranks part."""
    passes, stacked = [], preprocessing._stacked
    monkeypatch.setattr(preprocessing, "_stacked", lambda frame, ranges, labels: passes.append(ranges) or stacked(frame, ranges, labels))
    frame = spark.createDataFrame([(float(k), float(k % 2)) for k in range(8)], "a double, b double")
    assert ExactPreprocessor(numeric=["a", "b"], categorical=[]).fit(frame).learned["medians"] == [3.5, 0.5]
    assert [len(ranges) for ranges in passes] == [2]


def test_one_class_and_one_row(spark):
    frame = spark.createDataFrame([(1, 0.5, 0.0)], "id long, a double, y double")
    frame = frame.withColumn("features", array_to_vector(F.array("a"))).withColumn("draw", F.xxhash64("id"))
    trees = boosting.train([(frame, (1.0, 1.0), 0.0)], "y", "draw", GROWTH)[0]
    assert len(trees) == GROWTH.rounds and all(t["left"] == [-1] for t in trees)


@pytest.mark.parametrize("n", [1, 2, 9, 1_000])
def test_preprocessing_equals_numpy(spark, tmp_path, n):
    source = np.random.default_rng(n)
    values = np.column_stack([source.normal(size=n) * 1e6, source.integers(0, 4, n), source.exponential(size=n) ** 9, np.full(n, 7.0), np.full(n, np.nan)])
    values[source.random((n, 5)) < 0.2] = np.nan
    labels = [[None, "x", "y", "it's"][k] for k in source.integers(0, 4, n)]
    rows = [(*(None if np.isnan(v) and k % 2 else float(v) for k, v in enumerate(r)), c) for r, c in zip(values, labels)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, k string").repartition(3)
    model = ExactPreprocessor(numeric=list("abcde"), categorical=["k"]).fit(frame)
    learned, filled = model.learned, values.copy()
    for k in range(5):
        known = values[~np.isnan(values[:, k]), k]
        assert learned["medians"][k] == (np.median(known) if len(known) else 0)
        filled[np.isnan(filled[:, k]), k] = learned["medians"][k]
    assert learned["means"] == pytest.approx(filled.mean(axis=0), rel=1e-9)
    spread = filled.std(axis=0)
    assert learned["scales"] == pytest.approx(np.where(spread > 1e-12, spread, 1), rel=1e-9)
    known = [c for c in labels if c is not None]
    assert learned["modes"] == [min(known, key=lambda c: (-known.count(c), c)) if known else ""]
    assert learned["categories"] == [sorted(set(known)) or [""]]
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert again.learned == learned and again.names == model.names
    assert again.transform(frame).exceptAll(model.transform(frame)).isEmpty()
