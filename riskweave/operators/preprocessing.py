"""Preprocessing as one estimator: exact medians, population scale, modes and one-hot categories.

Medians of all numbers are found together by refining histograms: a pass cuts each column's open range
into ``CELLS`` cells and counts rows a cell; the cell that holds the middle rank is the next range, until
all its rows are equal. A pass is one aggregate, merged before the shuffle, and a range shrinks by
``CELLS`` each time, so a few passes are exact whatever the table's size. Categories are counted in the
first of them.

The scale is the population deviation after filling, computed from moments without filling any row. A
number without any value is filled with 0, a category without any with the empty text, and a constant
number is only centred. Null and NaN count as missing. Unknown categories become zeros.
"""

from __future__ import annotations

import json
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 4_096


def number(name: str) -> Column:
    """A numeric column as double, NaN as missing."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def moments(frame: DataFrame, numeric: list[str]) -> dict[str, dict]:
    """Per column its rows, values, extremes, mean and population variance: one aggregate."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for k, c in enumerate(numeric):
        x = number(c)
        of = {"n": F.count(x), "low": F.min(x), "high": F.max(x), "mean": F.avg(x), "var": F.var_pop(x)}
        aggregates += [a.alias(f"{name}{k}") for name, a in of.items()]
    row = frame.agg(*aggregates).first()
    return {
        c: {"rows": row["rows"], **{name: row[f"{name}{k}"] for name in ("n", "low", "high", "mean", "var")}}
        for k, c in enumerate(numeric)
    }


def _cell(x: Column, low: float, high: float) -> Column:
    """Cell of a value in a range, from 0; monotone in the value."""
    place = (x - F.lit(low)) / F.lit((high - low) or 1.0) * F.lit(float(CELLS))
    return F.least(F.greatest(F.floor(place), F.lit(0)), F.lit(CELLS - 1)).cast("int")


def _stacked(frame: DataFrame, ranges: dict[int, tuple[str, float, float]], categorical: list[str]) -> DataFrame:
    """(slot, cell, label, n, low, high): rows a cell of each open range, and rows a label of each category."""
    entries = [
        F.when((number(c) >= low) & (number(c) <= high), F.struct(
            F.lit(slot).alias("slot"), _cell(number(c), low, high).alias("cell"), F.lit(None).cast("string").alias("label"), number(c).alias("x"),
        ))
        for slot, (c, low, high) in ranges.items()
    ] + [
        F.when(F.col(c).isNotNull(), F.struct(
            F.lit(-1 - k).alias("slot"), F.lit(None).cast("int").alias("cell"), F.col(c).cast("string").alias("label"), F.lit(None).cast("double").alias("x"),
        ))
        for k, c in enumerate(categorical)
    ]
    rows = frame.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    return rows.groupBy("slot", "cell", "label").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))


def medians_and_labels(
    frame: DataFrame, numeric: list[str], categorical: list[str], known: dict[str, dict]
) -> tuple[dict[str, float], dict[str, dict[str, int]]]:
    """(exact median of every number, count of every label of every category)."""
    # Two middle ranks a column, equal for an odd count: each is a slot of its own with an open range.
    open_, found, labels = {}, {}, {c: {} for c in categorical}
    for k, c in enumerate(numeric):
        of = known[c]
        for side, rank in enumerate(((of["n"] - 1) // 2, of["n"] // 2)):
            if of["n"]:
                open_[2 * k + side] = (c, of["low"], of["high"], rank)
    first = True
    while open_ or (first and categorical):
        # Ranks with one open range share its cells.
        holders: dict[tuple, int] = {}
        for slot, (*span, _) in open_.items():
            holders.setdefault(tuple(span), slot)
        # At most CELLS rows a range, and one a label.
        rows = _stacked(frame, {slot: span for span, slot in holders.items()}, categorical if first else []).collect()
        first = False
        cells: dict[int, list] = {slot: [] for slot in holders.values()}
        for r in sorted(rows, key=lambda r: (r["slot"], r["cell"] or 0)):
            if r["slot"] < 0:
                labels[categorical[-1 - r["slot"]]][r["label"]] = r["n"]
            else:
                cells[r["slot"]].append(r)
        for slot, (c, low, high, rank) in list(open_.items()):
            before = 0
            for r in cells[holders[c, low, high]]:
                if rank < before + r["n"]:
                    if r["low"] == r["high"]:
                        found[slot] = r["low"]
                        del open_[slot]
                    else:
                        open_[slot] = (c, r["low"], r["high"], rank - before)
                    break
                before += r["n"]
    return {c: (found[2 * k] + found[2 * k + 1]) / 2 if 2 * k in found else 0.0 for k, c in enumerate(numeric)}, labels


class _State(Params):
    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "category columns", TypeConverters.toListString)


class ExactPreprocessor(Estimator, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians, means, scales, modes and categories; see the module."""

    @keyword_only
    def __init__(self, *, numeric: list[str] | None = None, categorical: list[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ExactPreprocessorModel:
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        known = moments(dataset, numeric)
        medians, labels = medians_and_labels(dataset, numeric, categorical, known)
        means, scales = [], []
        for c in numeric:
            n, rows, fill = known[c]["n"], known[c]["rows"], medians[c]
            mean, var = (known[c]["mean"], known[c]["var"]) if n else (0.0, 0.0)
            whole = (n * mean + (rows - n) * fill) / max(rows, 1)
            square = n * (var + (mean - whole) ** 2) + (rows - n) * (fill - whole) ** 2
            means.append(whole)
            # A constant column has no spread but for rounding.
            spread = known[c]["low"] != known[c]["high"] or (0 < n < rows and fill != mean)
            scales.append(math.sqrt(square / rows) if n and spread and square > 0 else 1.0)
        modes = {c: min(labels[c], key=lambda x: (-labels[c][x], x), default="") for c in categorical}
        state = {
            "medians": [medians[c] for c in numeric], "means": means, "scales": scales,
            "modes": [modes[c] for c in categorical],
            "categories": [sorted(labels[c] or [""]) for c in categorical],
        }
        model = ExactPreprocessorModel()
        return model._set(numeric=numeric, categorical=categorical, state=json.dumps(state))


class ExactPreprocessorModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``features``: standardised numbers, then a slot for each category."""

    state = Param(Params._dummy(), "state", "what was learned, as JSON", TypeConverters.toString)

    @property
    def learned(self) -> dict:
        return json.loads(self.getOrDefault("state"))

    @property
    def names(self) -> list[str]:
        """Names of the slots of the feature vector."""
        hot = zip(self.getOrDefault("categorical"), self.learned["categories"], strict=True)
        return [f"numeric__{c}" for c in self.getOrDefault("numeric")] + [f"category__{c}_{x}" for c, values in hot for x in values]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        learned, slots = self.learned, []
        for c, fill, mean, scale in zip(
            self.getOrDefault("numeric"), *(learned[k] for k in ("medians", "means", "scales")), strict=True
        ):
            slots.append((F.coalesce(number(c), F.lit(fill)) - F.lit(mean)) / F.lit(scale))
        for c, mode, values in zip(self.getOrDefault("categorical"), learned["modes"], learned["categories"], strict=True):
            filled = F.coalesce(F.col(c).cast("string"), F.lit(mode))
            slots += [F.when(filled == F.lit(x), 1.0).otherwise(0.0) for x in values]
        return dataset.withColumn("features", array_to_vector(F.array(*slots)))
