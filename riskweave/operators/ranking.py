"""Exact ranks, running totals and percentiles without a global window over rows.

Rows are first merged to distinct values, which also dissolves hot values. The values are then
range-partitioned, about ``RANGE_VALUES`` to a range, every range is ranked on its own, and the
totals of the earlier ranges (one row per range) are added. The ranges only balance the work:
results do not depend on where they are cut. Shorter ranges can be asked for; they are made while
there are at most ``SHORT_RANGES`` of them, as each is a task, and get longer beyond.

Null and NaN values have no rank: they are left out of ranks, counts and totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.session import materialise

RANGE_VALUES = 200_000
SHORT_RANGES = 200


def ranked_value(frame: DataFrame, value: str) -> Column:
    """Whether a row's value has a rank."""
    column = F.col(value)
    if frame.schema[value].dataType.typeName() in ("double", "float"):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


def running_totals(
    groups: DataFrame, value: str, counts: list[str], by: list[str] | None = None, range_values: int = RANGE_VALUES
) -> DataFrame:
    """Adds, for each count column c, ``c_before`` (over smaller values) and ``c_total``.

    ``groups`` holds one row per (by, value). It is computed once and kept.
    """
    by = by or []
    # Filtered only once written: a filter on computed values would compute them a second time.
    kept = materialise(groups)
    kept = kept.where(ranked_value(kept, value))
    values = kept.count()
    ranges = max(1, min(-(-values // range_values), max(SHORT_RANGES, -(-values // RANGE_VALUES))))
    cut = materialise(kept.repartitionByRange(ranges, *by, value).withColumn("range", F.spark_partition_id()))
    per_range = cut.groupBy(*by, "range").agg(*[F.sum(c).alias(c) for c in counts])
    earlier = W.partitionBy(*by).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        *by, "range",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_offset") for c in counts],
        *[F.sum(c).over(W.partitionBy(*by)).alias(f"{c}_total") for c in counts],
    )
    smaller = W.partitionBy(*by, "range").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    ranked = cut.select(
        "*", *[F.coalesce(F.sum(c).over(smaller), F.lit(0)).alias(f"{c}_inside") for c in counts]
    )
    return (
        ranked.join(offsets, [*by, "range"])
        .withColumns({f"{c}_before": F.col(f"{c}_inside") + F.col(f"{c}_offset") for c in counts})
        .drop("range", *[f"{c}_inside" for c in counts], *[f"{c}_offset" for c in counts])
    )


def value_counts_of(frame: DataFrame, column: str) -> DataFrame:
    return (
        frame.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def at_rank(rank: Column, value: str = "value", n: str = "n") -> Column:
    """Aggregate: the value at a zero-based rank."""
    inside = (F.col(f"{n}_before") <= rank) & (rank < F.col(f"{n}_before") + F.col(n))
    return F.max(F.when(inside, F.col(value)))


def percentile(q: float, value: str = "value", n: str = "n") -> Column:
    """Aggregate: exact percentile with linear interpolation."""
    position = (F.col(f"{n}_total") - 1) * F.lit(float(q))
    low, high = at_rank(F.floor(position), value, n), at_rank(F.ceil(position), value, n)
    return low + (high - low) * F.max(position - F.floor(position))


def exact_percentiles(frame: DataFrame, column: str, qs: dict[str, float]) -> DataFrame:
    ranked = running_totals(value_counts_of(frame, column), "value", ["n"])
    return ranked.agg(*[percentile(q).alias(name) for name, q in qs.items()])


def describe(
    frame: DataFrame, column: str, percentiles: tuple[float, ...] = (0.25, 0.5, 0.75), range_values: int = RANGE_VALUES
) -> DataFrame:
    """count, mean, sample std, min, percentiles, max as one row."""
    ranked = running_totals(value_counts_of(frame, column), "value", ["n"], range_values=range_values)
    v, n = F.col("value").cast("double"), F.col("n")
    mean = ranked.agg(F.sum(v * n) / F.sum(n)).scalar()
    return ranked.agg(
        F.sum(n).alias("count"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
        F.sqrt(F.try_divide(F.sum(n * F.pow(v - mean, F.lit(2))), F.sum(n) - 1)).alias("std"),
        F.min("value").cast("double").alias("min"),
        *[percentile(q).cast("double").alias(f"p{q * 100:g}") for q in percentiles],
        F.max("value").cast("double").alias("max"),
    )


def clip_at_percentile(frame: DataFrame, column: str, q: float) -> DataFrame:
    """Rows whose value lies in [0, q-th percentile]."""
    limit = exact_percentiles(frame, column, {"limit": q}).scalar()
    return frame.where((F.col(column) >= 0) & (F.col(column) <= limit))
