"""Mergeable sketches a day: distinct counts and quantiles of any span of days without its payments.

A day's row holds its totals, a HyperLogLog sketch of each counted column and a KLL sketch of each ranked
one. Rows of any days are merged on read; neither the order of merging nor how days were split matters
beyond the stated error. They stand beside the exact paths (``ranking``, ``aggregates``), never in their
place: a mart that is asked for many spans reads a few kilobytes a day.

Errors: a distinct count is off by about 1.04 / sqrt(2^``LG_K``), 1.6 % as one deviation; ``COUNT_BOUND``
is four of them. A quantile's rank is off by at most ``RANK_BOUND`` with 99 % certainty for ``K``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
K = 400
COUNT_BOUND = 0.065
RANK_BOUND = 0.01


def daily(frame: DataFrame, day: Column, counted: list[str], ranked: list[str]) -> DataFrame:
    """(day, rows, <c>_hll of counted columns, <r>_kll, <r>_sum of ranked ones): one aggregate, merged map-side."""
    return frame.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.hll_sketch_agg(c, LG_K).alias(f"{c}_hll") for c in counted),
        *(F.kll_sketch_agg_double(F.col(r).cast("double"), K).alias(f"{r}_kll") for r in ranked),
        *(F.sum(F.col(r).cast("double")).alias(f"{r}_sum") for r in ranked),
    )


def merged(days: DataFrame, by: list[Column] | None = None) -> DataFrame:
    """Days' rows merged, over all or by some columns, as rows of the same kind."""
    names = [c for c in days.columns if c.endswith(("_hll", "_kll"))]
    sums = [c for c in days.columns if c == "rows" or c.endswith("_sum")]
    return days.groupBy(*(by or [])).agg(
        *(F.sum(c).alias(c) for c in sums),
        *((F.hll_union_agg if c.endswith("_hll") else F.kll_merge_agg_double)(c).alias(c) for c in names),
    )


def distinct(column: str) -> Column:
    """Estimated number of values of a counted column."""
    return F.hll_sketch_estimate(f"{column}_hll")


def quantile(column: str, q: float) -> Column:
    """Estimated quantile of a ranked column."""
    return F.kll_sketch_get_quantile_double(F.col(f"{column}_kll"), F.lit(float(q)))
