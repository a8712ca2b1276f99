"""Sketches a day against exact results, in any order of merging."""

import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import daily_sketches as sketches


@pytest.fixture(scope="module")
def rows():
    source = random.Random(8)
    return [(d, source.randrange(6_000), source.choice([source.expovariate(0.01), 5.0])) for d in range(12) for _ in range(2_000)]


@pytest.fixture(scope="module")
def days(spark, rows, tmp_path_factory):
    frame = spark.createDataFrame(rows, "d int, who long, amount double").repartition(7)
    path = str(tmp_path_factory.mktemp("sketches") / "days")
    sketches.daily(frame, F.col("d"), ["who"], ["amount"]).write.parquet(path)
    return spark.read.parquet(path)


def rank_error(values, value, q):
    below, upto = sum(v < value for v in values) / len(values), sum(v <= value for v in values) / len(values)
    return max(0.0, below - q, q - upto)


@pytest.mark.parametrize(("low", "high"), [(0, 12), (3, 4), (2, 9)])
def test_spans_of_days_stay_within_the_bounds(days, rows, low, high):
    span = days.where((F.col("day") >= low) & (F.col("day") < high))
    got = sketches.merged(span).select("rows", "amount_sum", sketches.distinct("who").alias("n"), *(
        sketches.quantile("amount", q).alias(f"q{k}") for k, q in enumerate((0.0, 0.25, 0.5, 0.9, 0.99, 1.0))
    )).first()
    own = [r for r in rows if low <= r[0] < high]
    exact = len({r[1] for r in own})
    assert got.rows == len(own) and got.amount_sum == pytest.approx(sum(r[2] for r in own))
    assert abs(got.n - exact) <= sketches.COUNT_BOUND * exact
    for k, q in enumerate((0.0, 0.25, 0.5, 0.9, 0.99, 1.0)):
        assert rank_error([r[2] for r in own], got[f"q{k}"], q) <= sketches.RANK_BOUND


def test_order_of_merging_does_not_matter(days, rows):
    """All at once, in halves, in pairs: the same distinct count, quantiles within the bound."""
    values = [r[2] for r in rows]
    seen = []
    for parts in (1, 2, 6):
        first = sketches.merged(days.withColumn("part", F.pmod(F.hash("day"), F.lit(parts))), [F.col("part")])
        whole = sketches.merged(first.drop("part"))
        seen.append(whole.select(sketches.distinct("who").alias("n"), sketches.quantile("amount", 0.5).alias("m"), "rows").first())
    assert len({s.n for s in seen}) == 1 and len({s.rows for s in seen}) == 1
    assert all(rank_error(values, s.m, 0.5) <= sketches.RANK_BOUND for s in seen)


def test_nulls_and_empty_spans(spark):
    frame = spark.createDataFrame([(1, None, None), (1, 5, 2.0), (2, None, None)], "d int, who long, amount double")
    days = sketches.daily(frame, F.col("d"), ["who"], ["amount"])
    row = sketches.merged(days).select("rows", sketches.distinct("who").alias("n"), sketches.quantile("amount", 0.5).alias("m")).first()
    assert (row.rows, row.n, row.m) == (3, 1, 2.0)
    assert sketches.merged(days.limit(0)).first().rows is None
