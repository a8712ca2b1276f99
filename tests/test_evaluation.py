import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import evaluation, ranking, sampling


def labelled(spark, pairs):
    return spark.createDataFrame(pairs, "y int, p double")


def brute_auc(pairs):
    wins = [(a > b) + 0.5 * (a == b) for y, a in pairs if y for z, b in pairs if not z]
    return sum(wins) / len(wins)


def brute_ap(pairs):
    positives = sum(y for y, _ in pairs)
    total, last = 0.0, 0
    for t in sorted({p for _, p in pairs}, reverse=True):
        reached = [y for y, p in pairs if p >= t]
        total += (sum(reached) - last) / positives * sum(reached) / len(reached)
        last = sum(reached)
    return total


def test_four_scores(spark):
    frame = labelled(spark, [(0, 0.1), (0, 0.8), (1, 0.2), (1, 0.9)])
    row = evaluation.confusion(frame, "y", "p", 0.5).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (1, 1, 1, 1)
    assert row.precision == row.recall == row.f1 == row.false_positive_rate == 0.5


def test_nothing_flagged_gives_zero_rates(spark):
    row = evaluation.full_metrics(labelled(spark, [(0, 0.1), (0, 0.2)]), "y", "p", 0.5).first()
    assert (row.precision, row.recall, row.f1, row.pr_auc_ap) == (0.0, 0.0, 0.0, 0.0)
    assert row.roc_auc is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranking_metrics_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = [(int(rng.random() < 0.4), round(rng.random(), 1 + seed % 2)) for _ in range(150)]
    row = evaluation.full_metrics(labelled(spark, pairs), "y", "p", 0.5).first()
    assert row.roc_auc == pytest.approx(brute_auc(pairs))
    assert row.pr_auc_ap == pytest.approx(brute_ap(pairs))


@pytest.mark.parametrize("range_values", [1, 7, 1000])
def test_running_totals_do_not_depend_on_the_ranges(spark, range_values):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.choice([5.0] * 30 + [rng.gauss(0, 100) for _ in range(60)])) for _ in range(400)]
    frame = spark.createDataFrame(rows, "g string, v double")
    groups = frame.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = ranking.running_totals(groups, "v", ["n"], ["g"], range_values).collect()
    for r in got:
        mine = [v for g, v in rows if g == r.g]
        assert r.n_before == sum(v < r.v for v in mine) and r.n_total == len(mine)


def test_short_ranges_do_not_become_ever_more_tasks(spark, monkeypatch):
    cut, materialise = [], ranking.materialise
    monkeypatch.setattr(ranking, "SHORT_RANGES", 7)
    monkeypatch.setattr(ranking, "materialise", lambda frame: cut.append(materialise(frame)) or cut[-1])
    groups = spark.range(300).select(F.col("id").alias("value"), F.lit(2).cast("long").alias("n"))
    rows = ranking.running_totals(groups, "value", ["n"], range_values=5).collect()
    assert cut[-1].agg(F.count_distinct("range")).first()[0] <= 7
    assert sorted((r.value, r.n_before, r.n_total) for r in rows) == [(v, 2 * v, 600) for v in range(300)]


def test_scores_are_computed_once_to_be_ranked(spark):
    """A row's score is costly: leaving out rows without a rank must not compute it again."""
    calls = spark.sparkContext.accumulator(0)

    def counted(x):
        calls.add(1)
        return None if x == 3 else float("nan") if x == 4 else x / 10

    frame = spark.range(60).selectExpr("id % 6 AS x", "id % 2 AS y").repartition(3)
    groups = evaluation.score_groups(frame.withColumn("p", F.udf(counted, "double")("x")), "y", "p")
    got = {r.score: (r.pos, r.neg, r.pos_before, r.neg_total) for r in ranking.running_totals(groups, "score", ["pos", "neg"]).collect()}
    assert got == {0.0: (0, 10, 0, 20), 0.1: (10, 0, 0, 20), 0.2: (0, 10, 10, 20), 0.5: (10, 0, 10, 20)}
    assert calls.value == 60


def test_percentiles_interpolate(spark):
    frame = spark.createDataFrame([(float(x),) for x in (1, 2, 2, 10)], "v double")
    row = ranking.exact_percentiles(frame, "v", {"p0": 0, "p50": 0.5, "p90": 0.9, "p100": 1}).first()
    assert tuple(row) == pytest.approx((1.0, 2.0, 7.6, 10.0))
    stats = ranking.describe(frame, "v").first()
    assert stats["count"] == 4 and stats["mean"] == 3.75 and stats["std"] == pytest.approx(4.193248541803041)


def test_splits_fall_between_timestamps(spark, at):
    # 100 rows, 10 per timestamp, and one timestamp that holds a third of them
    rows = [(i, at(5 if 30 <= i < 63 else i // 10)) for i in range(100)]
    frame = spark.createDataFrame(rows, "i int, timestamp timestamp")
    split = evaluation.with_split(frame)
    per_time = split.groupBy("timestamp").agg(F.count_distinct("evaluation_split").alias("n"))
    assert per_time.where("n > 1").isEmpty()
    report = {r.evaluation_split: r for r in evaluation.split_report(split).collect()}
    assert report["train"].end < report["validation"].start <= report["validation"].end < report["test"].start


def test_sweep_and_choice(spark):
    rng = random.Random(4)
    pairs = [(int(rng.random() < 0.5), rng.random()) for _ in range(200)]
    groups = evaluation.score_groups(labelled(spark, pairs), "y", "p")
    sweep = evaluation.threshold_sweep(groups).collect()
    assert len(sweep) == 17 and sweep[7].threshold == 0.45000000000000007
    for r in sweep:
        fn = sum(y and p < r.threshold for y, p in pairs)
        fp = sum((not y) and p >= r.threshold for y, p in pairs)
        assert r.validation_cost == 5 * fn + fp
    best = evaluation.choose_threshold(evaluation.threshold_sweep(groups)).first()
    assert (best.validation_cost, best.threshold) == min((r.validation_cost, r.threshold) for r in sweep)


def test_model_choice_goes_by_cost_then_name(spark):
    rows = [("b", 0.1, 5), ("a", 0.2, 5), ("c", 0.3, 6)]
    frame = spark.createDataFrame(rows, "model string, threshold double, validation_cost int")
    assert evaluation.choose_model(frame).first().model == "a"


def test_samples_do_not_depend_on_the_partitioning(spark):
    frame = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7 == 0).alias("rare"))
    for run in (sampling.fixed_sample, lambda f, k, n: sampling.stratified_sample(f, "rare", k, n)):
        one = {r.k for r in run(frame.coalesce(1), "k", 25).collect()}
        many = {r.k for r in run(frame.repartition(13), "k", 25).collect()}
        assert one == many
    assert sampling.fixed_sample(frame, "k", 5000).count() == 1000
    assert sampling.stratified_sample(frame, "rare", "k", 25).count() == 50


def test_largest_contributions_text(spark):
    frame = spark.createDataFrame([(0.5, -2.0, 0.1234, -2.0)], "a double, b double, c double, d double")
    top = sampling.largest_by_size(list("abcd"), [F.col(c) for c in "abcd"])
    row = frame.select(sampling.contributor_text(top).alias("t")).first()
    assert row.t == "b=-2.000; d=-2.000; a=+0.500"


@pytest.mark.parametrize("range_values", [1, 7, 200_000])
def test_null_and_nan_scores_take_no_rank_at_any_size(spark, range_values):
    rows = [(0.1, 0), (0.4, 1), (0.4, 0), (0.9, 1), (0.7, 0), (0.2, 1)] + [(None, 1), (None, 0), (float("nan"), 1)]
    frame = spark.createDataFrame(rows, "score double, label int")
    groups = evaluation.score_groups(frame, "label", "score")
    got = evaluation.ranking_metrics(groups, range_values=range_values).first()
    plain = evaluation.ranking_metrics(evaluation.score_groups(frame.where("score < 1"), "label", "score")).first()
    assert tuple(got) == tuple(plain)
    described = ranking.describe(frame, "score", range_values=range_values).first()
    assert described["count"] == 6 and described["max"] == 0.9
