import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import evaluation, models, trees
from riskweave.operators.features import CATEGORICAL, NUMERIC
from riskweave.plans.views import Views
from riskweave.session import materialise
from tests.conftest import TINY

QUICK = models.Settings(boosting_rounds=5, forest_trees=8, forest_depth=5, folds=3)


@pytest.fixture(scope="module")
def frame(spark):
    return materialise(Views(spark, TINY).ruled)


@pytest.fixture(scope="module")
def run(frame):
    return models.train_and_compare(frame, QUICK)


def test_rows_that_keep_their_place_give_the_same_forest(frame):
    prepared = models.prepare(frame)
    learner = models.learner(models.FOREST, QUICK, 1.0)
    weighted = prepared.vectors.withColumn("weight", models.balanced_weight(prepared.negatives, prepared.positives))
    kept, walked = (learner.copy({learner.cacheNodeIds: kept}).fit(weighted) for kept in (True, False))
    prepared.vectors.unpersist()
    assert learner.getCacheNodeIds()
    # The first line names the model.
    assert kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_one_set_of_training_rows_is_kept_at_a_time(frame, monkeypatch):
    """Vectors lie on disk, and learners that keep all their rows are fitted one after the other."""
    now, most, levels, fit = [], [], [], models.Prepared.fit

    def watched(self, *args):
        now.append(self)
        most.append(len(now))
        levels.append(self.vectors.storageLevel)
        try:
            return fit(self, *args)
        finally:
            now.remove(self)

    monkeypatch.setattr(models.Prepared, "fit", watched)
    halves = [frame.where(F.xxhash64("transaction_id") % 2 == k) for k in (0, 1)]
    fitted = models.fit_models(halves, [models.LOGISTIC, models.FOREST], QUICK)
    assert [set(found) for found in fitted] == [{models.LOGISTIC, models.FOREST}] * 2
    assert most == [1] * 4
    assert all(level.useDisk and not level.useMemory for level in levels)


def test_comparison_invariants(run):
    rows = {r.model: r for r in run.comparison.collect()}
    assert set(rows) == {models.LOGISTIC, models.FOREST, models.BOOSTED}
    for r in rows.values():
        assert 0 <= r.roc_auc <= 1 and 0 <= r.pr_auc_ap <= 1 and 0 <= r.cv_pr_auc_ap_mean <= 1
        sweep = run.thresholds.where(F.col("model") == r.model).collect()
        assert len(sweep) == 17
        assert (r.validation_cost, r.threshold) == min((s.validation_cost, s.threshold) for s in sweep)
    assert run.selected == min((r.validation_cost, m) for m, r in rows.items())[1]


def test_probabilities_of_all_rows(frame, run):
    scored = models.score(run.models[run.selected], frame)
    assert scored.where("model_probability between 0 and 1").count() == frame.count()
    assert scored.columns == [*frame.columns, "model_probability"]


def test_saved_model_scores_alike(frame, run, tmp_path):
    path = str(tmp_path / "model")
    models.save(run.models[run.selected], path)
    before = models.score(run.models[run.selected], frame).select("transaction_id", "model_probability")
    after = models.score(models.load(path), frame).select("transaction_id", "model_probability")
    assert before.exceptAll(after).isEmpty()


def test_preprocessing_learns_from_training_rows_only(frame, run):
    """An unknown category becomes zeros; a missing value becomes the median or the mode."""
    row = frame.limit(1)
    odd = row.withColumns({"payment_channel": F.lit("NEVER_SEEN"), "kyc_status": F.lit(None).cast("string"),
                           "account_age_days": F.lit(None).cast("int")})
    vector = run.models[models.LOGISTIC].transform(odd).select("features").first().features.toArray()
    slots = dict(zip(run.names, vector, strict=True))
    assert all(v == 0 for n, v in slots.items() if "payment_channel" in n)
    assert slots["category__kyc_status_COMPLETE"] == 1
    assert np.isfinite(vector).all()


def test_standardised_numbers(frame, run):
    train = evaluation.with_split(frame, times=run.split).where("evaluation_split = 'train'")
    vectors = run.models[models.LOGISTIC].transform(train).select("features").collect()
    numbers = np.stack([v.features.toArray()[: len(NUMERIC)] for v in vectors])
    assert np.allclose(numbers.mean(axis=0), 0, atol=1e-9)
    spread = numbers.std(axis=0)
    assert all(abs(s - 1) < 1e-9 or s == 0 for s in spread)


def test_names_cover_the_vector(run):
    assert run.names[: len(NUMERIC)] == [f"numeric__{c}" for c in NUMERIC]
    assert run.models[models.FOREST].stages[-1].numFeatures == len(run.names)


def test_importance_is_sorted(run):
    values = [r.importance for r in models.importance(run.models[run.selected], run.names).collect()]
    assert values == sorted(values, reverse=True) and len(values) == len(run.names)


def test_contributions_add_up(spark, frame, run):
    boosted = run.models[models.BOOSTED]
    explainer = trees.BoostedExplainer(boosted)
    explained = explainer.explain(boosted, frame, "transaction_id")
    assert trees.additivity_error(explained, explainer.bias).first().max_error < 1e-4
    text = explained.select(trees.top_contributors(F.col("contributions"), run.names).alias("t")).first().t
    assert text.count("; ") == 2


def test_linear_contributions_add_up(frame, run):
    model = run.models[models.LOGISTIC]
    total = F.aggregate(models.linear_contributions(model), F.lit(0.0), lambda a, c: a + c)
    odds = F.log(models.probability() / (1 - models.probability()))
    gap = F.abs(total + F.lit(float(model.stages[-1].intercept)) - odds)
    assert model.transform(frame).agg(F.max(gap)).first()[0] < 1e-6


def test_weights():
    assert models.balanced_weight(3, 1)._jc.toString() and models.boosting_weights(3, 0) == (1.0, 3.0)


def test_fold_edges_sit_at_row_positions(spark, at):
    # many payments share a moment, so edges fall inside them
    rows = [(f"T{i:03d}", at(i // 17)) for i in range(103)]
    frame = spark.createDataFrame(rows, "transaction_id string, timestamp timestamp")
    edges = models.fold_edges(frame, 3)
    size = 103 // 4
    assert [frame.where(e).count() for e in edges] == [103 - 3 * size, 103 - 2 * size, 103 - size, 103]


def test_forest_samples_are_exact_and_repeatable(frame):
    values = F.array(*[F.col(c).cast("double") for c in NUMERIC])
    draws = [
        trees.forest_samples(f, "transaction_id", values, 6, 50, 1) for f in (frame, frame.repartition(9))
    ]
    assert {r["count"] for r in draws[0].groupBy("tree").count().collect()} == {50}
    assert draws[0].exceptAll(draws[1]).isEmpty()


def test_outliers_are_easier_to_isolate(spark):
    rng = np.random.default_rng(3)
    rows = [(f"r{i}", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))] + [("odd", 9.0, -9.0)]
    frame = spark.createDataFrame(rows, "transaction_id string, a double, b double")
    nodes = trees.grow_forest(frame, "transaction_id", ["a", "b"], 40, 128)
    scored = frame.select("transaction_id", trees.anomaly_score(nodes, ["a", "b"]).alias("s"))
    top = scored.orderBy(F.desc("s")).first()
    assert top.transaction_id == "odd" and 0.6 < top.s <= 1
    assert scored.agg(F.avg("s")).first()[0] < 0.55


def test_average_path():
    assert trees.average_path([1, 2]).tolist() == [0.0, 1.0]
    assert trees.average_path(256) == pytest.approx(10.244770920)


def test_categorical_features_are_the_declared_ones():
    assert CATEGORICAL == ["payment_channel", "payment_type", "kyc_status"]
