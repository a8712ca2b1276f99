"""Trained models over the whole payment history. Learners have no SQL form: rows only.

A training run is made once per application and folder and shared by the queries that read
its results; what is shared are fitted models and frames in reliable storage.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators import alerts, evaluation, marts, measures, models, trees, warehouse
from riskweave.operators.features import NUMERIC
from riskweave.plans.full_run import Inputs, full_run
from riskweave.plans.registry import query
from riskweave.plans.views import Views
from riskweave.session import materialise, shared_folder

_RUNS: dict[tuple[str, str], tuple[DataFrame, models.Training]] = {}


def training(v: Views) -> tuple[DataFrame, models.Training]:
    """(rule-scored payments, their training run)."""
    key = (v.spark.sparkContext.applicationId, v.folder)
    if key not in _RUNS:
        ruled = materialise(v.ruled)
        _RUNS[key] = (ruled, models.train_and_compare(ruled))
    return _RUNS[key]


def model_scored(v: Views) -> DataFrame:
    ruled, run = training(v)
    scored = models.score(run.models[run.selected], ruled)
    return alerts.combined_alert(evaluation.with_split(scored, times=run.split), run.threshold)


@query("ML6 ML7 ML8 ML9 ML10 ML11 ML14 ML15")
def model_comparison(v: Views) -> DataFrame:
    return training(v)[1].comparison


@query("ML12")
def model_thresholds(v: Views) -> DataFrame:
    return training(v)[1].thresholds


@query("ML14")
def selected_model(v: Views) -> DataFrame:
    return evaluation.choose_model(training(v)[1].comparison)


@query("ML16 R7 ML5")
def model_scored_payments(v: Views) -> DataFrame:
    return model_scored(v).select("transaction_id", "model_probability", "alert_flag", "evaluation_split")


@query("ML21")
def reloaded_model_scores(v: Views) -> DataFrame:
    """Scores by the selected model after saving and loading it."""
    ruled, run = training(v)
    path = f"{shared_folder(v.spark)}/model-{uuid.uuid4().hex}"
    models.save(run.models[run.selected], path)
    return models.score(models.load(path), ruled).select("transaction_id", "model_probability")


@query("ML18 B7")
def selected_model_importance(v: Views) -> DataFrame:
    _, run = training(v)
    return marts.plain_feature_names(models.importance(run.models[run.selected], run.names))


@query("ML17")
def anomaly_scores(v: Views) -> DataFrame:
    ruled, run = training(v)
    train = evaluation.with_split(ruled, times=run.split).where("evaluation_split = 'train'")
    nodes = trees.grow_forest(train, models.KEY, NUMERIC)
    return ruled.select("transaction_id", trees.anomaly_score(nodes, NUMERIC).alias("anomaly_score"))


@query("ML19 L3")
def boosted_top_contributors(v: Views) -> DataFrame:
    ruled, run = training(v)
    boosted = run.models[models.BOOSTED]
    explained = trees.BoostedExplainer(boosted).explain(boosted, ruled, models.KEY)
    return explained.select(
        "transaction_id", trees.top_contributors(F.col("contributions"), run.names).alias("top_contributors")
    )


@query("ML20")
def boosted_additivity(v: Views) -> DataFrame:
    ruled, run = training(v)
    boosted = run.models[models.BOOSTED]
    explainer = trees.BoostedExplainer(boosted)
    return trees.additivity_error(explainer.explain(boosted, ruled, models.KEY), explainer.bias)


@query("ML19")
def linear_top_contributors(v: Views) -> DataFrame:
    ruled, run = training(v)
    linear = run.models[models.LOGISTIC]
    text = trees.top_contributors(models.linear_contributions(linear), run.names)
    return linear.transform(ruled).select("transaction_id", text.alias("top_contributors"))


@query("M29 M30 M31 M32 M33")
def boosted_model_measures(v: Views) -> DataFrame:
    names = ["XGBoost Threshold", "Test TP", "Test FP", "Test FN", "Test TN"]
    return measures.measure_by({"model_comparison": training(v)[1].comparison}, names)


@query("B5")
def model_confusion_cells(v: Views) -> DataFrame:
    return marts.confusion_cells(training(v)[1].comparison)


@query("SNK4 SNK5 ML16 K1", """
SELECT 'customers' AS measure, count(*) AS n FROM customers UNION ALL SELECT 'counterparties', count(*) FROM counterparties
UNION ALL SELECT 'payments', count(*) FROM ruled UNION ALL SELECT 'scored', count(*) FROM ruled
UNION ALL SELECT 'risk_score', sum(risk_score)::BIGINT FROM ruled
""", "customers", "counterparties", "ruled")
def full_run_totals(v: Views) -> DataFrame:
    """The whole batch, from contracts to published tables: what does not depend on a learner."""
    root = f"{shared_folder(v.spark)}/run-{uuid.uuid4().hex}"
    done = full_run(Inputs(v.customers, v.counterparties, v.payments, v.watchlist), v.controls, root)
    published = {
        "customers": "dim_customer", "counterparties": "dim_counterparty", "payments": "fact_transactions",
    }
    counts = [
        warehouse.read_published(v.spark, f"{root}/warehouse", table).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("measure"), "n")
        for name, table in published.items()
    ]
    score = done.scored.agg(F.count("model_probability").alias("scored"), F.sum("risk_score").cast("bigint").alias("risk_score"))
    counts.append(score.unpivot([], ["scored", "risk_score"], "measure", "n"))
    return reduce(DataFrame.unionByName, counts)
