"""Three classifiers: preprocessing, fitting, tuning, comparison, explanation."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from riskweave.operators import boosting, evaluation
from riskweave.operators.features import CATEGORICAL, NUMERIC, assert_no_leak
from riskweave.operators.preprocessing import ExactPreprocessor, ExactPreprocessorModel
from riskweave.operators.ranking import running_totals, value_counts_of
from riskweave.session import materialise, side_by_side

LABEL = "investigation_label"
LOGISTIC, FOREST, BOOSTED = "LogisticRegression", "RandomForest", "GradientBoosting"
KEY = "transaction_id"
ROWS_PER_TASK = 10_000


@dataclass(frozen=True)
class Settings:
    """Learner settings."""

    seed: int = 42
    logistic_iterations: int = 400
    forest_trees: int = 70
    forest_depth: int = 10
    forest_leaf: int = 10
    boosting_rounds: int = 100
    boosting_depth: int = 4
    boosting_rate: float = 0.08
    boosting_rows: float = 0.85
    boosting_columns: float = 0.9
    folds: int = 3

    @property
    def growth(self) -> boosting.Growth:
        return boosting.Growth(
            self.boosting_rounds, self.boosting_depth, self.boosting_rate, self.boosting_rows, self.boosting_columns, self.seed
        )


@dataclass
class Training:
    """What a training run leaves behind. Frames hold one row per model or per threshold."""

    models: dict[str, PipelineModel]
    comparison: DataFrame
    thresholds: DataFrame
    selected: str
    threshold: float
    split: tuple[int, int]
    names: list[str] = field(default_factory=list)


def class_counts(frame: DataFrame) -> tuple[int, int]:
    """(negatives, positives)."""
    row = frame.agg(
        F.count_if(F.col(LABEL) == 0).alias("neg"), F.count_if(F.col(LABEL) == 1).alias("pos")
    ).first()
    return row["neg"], row["pos"]


def balanced_weight(negatives: int, positives: int) -> Column:
    """n / (2 * class size)."""
    n = negatives + positives
    return F.when(F.col(LABEL) == 1, n / (2 * max(positives, 1))).otherwise(n / (2 * max(negatives, 1)))


def boosting_weights(negatives: int, positives: int) -> tuple[float, float]:
    """Of labels 0 and 1: positives weigh as much as all negatives together."""
    return 1.0, negatives / max(positives, 1)


def first_margin(negatives: int, positives: int) -> float:
    """Log-odds of the weighted labels, from which boosting starts."""
    w0, w1 = boosting_weights(negatives, positives)
    return math.log(max(w1 * positives, 1e-6) / max(w0 * negatives, 1e-6))


def preprocessor() -> ExactPreprocessor:
    """Median-filled, standardised numbers and one-hot categories; unknown ones become zeros."""
    assert_no_leak(NUMERIC + CATEGORICAL)
    return ExactPreprocessor(numeric=NUMERIC, categorical=CATEGORICAL)


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the slots of the feature vector."""
    return model.stages[0].names


def learner(name: str, settings: Settings, total_weight: float):
    common = {"featuresCol": "features", "labelCol": LABEL, "weightCol": "weight"}
    if name == LOGISTIC:
        # A unit penalty on the sum of losses, as a penalty on their mean.
        return LogisticRegression(
            **common, regParam=1.0 / total_weight, elasticNetParam=0.0, standardization=False,
            maxIter=settings.logistic_iterations,
        )
    return RandomForestClassifier(
        **common, numTrees=settings.forest_trees, maxDepth=settings.forest_depth,
        minInstancesPerNode=settings.forest_leaf, seed=settings.seed,
        # The same trees; rows keep their place in each instead of walking down again at every level.
        cacheNodeIds=True,
    )


@dataclass
class Prepared:
    """Training rows as vectors, with the preprocessing that made them."""

    stage: ExactPreprocessorModel
    vectors: DataFrame
    negatives: int
    positives: int

    def fit(self, name: str, settings: Settings) -> PipelineModel:
        negatives, positives = self.negatives, self.positives
        weight, total = balanced_weight(negatives, positives), float(negatives + positives)
        model = learner(name, settings, total).fit(self.vectors.withColumn("weight", weight))
        return PipelineModel(stages=[self.stage, model])


def prepare(train: DataFrame) -> Prepared:
    rows = train.select(KEY, *NUMERIC, *CATEGORICAL, LABEL)
    stage = preprocessor().fit(rows)
    negatives, positives = class_counts(rows)
    # Every round of a learner is a job over these rows: no more tasks than the rows fill.
    parts = max(-(-(negatives + positives) // ROWS_PER_TASK), 1)
    vectors = stage.transform(rows).select("features", LABEL, F.xxhash64(KEY).alias("draw")).coalesce(parts)
    # On disk: learners keep rows in forms of their own, and memory is theirs.
    return Prepared(stage, vectors.persist(StorageLevel.DISK_ONLY), negatives, positives)


def fit_boosted(prepared: list[Prepared], settings: Settings) -> list[PipelineModel]:
    """Boosted models of all sets of training rows: every job works on all of them."""
    margins = [first_margin(p.negatives, p.positives) for p in prepared]
    sets = [(p.vectors, boosting_weights(p.negatives, p.positives), m) for p, m in zip(prepared, margins, strict=True)]
    found = boosting.train(sets, LABEL, "draw", settings.growth)
    return [
        PipelineModel(stages=[p.stage, boosting.BoostedModel.of(trees, m, len(p.stage.names))])
        for p, trees, m in zip(prepared, found, margins, strict=True)
    ]


def fit_models(trains: list[DataFrame], names: list[str], settings: Settings) -> list[dict[str, PipelineModel]]:
    """For each set of training rows, the named learners on one shared preprocessing.

    Boosting runs next to the other learners. These are fitted one after the other, as each keeps all its
    training rows while it is fitted: what is kept at once is one set of rows, not all of them.
    """
    spark = trains[0].sparkSession
    prepared = side_by_side(spark, prepare, trains)
    boosted = [(BOOSTED, None)] * (BOOSTED in names)
    others = [(name, k) for name in (FOREST, LOGISTIC) if name in names for k in range(len(trains))]

    def fit(jobs):
        return {
            (name, k): fit_boosted(prepared, settings) if k is None else prepared[k].fit(name, settings)
            for name, k in jobs
        }

    try:
        fitted = reduce(dict.__or__, side_by_side(spark, fit, [jobs for jobs in (boosted, others) if jobs]), {})
    finally:
        for p in prepared:
            p.vectors.unpersist()
    return [
        {name: fitted[BOOSTED, None][k] if name == BOOSTED else fitted[name, k] for name in names}
        for k in range(len(trains))
    ]


def probability() -> Column:
    return vector_to_array("probability")[1]


def score(model: PipelineModel, frame: DataFrame, column: str = "model_probability") -> DataFrame:
    """Frame with the probability of the positive class; helper columns are dropped."""
    return model.transform(frame).select(*frame.columns, probability().alias(column))


def _before(micros: int, key: str | None) -> Column:
    """Rows that come before position (micros, key) in time order."""
    moment = F.unix_micros("timestamp")
    earlier = moment < micros
    return earlier if key is None else earlier | ((moment == micros) & (F.col(KEY) < key))


def fold_edges(train: DataFrame, folds: int) -> list[Column]:
    """Conditions "before edge k" for the starts of the test parts, and the whole of the rows.

    Edges sit at row positions in (timestamp, transaction_id) order. The timestamp comes
    from exact ranks; only payments of that one microsecond are ordered by id.
    """
    moments = train.select(F.unix_micros("timestamp").alias("micros"))
    ranked = running_totals(value_counts_of(moments, "micros"), "value", ["n"])
    total = train.count()
    size = total // (folds + 1)
    positions = [total - (folds - k) * size for k in range(folds)]
    inside = [
        (F.col("n_before") <= p) & (F.lit(p) < F.col("n_before") + F.col("n")) for p in positions
    ]
    hits = ranked.where(reduce(Column.__or__, inside)).collect()
    edges = []
    for p in positions:
        hit = next(h for h in hits if h["n_before"] <= p < h["n_before"] + h["n"])
        offset = p - hit["n_before"]
        key = None
        if offset:
            same = train.where(F.unix_micros("timestamp") == hit["value"])
            key = same.orderBy(KEY).offset(offset).limit(1).select(KEY).first()[0]
        edges.append(_before(hit["value"], key))
    return [*edges, F.lit(True)]


def cross_validate(
    train: DataFrame, edges: list[Column], fitted: list[dict[str, PipelineModel]]
) -> DataFrame:
    """(model, cv_pr_auc_ap_mean, cv_pr_auc_ap_std): expanding windows, population std.

    ``fitted[k]`` holds the models fitted on the rows before edge k.
    """
    groups = []
    for k, models in enumerate(fitted):
        test = train.where(~edges[k] & edges[k + 1]).select(*NUMERIC, *CATEGORICAL, LABEL)
        for name, model in models.items():
            scored = score(model, test, "p")
            groups.append(
                evaluation.score_groups(scored, LABEL, "p").select(
                    F.lit(name).alias("model"), F.lit(k).alias("fold"), "score", "pos", "neg"
                )
            )
    everything = reduce(DataFrame.unionByName, groups)
    per_fold = evaluation.ranking_metrics(everything, ["model", "fold"])
    return per_fold.groupBy("model").agg(
        F.avg("pr_auc_ap").alias("cv_pr_auc_ap_mean"), F.stddev_pop("pr_auc_ap").alias("cv_pr_auc_ap_std")
    )


def train_and_compare(
    frame: DataFrame, settings: Settings | None = None, names: list[str] | None = None, validate: bool = True
) -> Training:
    """Fit on the first 60 % of the time line, tune on the next 20 %, report on the rest.

    ``frame`` holds features, label, timestamp and transaction id. ``validate`` runs the
    expanding-window cross-validation as well.
    """
    settings, names = settings or Settings(), names or [LOGISTIC, FOREST, BOOSTED]
    kept = materialise(frame.select(KEY, "timestamp", *NUMERIC, *CATEGORICAL, LABEL))
    times = tuple(evaluation.split_times(kept).first())
    labelled = evaluation.with_split(kept, times=times)
    train = labelled.where("evaluation_split = 'train'")
    rest = labelled.where("evaluation_split <> 'train'")
    edges = fold_edges(train, settings.folds) if validate else []
    models, *fold_models = fit_models(
        [train, *[train.where(e) for e in edges[:-1]]], names, settings
    )
    groups = reduce(
        DataFrame.unionByName,
        [
            evaluation.score_groups(score(m, rest, "p"), LABEL, "p", ["evaluation_split"])
            .withColumn("model", F.lit(name))
            for name, m in models.items()
        ],
    )
    ranked = materialise(running_totals(groups, "score", ["pos", "neg"], ["evaluation_split", "model"]))
    sweep = materialise(
        evaluation.threshold_sweep(ranked.where("evaluation_split = 'validation'"), ["model"])
    )
    chosen = evaluation.choose_threshold(sweep, ["model"])
    picks = {r["model"]: r for r in chosen.collect()}
    tested = [
        evaluation.metrics_of_groups(
            ranked.where((F.col("evaluation_split") == "test") & (F.col("model") == name)),
            picks[name]["threshold"],
        ).select(
            F.lit(name).alias("model"),
            F.lit(picks[name]["threshold"]).alias("threshold"),
            F.lit(picks[name]["validation_cost"]).alias("validation_cost"),
            "*",
        )
        for name in names
    ]
    comparison = reduce(DataFrame.unionByName, tested)
    if validate:
        comparison = comparison.join(cross_validate(train, edges, fold_models), "model")
    comparison = materialise(comparison)
    best = evaluation.choose_model(comparison).first()
    return Training(
        models, comparison, sweep, best["model"], best["threshold"], times,
        feature_names(models[names[0]]),
    )


def importance(model: PipelineModel, names: list[str]) -> DataFrame:
    """(feature, importance), most important first: tree importance or absolute coefficient."""
    last = model.stages[-1]
    values = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    rows = [(n, float(abs(x))) for n, x in zip(names, values.toArray(), strict=True)]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def linear_contributions(model: PipelineModel) -> Column:
    """Array of coefficient times value; with the intercept they add up to the log-odds."""
    weights = F.array(*[F.lit(float(w)) for w in model.stages[-1].coefficients.toArray()])
    return F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
