"""Chronological splits and classifier metrics, all from merged score groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.ranking import RANGE_VALUES, at_rank, running_totals, value_counts_of

# The 17 thresholds of the sweep, as floating-point steps of 0.05 from 0.1.
SWEEP_START, SWEEP_STEP, SWEEP_COUNT = 0.1, 0.05000000000000002, 17
THRESHOLDS = [SWEEP_START + i * SWEEP_STEP for i in range(SWEEP_COUNT)]
MISS_COST = 5


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    return {
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "false_positive_rate": _ratio(fp, fp + tn),
        "false_negative_rate": _ratio(fn, fn + tp),
    }


def confusion(frame: DataFrame, label: str, score: str, threshold: float, by: list[str] | None = None) -> DataFrame:
    """Cells and rates at ``score >= threshold``, one pass."""
    review, positive = F.col(score) >= threshold, F.col(label) == 1
    cells = frame.groupBy(*(by or [])).agg(
        F.count_if(~positive & ~review).alias("tn"),
        F.count_if(~positive & review).alias("fp"),
        F.count_if(positive & ~review).alias("fn"),
        F.count_if(positive & review).alias("tp"),
    )
    return cells.withColumns(rates(*map(F.col, ("tn", "fp", "fn", "tp"))))


def score_groups(frame: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """(by, score, pos, neg), one row per distinct score."""
    return frame.groupBy(*(by or []), F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def ranking_metrics(
    groups: DataFrame, by: list[str] | None = None, range_values: int = RANGE_VALUES
) -> DataFrame:
    """Exact ROC-AUC (ties count half; null for one class) and average precision."""
    ranked = running_totals(groups, "score", ["pos", "neg"], by, range_values)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    at_least_pos = F.col("pos_total") - F.col("pos_before")
    at_least = at_least_pos + F.col("neg_total") - F.col("neg_before")
    wins = F.sum(pos * (F.col("neg_before") + neg / 2))
    weighted = F.sum(pos * at_least_pos / at_least)
    p_total, n_total = F.max("pos_total").cast("double"), F.max("neg_total").cast("double")
    return ranked.groupBy(*(by or [])).agg(
        F.try_divide(wins, p_total * n_total).alias("roc_auc"),
        F.coalesce(F.try_divide(weighted, p_total), F.lit(0.0)).alias("pr_auc_ap"),
    )


def full_metrics(frame: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Cells, rates, ROC-AUC and average precision as one row, from one pass over the rows."""
    groups = running_totals(score_groups(frame, label, score), "score", ["pos", "neg"])
    return metrics_of_groups(groups, threshold)


def metrics_of_groups(ranked: DataFrame, threshold: float) -> DataFrame:
    review = F.col("score") >= threshold
    pos, neg = F.col("pos"), F.col("neg")
    at_least_pos = F.col("pos_total") - F.col("pos_before")
    at_least = at_least_pos + F.col("neg_total") - F.col("neg_before")
    p_total, n_total = F.max("pos_total").cast("double"), F.max("neg_total").cast("double")

    def cell(count: Column, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, count)), F.lit(0))

    one = ranked.agg(
        cell(neg, ~review).alias("tn"),
        cell(neg, review).alias("fp"),
        cell(pos, ~review).alias("fn"),
        cell(pos, review).alias("tp"),
        F.try_divide(
            F.sum(pos.cast("double") * (F.col("neg_before") + neg.cast("double") / 2)), p_total * n_total
        ).alias("roc_auc"),
        F.coalesce(
            F.try_divide(F.sum(pos.cast("double") * at_least_pos / at_least), p_total), F.lit(0.0)
        ).alias("pr_auc_ap"),
    )
    return one.withColumns(rates(*map(F.col, ("tn", "fp", "fn", "tp"))))


def split_times(frame: DataFrame, first: float = 0.6, second: float = 0.8) -> DataFrame:
    """(t_a, t_b) in microseconds: the times at rows int(first * n) and int(second * n)."""
    moments = frame.select(F.unix_micros("timestamp").alias("micros"))
    ranked = running_totals(value_counts_of(moments, "micros"), "value", ["n"])
    total = F.col("n_total")
    return ranked.agg(
        at_rank(F.floor(total * F.lit(first))).alias("t_a"),
        at_rank(F.floor(total * F.lit(second))).alias("t_b"),
    )


def split_label(moment: Column, t_a: Column, t_b: Column) -> Column:
    micros = F.unix_micros(moment)
    return F.when(micros < t_a, "train").when(micros < t_b, "validation").otherwise("test")


def with_split(frame: DataFrame, first: float = 0.6, second: float = 0.8, times: tuple[int, int] | None = None) -> DataFrame:
    """Adds evaluation_split; whole timestamps never straddle two parts.

    ``times`` are known boundaries; without them they are looked up from ``frame``.
    """
    if times is None:
        times = tuple(split_times(frame, first, second).first())
    return frame.withColumn(
        "evaluation_split", split_label(F.col("timestamp"), *[F.lit(t) for t in times])
    )


def split_report(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("evaluation_split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("timestamp").alias("start"),
        F.max("timestamp").alias("end"),
    )


def threshold_sweep(groups: DataFrame, by: list[str] | None = None, thresholds: list[float] | None = None) -> DataFrame:
    """Cells, rates and validation cost at every threshold, from score groups.

    One aggregate with two conditional sums per threshold; rows are never repeated.
    """
    by, thresholds = by or [], thresholds or THRESHOLDS
    reach = [F.col("score") >= t for t in thresholds]
    sums = groups.groupBy(*by).agg(
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
        F.array(*[F.coalesce(F.sum(F.when(r, F.col("pos"))), F.lit(0)) for r in reach]).alias("tps"),
        F.array(*[F.coalesce(F.sum(F.when(r, F.col("neg"))), F.lit(0)) for r in reach]).alias("fps"),
    )
    points = F.arrays_zip(
        F.array(*[F.lit(t) for t in thresholds]).alias("threshold"), F.col("tps").alias("tp"), F.col("fps").alias("fp")
    )
    cells = (
        sums.select(*by, "p", "n", F.explode(points).alias("at"))
        .select(
            *by,
            F.col("at.threshold").alias("threshold"),
            (F.col("n") - F.col("at.fp")).alias("tn"), F.col("at.fp").alias("fp"),
            (F.col("p") - F.col("at.tp")).alias("fn"), F.col("at.tp").alias("tp"),
        )
        .withColumn("validation_cost", MISS_COST * F.col("fn") + F.col("fp"))
    )
    return cells.withColumns(rates(*map(F.col, ("tn", "fp", "fn", "tp"))))


def choose_threshold(sweep: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Cheapest threshold, the lowest one on ties."""
    best = F.min(F.struct("validation_cost", "threshold")).alias("best")
    return sweep.groupBy(*(by or [])).agg(best).select(*(by or []), "best.threshold", "best.validation_cost")


def choose_model(choices: DataFrame) -> DataFrame:
    """Cheapest model on validation data, by name on ties. Test data plays no part."""
    return choices.agg(F.min(F.struct("validation_cost", "model", "threshold")).alias("best")).select(
        "best.model", "best.threshold", "best.validation_cost"
    )
