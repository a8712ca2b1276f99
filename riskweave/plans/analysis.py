"""Evaluation metrics, splits and statistical tests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators import daily_sketches, evaluation, marts, models, ranking, sampling, statistics
from riskweave.operators.features import CATEGORICAL, FEATURES, NUMERIC, assert_no_leak
from riskweave.operators.measures import measure_by
from riskweave.operators.ranking import at_rank, running_totals
from riskweave.plans.registry import query, r6, us
from riskweave.plans.views import Views
from riskweave.session import shared_folder

_CELLS = """
  sum((investigation_label = 0 AND s < {t})::INT)::BIGINT AS tn, sum((investigation_label = 0 AND s >= {t})::INT)::BIGINT AS fp,
  sum((investigation_label = 1 AND s < {t})::INT)::BIGINT AS fn, sum((investigation_label = 1 AND s >= {t})::INT)::BIGINT AS tp
"""
_RATES = """
  round(tp / greatest(tp + fp, 1)::DOUBLE, 6) AS precision, round(tp / greatest(tp + fn, 1)::DOUBLE, 6) AS recall,
  round(2 * tp / greatest(2 * tp + fp + fn, 1)::DOUBLE, 6) AS f1,
  round(fp / greatest(fp + tn, 1)::DOUBLE, 6) AS false_positive_rate,
  round(fn / greatest(fn + tp, 1)::DOUBLE, 6) AS false_negative_rate
"""
# Two score columns stand in for two models.
_MODELS = """
  (SELECT 'ratio' AS model, model_probability AS s, investigation_label FROM scored
   UNION ALL SELECT 'rules', risk_score / 100.0::DOUBLE, investigation_label FROM scored)
"""


def two_models(v: Views) -> DataFrame:
    label = F.col("investigation_label")
    pairs = F.explode(
        F.array(
            F.struct(F.lit("ratio").alias("model"), F.col("model_probability").alias("s")),
            F.struct(F.lit("rules").alias("model"), (F.col("risk_score") / 100.0).alias("s")),
        )
    ).alias("m")
    return v.scored.select(label, pairs).select("m.model", "m.s", "investigation_label")


@query("ML1", f"SELECT model, tn, fp, fn, tp, {_RATES} FROM (SELECT model, {_CELLS.format(t=0.45)} FROM {_MODELS} m GROUP BY 1) c",
       "scored")
def confusion_by_model(v: Views) -> DataFrame:
    return evaluation.confusion(two_models(v), "investigation_label", "s", 0.45, ["model"])


_RANKED = f"""
  (SELECT model, s, pos, neg,
          coalesce(sum(neg) OVER (PARTITION BY model ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
          sum(pos) OVER (PARTITION BY model ORDER BY s DESC) AS tp_at, sum(pos + neg) OVER (PARTITION BY model ORDER BY s DESC) AS n_at,
          sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
   FROM (SELECT model, s, sum(investigation_label) AS pos, sum(1 - investigation_label) AS neg FROM {_MODELS} m GROUP BY 1, 2) g)
"""


@query("ML2 ML3 W11", f"""
SELECT model, round(sum(pos * (neg_below + neg / 2.0::DOUBLE)) / (max(p) * max(n)), 6) AS roc_auc,
       round(sum(pos * tp_at / n_at::DOUBLE) / max(p), 6) AS pr_auc_ap
FROM {_RANKED} r GROUP BY 1
""", "scored")
def ranking_metrics_by_model(v: Views) -> DataFrame:
    groups = evaluation.score_groups(two_models(v), "investigation_label", "s", ["model"])
    return evaluation.ranking_metrics(groups, ["model"])


@query("ML2 ML3 W11", f"""
SELECT model, round(sum(pos * (neg_below + neg / 2.0::DOUBLE)) / (max(p) * max(n)), 6) AS roc_auc,
       round(sum(pos * tp_at / n_at::DOUBLE) / max(p), 6) AS pr_auc_ap
FROM {_RANKED.replace(_MODELS + " m", _MODELS + " m WHERE s >= 0.05")} r GROUP BY 1
""", "scored")
def ranking_metrics_in_ranges(v: Views) -> DataFrame:
    """The same metrics over many short ranges; rows with a null or NaN score have no rank."""
    s = F.col("s")
    gaps = two_models(v).withColumn("s", F.when(s >= 0.05, s).when(s >= 0.02, F.lit(float("nan"))))
    groups = evaluation.score_groups(gaps, "investigation_label", "s", ["model"])
    return evaluation.ranking_metrics(groups, ["model"], range_values=50)


@query("ML4", f"SELECT {us('make_timestamp(t_a)', 't_a')}, {us('make_timestamp(t_b)', 't_b')} FROM split_times", "split_times")
def split_boundaries(v: Views) -> DataFrame:
    return evaluation.split_times(v.payments).select(
        F.timestamp_micros("t_a").alias("t_a"), F.timestamp_micros("t_b").alias("t_b")
    )


_SPLIT = """
  CASE WHEN epoch_us(timestamp) < (SELECT t_a FROM split_times) THEN 'train'
       WHEN epoch_us(timestamp) < (SELECT t_b FROM split_times) THEN 'validation' ELSE 'test' END
"""


@query("ML5", f"SELECT transaction_id, {_SPLIT} AS evaluation_split FROM payments", "payments", "split_times")
def split_labels(v: Views) -> DataFrame:
    return evaluation.with_split(v.payments).select("transaction_id", "evaluation_split")


@query("ML5", f"""
SELECT {_SPLIT} AS evaluation_split, count(*) AS rows, {us('min(timestamp)', 'start')}, {us('max(timestamp)', 'end').replace('AS end', 'AS "end"')}
FROM payments GROUP BY 1
""", "payments", "split_times")
def split_report(v: Views) -> DataFrame:
    return evaluation.split_report(evaluation.with_split(v.payments))


_SWEEP = f"""
  (SELECT model, t AS threshold, {_CELLS.format(t='t')}
   FROM {_MODELS} m, (SELECT 0.1::DOUBLE + i * 0.05000000000000002::DOUBLE AS t FROM range(17) r(i)) ts GROUP BY 1, 2)
"""


@query("ML12", f"""
SELECT model, round(threshold, 6) AS threshold, tn, fp, fn, tp, 5 * fn + fp AS validation_cost, {_RATES} FROM {_SWEEP} c
""", "scored")
def threshold_sweep(v: Views) -> DataFrame:
    groups = evaluation.score_groups(two_models(v), "investigation_label", "s", ["model"])
    return evaluation.threshold_sweep(groups, ["model"])


_CHOICE = f"""
  (SELECT model, round(threshold, 6) AS threshold, cost AS validation_cost
   FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY cost, threshold) AS place
         FROM (SELECT model, threshold, 5 * fn + fp AS cost FROM {_SWEEP} c) k) p WHERE place = 1)
"""


@query("ML13 L6", f"SELECT * FROM {_CHOICE} x", "scored")
def chosen_thresholds(v: Views) -> DataFrame:
    return evaluation.choose_threshold(threshold_sweep(v), ["model"])


@query("ML14 L6", f"SELECT * FROM {_CHOICE} x ORDER BY validation_cost, model LIMIT 1", "scored")
def chosen_model(v: Views) -> DataFrame:
    return evaluation.choose_model(chosen_thresholds(v))


@query("B5", f"""
SELECT model, unnest(['Negative', 'Negative', 'Positive', 'Positive']) AS actual,
       unnest(['Clear', 'Review', 'Clear', 'Review']) AS predicted, unnest(['TN', 'FP', 'FN', 'TP']) AS cell,
       unnest([tn, fp, fn, tp]) AS count
FROM (SELECT model, {_CELLS.format(t=0.45)} FROM {_MODELS} m GROUP BY 1) c
""", "scored")
def confusion_cells(v: Views) -> DataFrame:
    return marts.confusion_cells(confusion_by_model(v))


@query("M29 M30 M31 M32 M33", f"""
SELECT unnest(['XGBoost Threshold', 'Test TP', 'Test FP', 'Test FN', 'Test TN']) AS measure,
       unnest([0.45::DOUBLE, tp, fp, fn, tn]) AS value
FROM (SELECT model, {_CELLS.format(t=0.45)} FROM {_MODELS} m WHERE model = 'ratio' GROUP BY 1) c
""", "scored")
def measures_of_comparison(v: Views) -> DataFrame:
    """The boosted model's measures, of a comparison in which the ratio score stands in for it."""
    named = F.when(F.col("model") == "ratio", models.BOOSTED).otherwise(F.col("model"))
    comparison = confusion_by_model(v).withColumn("model", named).withColumn("threshold", F.lit(0.45))
    names = ["XGBoost Threshold", "Test TP", "Test FP", "Test FN", "Test TN"]
    found = measure_by({"model_comparison": comparison}, names)
    return found.unpivot([], names, "measure", "value")


@query("B7 ML18", """
SELECT feature, count(DISTINCT value) AS labels FROM (
  SELECT unnest(['payment_channel', 'payment_type', 'kyc_status']) AS feature,
         unnest([payment_channel, payment_type, kyc_status]) AS value FROM scored) c
GROUP BY 1
""", "scored")
def importance_names(v: Views) -> DataFrame:
    """Plain names of the one-hot slots that the preprocessing makes, counted by feature."""
    slots = [(n,) for n in models.preprocessor().fit(v.kept_scored).names if n.startswith("category__")]
    plain = marts.plain_feature_names(v.spark.createDataFrame(slots, "feature string"))
    owner = F.coalesce(*(F.when(F.col("feature").startswith(f"{c}_"), F.lit(c)) for c in CATEGORICAL))
    return plain.groupBy(owner.alias("feature")).agg(F.count(F.lit(1)).alias("labels"))


@query("W10", "SELECT count(*) AS rows, 9::BIGINT AS numeric_features, 12::BIGINT AS all_features FROM featured", "featured")
def feature_vector_contract(v: Views) -> DataFrame:
    assert_no_leak(FEATURES)
    return v.featured.select(*FEATURES).dropna().agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(NUMERIC)).alias("numeric_features"),
        F.lit(len(FEATURES)).alias("all_features"),
    )


@query("L3", f"""
SELECT transaction_id, list_aggregate(list_transform(list_slice(list_sort([
         {{'size': -abs(amount_ratio), 'name': 'amount_ratio', 'value': amount_ratio}},
         {{'size': -abs(night - 0.5::DOUBLE), 'name': 'night', 'value': night - 0.5::DOUBLE}},
         {{'size': -abs(high_risk_geo * 2.0::DOUBLE), 'name': 'high_risk_geo', 'value': high_risk_geo * 2.0::DOUBLE}},
         {{'size': -abs(velocity_1h - 1.0::DOUBLE), 'name': 'velocity_1h', 'value': velocity_1h - 1.0::DOUBLE}}]), 1, 3),
       lambda e: e.name), 'string_agg', '; ') AS largest
FROM featured
""", "featured")
def largest_contributors(v: Views) -> DataFrame:
    values = {
        "amount_ratio": F.col("amount_ratio"),
        "night": F.col("night") - F.lit(0.5),
        "high_risk_geo": F.col("high_risk_geo") * F.lit(2.0),
        "velocity_1h": F.col("velocity_1h") - F.lit(1.0),
    }
    top = sampling.largest_by_size(list(values), list(values.values()))
    return v.featured.select(
        "transaction_id", F.array_join(F.transform(top, lambda e: e["name"]), "; ").alias("largest")
    )


_DESCRIBE = """
SELECT count(*) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c})::DOUBLE, 6) AS min,
       {p}, round(max({c})::DOUBLE, 6) AS max FROM scored
"""


def _quantiles(column: str, qs) -> str:
    return ", ".join(f"round(quantile_cont({column}, {q}), 6) AS p{q * 100:g}" for q in qs)


@query("A8", _DESCRIBE.format(c="amount", p=_quantiles("amount", (0.5, 0.9, 0.99))), "scored")
def amount_description(v: Views) -> DataFrame:
    return ranking.describe(v.payments, "amount", (0.5, 0.9, 0.99))


@query("A8 W11", _DESCRIBE.format(c="amount", p=_quantiles("amount", (0.5, 0.9, 0.99))) + " WHERE amount >= 100", "scored")
def describe_in_ranges(v: Views) -> DataFrame:
    gaps = v.payments.withColumn("amount", F.when(F.col("amount") >= 100, F.col("amount")))
    return ranking.describe(gaps, "amount", (0.5, 0.9, 0.99), range_values=100)


@query("A8", _DESCRIBE.format(c="risk_score", p=_quantiles("risk_score", (0.25, 0.5, 0.75))), "scored")
def risk_score_description(v: Views) -> DataFrame:
    return ranking.describe(v.scored, "risk_score")


@query("ST1", """
SELECT successes, n, round(p, 6) AS rate, round(center - half, 6) AS ci_lower, round(center + half, 6) AS ci_upper
FROM (SELECT *, (p + 3.8416::DOUBLE / (2 * n)) / (1 + 3.8416::DOUBLE / n) AS center,
             1.96::DOUBLE * sqrt(p * (1 - p) / n + 3.8416::DOUBLE / (4.0::DOUBLE * n * n)) / (1 + 3.8416::DOUBLE / n) AS half
      FROM (SELECT sum(alert_flag::INT)::BIGINT AS successes, count(*) AS n, avg(alert_flag::INT) AS p FROM scored) a) b
""", "scored")
def alert_rate_interval(v: Views) -> DataFrame:
    return statistics.alert_rate_interval(v.scored)


@query("ST2 ST3", """
SELECT a::BIGINT AS a, b::BIGINT AS b, c::BIGINT AS c, d::BIGINT AS d, n, round(chi, 6) AS chi_square,
       round(least((a + b) * (a + c), (a + b) * (b + d), (c + d) * (a + c), (c + d) * (b + d)) / n, 6) AS min_expected_count,
       round(sqrt(chi / n), 6) AS cramers_v
FROM (SELECT *, n * greatest(abs(a * d - b * c) - n / 2, 0) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d)) AS chi
      FROM (SELECT sum((high_risk_geo = 0 AND NOT alert_flag)::INT)::DOUBLE AS a, sum((high_risk_geo = 0 AND alert_flag)::INT)::DOUBLE AS b,
                   sum((high_risk_geo = 1 AND NOT alert_flag)::INT)::DOUBLE AS c, sum((high_risk_geo = 1 AND alert_flag)::INT)::DOUBLE AS d,
                   count(*)::DOUBLE AS n FROM scored) t) x
""", "scored")
def geography_chi_square(v: Views) -> DataFrame:
    return statistics.chi_square(v.scored, F.col("high_risk_geo") == 1, F.col("alert_flag"))


_MANN_WHITNEY = """
SELECT round(u, 6) AS mann_whitney_u, round(2 * u / (n1 * n2) - 1, 6) AS rank_biserial,
       round((SELECT median(amount) FROM scored WHERE alert_flag), 6) AS alerted_median,
       round((SELECT median(amount) FROM scored WHERE NOT alert_flag), 6) AS nonalerted_median,
       round((greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5)
             / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))), 6) AS z
FROM (SELECT sum(CASE WHEN alert_flag THEN place END) - max(n1) * (max(n1) + 1) / 2 AS u, max(n1) AS n1, max(n2) AS n2
      FROM (SELECT alert_flag, rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2.0::DOUBLE AS place,
                   sum(alert_flag::INT) OVER ()::DOUBLE AS n1, sum((NOT alert_flag)::INT) OVER ()::DOUBLE AS n2 FROM scored) r) a,
     (SELECT sum(t * t * t - t) AS ties FROM (SELECT count(*)::DOUBLE AS t FROM scored GROUP BY amount) g) b
"""


@query("ST4 W11", _MANN_WHITNEY, "scored")
def amount_mann_whitney(v: Views) -> DataFrame:
    return statistics.mann_whitney(v.scored, "amount", "alert_flag")


@query("ST4 W11", _MANN_WHITNEY.replace("FROM scored", "FROM (SELECT * FROM scored WHERE amount >= 100) s"), "scored")
def mann_whitney_in_ranges(v: Views) -> DataFrame:
    gaps = v.scored.withColumn("amount", F.when(F.col("amount") >= 100, F.col("amount")))
    return statistics.mann_whitney(gaps, "amount", "alert_flag", range_values=100)


# Ways to choose the first group's ranks, by how many are chosen and their sum: one rank after the other.
_EXACT = """
SELECT u AS mann_whitney_u, n_yes, n_no, round(least(1, 2 * (SELECT sum(ways) FROM done WHERE chosen = n_yes AND s - n_yes * (n_yes + 1) / 2 >= greatest(u, n_yes * n_no - u))
  / (SELECT sum(ways) FROM done WHERE chosen = n_yes)), 6) AS u_p_value
FROM (SELECT sum(place) FILTER (yes) - count(*) FILTER (yes) * (count(*) FILTER (yes) + 1) / 2 AS u,
      (count(*) FILTER (yes))::DOUBLE AS n_yes, (count(*) FILTER (NOT yes))::DOUBLE AS n_no FROM
      (SELECT yes, (row_number() OVER (ORDER BY value))::DOUBLE AS place FROM days) r) t
"""
_DAYS = """
WITH RECURSIVE days AS (SELECT day(timestamp) <= 7 AS yes, sum(amount) AS value FROM scored GROUP BY timestamp::DATE, 1),
ways AS (
  SELECT 0 AS k, 0 AS chosen, 0 AS s, 1::DOUBLE AS ways
  UNION ALL
  SELECT k, chosen, s, sum(ways) FROM (
    SELECT k + 1 AS k, chosen, s, ways FROM ways WHERE k < (SELECT count(*) FROM days)
    UNION ALL SELECT k + 1, chosen + 1, s + k + 1, ways FROM ways WHERE k < (SELECT count(*) FROM days) AND chosen < 8) x
  GROUP BY k, chosen, s),
done AS (SELECT * FROM ways WHERE k = (SELECT count(*) FROM days))
"""


@query("ST4", f"SELECT * FROM ({_DAYS}{_EXACT}) e", "scored")
def first_week_mann_whitney(v: Views) -> DataFrame:
    """Daily payment values of the first week against the other days: so few that p is exact."""
    days = v.scored.groupBy(F.to_date("timestamp").alias("day")).agg(F.sum("amount").alias("value"))
    days = days.withColumn("first_week", F.dayofmonth("day") <= 7)
    tested = statistics.with_u_p(statistics.mann_whitney(days, "value", "first_week", sizes=True))
    return tested.select("mann_whitney_u", "n_yes", "n_no", "u_p_value")


@query("ST5 W11", """
SELECT round(corr(rx, ry), 6) AS spearman_rho, count(*) AS n FROM (
  SELECT rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2.0::DOUBLE AS rx,
         rank() OVER (ORDER BY risk_score) + (count(*) OVER (PARTITION BY risk_score) - 1) / 2.0::DOUBLE AS ry FROM scored) r
""", "scored")
def amount_risk_spearman(v: Views) -> DataFrame:
    return statistics.spearman(v.scored, "amount", "risk_score")


@query("ST6 ST2 ST4 ST5")
def statistics_bundle(v: Views) -> DataFrame:
    return statistics.statistics_bundle(v.kept_scored)


@query("B6 ST6 M34 M35 M36 M37 M38", """
SELECT round(sqrt(chi / n), 6) AS "Cramers V", round(2 * u / (n1 * n2) - 1, 6) AS "Rank Biserial",
       round((SELECT corr(rx, ry) FROM (
         SELECT rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2.0::DOUBLE AS rx,
                rank() OVER (ORDER BY risk_score) + (count(*) OVER (PARTITION BY risk_score) - 1) / 2.0::DOUBLE AS ry FROM scored) r), 6)
         AS "Spearman Rho",
       round((p + 3.8416::DOUBLE / (2 * n)) / (1 + 3.8416::DOUBLE / n)
         - 1.96::DOUBLE * sqrt(p * (1 - p) / n + 3.8416::DOUBLE / (4 * n * n)) / (1 + 3.8416::DOUBLE / n), 6) AS "Wilson Lower",
       round((p + 3.8416::DOUBLE / (2 * n)) / (1 + 3.8416::DOUBLE / n)
         + 1.96::DOUBLE * sqrt(p * (1 - p) / n + 3.8416::DOUBLE / (4 * n * n)) / (1 + 3.8416::DOUBLE / n), 6) AS "Wilson Upper"
FROM (SELECT *, n * greatest(abs(a * d - b * c) - n / 2, 0) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d)) AS chi
      FROM (SELECT sum((high_risk_geo = 0 AND NOT alert_flag)::INT)::DOUBLE AS a, sum((high_risk_geo = 0 AND alert_flag)::INT)::DOUBLE AS b,
                   sum((high_risk_geo = 1 AND NOT alert_flag)::INT)::DOUBLE AS c, sum((high_risk_geo = 1 AND alert_flag)::INT)::DOUBLE AS d,
                   count(*)::DOUBLE AS n, avg(alert_flag::INT) AS p FROM scored) t) x,
     (SELECT sum(CASE WHEN alert_flag THEN place END) - max(n1) * (max(n1) + 1) / 2 AS u, max(n1) AS n1, max(n2) AS n2
      FROM (SELECT alert_flag, rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2.0::DOUBLE AS place,
                   sum(alert_flag::INT) OVER ()::DOUBLE AS n1, sum((NOT alert_flag)::INT) OVER ()::DOUBLE AS n2 FROM scored) r) y
""", "scored")
def statistical_measures(v: Views) -> DataFrame:
    findings = marts.statistical_findings(statistics.statistics_bundle(v.kept_scored))
    names = ["Cramers V", "Rank Biserial", "Spearman Rho", "Wilson Lower", "Wilson Upper"]
    return measure_by({"statistical_findings": findings}, names)


@query("ML8", """
SELECT DISTINCT investigation_label::BIGINT AS label,
       round(n / (2.0::DOUBLE * CASE investigation_label WHEN 1 THEN pos ELSE n - pos END), 6) AS balanced,
       round(CASE investigation_label WHEN 1 THEN (n - pos) / pos::DOUBLE ELSE 1 END, 6) AS boosting
FROM scored, (SELECT count(*) AS n, sum(investigation_label) AS pos FROM scored) t
""", "scored")
def class_weights(v: Views) -> DataFrame:
    counts = models.class_counts(v.scored)
    w0, w1 = models.boosting_weights(*counts)
    boosted = F.when(F.col(models.LABEL) == 1, w1).otherwise(w0).alias("boosting")
    weights = models.balanced_weight(*counts).alias("balanced"), boosted
    return v.scored.select(F.col(models.LABEL).cast("bigint").alias("label"), *weights).distinct()


@query("ML15", """
SELECT fold, p AS rows_before, transaction_id AS last_before
FROM (SELECT k::BIGINT AS fold, n - (3 - k) * (n // 4) AS p FROM (SELECT count(*) AS n FROM scored) t, range(3) r(k)) e
JOIN (SELECT transaction_id, row_number() OVER (ORDER BY timestamp, transaction_id) AS place FROM scored) o ON place = p
""", "scored")
def fold_edges(v: Views) -> DataFrame:
    rows = v.scored.select("timestamp", models.KEY)
    edges = models.fold_edges(rows, 3)[:-1]
    last = F.max_by(models.KEY, F.struct("timestamp", models.KEY))
    folds = F.explode(F.array(*(F.struct(F.lit(k).alias("fold"), edge.alias("before")) for k, edge in enumerate(edges))))
    parts = rows.select("timestamp", models.KEY, folds.alias("x")).where("x.before")
    return parts.groupBy(F.col("x.fold").alias("fold")).agg(
        F.count(F.lit(1)).alias("rows_before"), last.alias("last_before")
    )


def _scaled(name: str, table: str) -> str:
    value = f"{name}::DOUBLE"
    return (
        f"SELECT '{name}' AS feature, round(m, 6) AS median, round(avg(coalesce({value}, m)), 6) AS mean,"
        f" round(stddev_pop(coalesce({value}, m)), 6) AS deviation, NULL::VARCHAR AS mode"
        f" FROM {table}, (SELECT quantile_cont({value}, 0.5) AS m FROM {table}) t GROUP BY m"
    )


def _mode(name: str, table: str) -> str:
    return (
        f"SELECT '{name}', NULL, NULL, NULL, (SELECT {name} FROM {table} WHERE {name} IS NOT NULL GROUP BY 1"
        f" ORDER BY count(*) DESC, 1 LIMIT 1)"
    )


def _learned(table: str) -> str:
    return " UNION ALL ".join([*(_scaled(n, table) for n in NUMERIC), *(_mode(n, table) for n in CATEGORICAL)])


def _parameters(v: Views, frame: DataFrame) -> DataFrame:
    learned = models.preprocessor().fit(frame).learned
    numbers = zip(NUMERIC, learned["medians"], learned["means"], learned["scales"], strict=True)
    # A constant feature is not scaled: its deviation is 0 and its scale 1.
    flat = {r["c"] for r in frame.select(F.explode(F.array(*(
        F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in NUMERIC
    ))).alias("e")).select("e.*").groupBy("c").agg(F.min("x").alias("a"), F.max("x").alias("b")).where("a = b").collect()}
    rows = [(n, m, mean, 0.0 if n in flat else scale, None) for n, m, mean, scale in numbers]
    rows += [(n, None, None, None, m) for n, m in zip(CATEGORICAL, learned["modes"], strict=True)]
    return v.spark.createDataFrame(rows, "feature string, median double, mean double, deviation double, mode string")


@query("ML6 ML7", _learned("scored"), "scored")
def preprocessing_parameters(v: Views) -> DataFrame:
    """What the preprocessing learns: a few numbers for each feature."""
    return _parameters(v, v.kept_scored)


_GAPS = """(SELECT * REPLACE (CASE WHEN amount_ratio >= 0.5 THEN amount_ratio END AS amount_ratio,
  CASE WHEN account_age_days % 3 <> 0 THEN account_age_days END AS account_age_days,
  CASE WHEN payment_channel <> (SELECT payment_channel FROM scored GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) THEN payment_channel END
  AS payment_channel) FROM scored)"""


@query("ML6 ML7", _learned(_GAPS), "scored")
def preprocessing_with_gaps(v: Views) -> DataFrame:
    """The same where values are missing: medians and modes of what is left fill them."""
    scored = v.kept_scored
    common = scored.groupBy("payment_channel").count().orderBy(F.desc("count"), "payment_channel").first()[0]
    return _parameters(v, scored.withColumns({
        "amount_ratio": F.when(F.col("amount_ratio") >= 0.5, F.col("amount_ratio")),
        "account_age_days": F.when(F.col("account_age_days") % 3 != 0, F.col("account_age_days")),
        "payment_channel": F.when(F.col("payment_channel") != common, F.col("payment_channel")),
    }))


# A span's exact values; the sketches only say whether they keep within their stated bounds.
_SPANS = " UNION ALL ".join(
    f"""SELECT '{name}' AS span, count(*) AS payments, count(DISTINCT customer_id) AS customers, true AS customers_within,
  round(quantile_disc(amount, 0.5), 6) AS median, true AS median_within, true AS p99_within
  FROM payments WHERE day(timestamp) BETWEEN {low} AND {high}"""
    for name, low, high in (("week 1", 1, 7), ("week 2", 8, 14), ("first half", 1, 15), ("month", 1, 31))
)


@query("A8 A11 P16", _SPANS, "payments")
def sketched_spans(v: Views) -> DataFrame:
    """Daily sketches merged over spans of days, held against the exact results of the same spans."""
    path = f"{shared_folder(v.spark)}/sketches-{uuid.uuid4().hex}"
    daily_sketches.daily(v.payments, F.to_date("timestamp"), ["customer_id"], ["amount"]).write.parquet(path)
    kept = v.spark.read.parquet(path)
    spans = F.explode(F.array(*(
        F.struct(F.lit(n).alias("span"), F.lit(a).alias("low"), F.lit(b).alias("high"))
        for n, a, b in (("week 1", 1, 7), ("week 2", 8, 14), ("first half", 1, 15), ("month", 1, 31))
    )))
    inside = F.dayofmonth("day").between(F.col("s.low"), F.col("s.high"))
    told = daily_sketches.merged(kept.withColumn("s", spans).where(inside), [F.col("s.span").alias("span")])
    told = told.select(
        "span", "rows", daily_sketches.distinct("customer_id").alias("n"),
        *(daily_sketches.quantile("amount", q).alias(c) for c, q in (("q50", 0.5), ("q99", 0.99))),
    )
    day = F.to_date("timestamp").alias("day")
    exact = v.payments.select(day, "customer_id", "amount").withColumn("s", spans).where(inside).select("s.span", "customer_id", "amount")
    counts = exact.groupBy("span").agg(F.count(F.lit(1)).alias("payments"), F.count_distinct("customer_id").alias("customers"))
    values = exact.groupBy("span", F.col("amount").alias("value")).agg(F.count(F.lit(1)).alias("n_value"))
    ranked = running_totals(values, "value", ["n_value"], ["span"]).join(told, "span")

    def within(column: str, q: float) -> Column:
        """Ranks of the estimate: rows below it and up to it."""
        below = F.sum(F.when(F.col("value") < F.col(column), F.col("n_value")).otherwise(0)) / F.max("n_value_total")
        upto = F.sum(F.when(F.col("value") <= F.col(column), F.col("n_value")).otherwise(0)) / F.max("n_value_total")
        return (below - q <= daily_sketches.RANK_BOUND) & (q - upto <= daily_sketches.RANK_BOUND)

    middle = at_rank(F.ceil(F.col("n_value_total") * 0.5) - 1, "value", "n_value")
    ranks = ranked.groupBy("span").agg(
        middle.alias("median"), within("q50", 0.5).alias("median_within"), within("q99", 0.99).alias("p99_within")
    )
    off = F.abs(F.col("n") - F.col("customers")) <= daily_sketches.COUNT_BOUND * F.col("customers")
    rows = counts.join(told.select("span", "n", "rows"), "span").join(ranks, "span")
    return rows.select(
        "span", F.col("rows").alias("payments"), "customers", off.alias("customers_within"), "median", "median_within", "p99_within"
    )
