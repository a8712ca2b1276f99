"""Screening, point-in-time features, rules and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.text import normalise_name
from riskweave.operators import alerts, features, rules, screening
from riskweave.operators.evaluation import full_metrics
from riskweave.plans.registry import query, r6, us
from riskweave.plans.sql_views import folded
from riskweave.plans.views import DAY_CONTROLS, MODEL_THRESHOLD, Views

RULE_COLUMNS = ["R01", "R02", "R03", "R04", "R05", "R06", "R07"]
VERDICT = (
    "counterparty, matched_entity, matched_entity_id, round(name_similarity_score, 6) AS name_similarity_score,"
    " alias_match, country_match, round(screening_score, 6) AS screening_score, screening_threshold,"
    " recommendation, reason_codes"
)


@query("E1", "SELECT counterparty_id, normal FROM requested", "requested")
def normalised_names(v: Views) -> DataFrame:
    return v.counterparties.select(
        "counterparty_id", normalise_name(F.col("counterparty_name")).alias("normal")
    )


@query("E1", f"SELECT conv_id, turn, {folded('text')} AS normal FROM conversations")
def normalised_accented_texts(v: Views) -> DataFrame:
    return v.table("conversations").select("conv_id", "turn", normalise_name(F.col("text")).alias("normal"))


@query("E2", "SELECT entity_id, listed_name, alias_match, (position - 1)::BIGINT AS name_position, normal FROM listed",
       "listed")
def listed_names(v: Views) -> DataFrame:
    return screening.candidates(v.watchlist).select(
        "entity_id", "listed_name", "alias_match", "name_position", "normal"
    )


@query("E3 E4 E5 E6 E7 E9 J8", f"SELECT counterparty_id, {VERDICT} FROM screened", "screened")
def screened_counterparties(v: Views) -> DataFrame:
    return v.screened


@query("E3 E5", f"SELECT counterparty_id, {VERDICT} FROM screened", "screened")
def screened_with_sliced_list(v: Views) -> DataFrame:
    """The same verdicts when the list does not fit one slice."""
    return screening.screen_counterparties(
        v.counterparties, v.watchlist, v.controls.screening_threshold, slice_rows=20
    )


@query("E8", """
SELECT 'blank name' AS problem, c_name AS value FROM (
  SELECT CASE WHEN c_acctbal < 0 THEN repeat('-', 1 + c_nationkey::INT) ELSE c_name END AS c_name FROM customer) n
WHERE trim(regexp_replace(lower(c_name), '[^a-z0-9 ]', ' ', 'g')) = ''
UNION ALL SELECT 'no active candidate', NULL
""")
def screening_input_problems(v: Views) -> DataFrame:
    """Customers as names to screen, those in debt with a name of signs only, against a list without active entities."""
    name = F.when(F.col("c_acctbal") < 0, F.repeat(F.lit("-"), 1 + F.col("c_nationkey").cast("int"))).otherwise(F.col("c_name"))
    names = v.table("customer").select(name.alias("counterparty_name"))
    inactive = v.watchlist.withColumn("active", F.lit(False))
    return screening.screening_problems(names, screening.candidates(inactive), "counterparty_name")


_QUALITY = """
SELECT '{grain}' AS grain, tn, fp, fn, tp, round(tp / greatest(tp + fp, 1)::DOUBLE, 6) AS precision,
       round(tp / greatest(tp + fn, 1)::DOUBLE, 6) AS recall,
       round(2 * tp / greatest(2 * tp + fp + fn, 1)::DOUBLE, 6) AS f1,
       round(fp / greatest(fp + tn, 1)::DOUBLE, 6) AS false_positive_rate,
       round(fn / greatest(fn + tp, 1)::DOUBLE, 6) AS false_negative_rate,
       (SELECT round(sum((p.s > n.s)::INT * p.c * n.c + 0.5 * (p.s = n.s)::INT * p.c * n.c)
                     / (sum(p.c * n.c)), 6)
        FROM (SELECT s, count(*) AS c FROM {grain} WHERE y = 1 GROUP BY s) p,
             (SELECT s, count(*) AS c FROM {grain} WHERE y = 0 GROUP BY s) n) AS roc_auc
FROM (SELECT sum((y = 0 AND s < 0.88)::INT)::BIGINT AS tn, sum((y = 0 AND s >= 0.88)::INT)::BIGINT AS fp,
             sum((y = 1 AND s < 0.88)::INT)::BIGINT AS fn, sum((y = 1 AND s >= 0.88)::INT)::BIGINT AS tp
      FROM {grain}) cells
"""


@query("E10 ML1 ML2", f"""
SELECT * FROM (WITH entity AS (SELECT synthetic_sanctions_flag::INT AS y, screening_score / 100 AS s
                               FROM screened JOIN counterparties USING (counterparty_id)),
     payment AS (SELECT screening_truth AS y, screening_score / 100 AS s FROM featured)
{_QUALITY.format(grain='entity')} UNION ALL {_QUALITY.format(grain='payment')}) q
""", "screened", "counterparties", "featured")
def screening_quality(v: Views) -> DataFrame:
    threshold = v.controls.screening_threshold / 100
    truth = v.counterparties.select("counterparty_id", F.col("synthetic_sanctions_flag").cast("int").alias("y"))
    entity = v.screened.join(truth, "counterparty_id").select("y", (F.col("screening_score") / 100).alias("s"))
    per_cp = v.screened.join(truth, "counterparty_id").select(
        "counterparty_id", "y", (F.col("screening_score") / 100).alias("s")
    )
    payment = v.payments.select("counterparty_id").join(per_cp, "counterparty_id").select("y", "s")
    parts = [
        full_metrics(frame, "y", "s", threshold).withColumn("grain", F.lit(grain))
        for grain, frame in (("entity", entity), ("payment", payment))
    ]
    return parts[0].unionByName(parts[1]).drop("pr_auc_ap")


@query("E11", f"""
SELECT {VERDICT} FROM screened
""", "screened")
def adhoc_screening(v: Views) -> DataFrame:
    """The counterparties sent as ad-hoc requests, entity type left to its default."""
    requests = v.counterparties.select(
        F.col("counterparty_name").alias("name"), "country", F.lit(None).cast("string").alias("entity_type")
    )
    verdicts, _ = screening.screen_requests(
        requests, v.watchlist, v.controls.screening_threshold, country_codes=False
    )
    return verdicts.withColumnRenamed("counterparty_name", "counterparty").drop("country", "entity_type")


@query("E11", f"""
SELECT problem, count(*) AS n FROM (
  SELECT CASE WHEN trim(text) = '' THEN 'NAME_MISSING' WHEN length(trim(text)) > 200 THEN 'NAME_TOO_LONG'
              WHEN {folded('text')} = '' THEN 'NAME_BLANK_AFTER_FOLDING'
              WHEN conv_id % 2 = 1 THEN 'COUNTRY_INVALID'
              WHEN role NOT IN ('user', 'assistant') THEN 'ENTITY_TYPE_INVALID' END AS problem FROM conversations) c
WHERE problem IS NOT NULL GROUP BY 1
""")
def refused_screening_requests(v: Views) -> DataFrame:
    """Conversation turns sent as requests; most break some rule of the request contract."""
    role = F.col("role")
    requests = v.table("conversations").select(
        F.col("text").alias("name"),
        F.when(F.col("conv_id") % 2 == 0, "GB").otherwise("gb").alias("country"),
        F.when(role == "user", "PERSON").when(role == "assistant", "BUSINESS").otherwise(role).alias("entity_type"),
    )
    _, refused = screening.screen_requests(requests, v.watchlist, v.controls.screening_threshold)
    return refused.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@query("W1 W2 W3", f"""
SELECT transaction_id, {r6('amount / expected_amount', 'amount_ratio')},
       (destination_country IN ('NATION_5', 'NATION_6'))::BIGINT AS high_risk_geo, (hour(timestamp) < 5)::BIGINT AS night
FROM payments JOIN customers USING (customer_id)
""", "payments", "customers")
def row_features(v: Views) -> DataFrame:
    joined = v.payments.join(v.customers.select("customer_id", "expected_amount"), "customer_id")
    return features.row_features(joined, v.controls).select(
        "transaction_id", "amount_ratio", "high_risk_geo", "night"
    )


@query("W4 W9", "SELECT transaction_id, new_counterparty::BIGINT AS new_counterparty FROM history", "history")
def new_counterparties(v: Views) -> DataFrame:
    return features.history_features(v.payments, v.controls).select("transaction_id", "new_counterparty")


@query("W6 W7", "SELECT transaction_id, velocity_1h, adjacent_prior_24h FROM history", "history")
def velocity_windows(v: Views) -> DataFrame:
    return features.history_features(v.payments, v.controls).select(
        "transaction_id", "velocity_1h", "adjacent_prior_24h"
    )


@query("W6 W7", "SELECT transaction_id, velocity_1h, adjacent_prior_24h FROM day_history", "day_history")
def velocity_windows_of_a_day(v: Views) -> DataFrame:
    return features.history_features(v.payments, DAY_CONTROLS).select(
        "transaction_id", "velocity_1h", "adjacent_prior_24h"
    )


@query("W8", "SELECT transaction_id, velocity_1h, adjacent_prior_24h FROM day_history", "day_history")
def sliding_frame_windows(v: Views) -> DataFrame:
    """The sliding-frame form; agrees with the prefix form."""
    return features.history_features(v.payments, DAY_CONTROLS, by_prefix=False).select(
        "transaction_id", "velocity_1h", "adjacent_prior_24h"
    )


@query("W5 W1 W4 J1", f"""
SELECT transaction_id, {r6('amount_ratio')}, high_risk_geo::BIGINT AS high_risk_geo, night::BIGINT AS night, velocity_1h,
       new_counterparty::BIGINT AS new_counterparty, new_counterparty_high_value::BIGINT AS new_counterparty_high_value,
       adjacent_prior_24h, {r6('screening_score')}, account_age_days::BIGINT AS account_age_days, pep_flag,
       payment_channel, payment_type, kyc_status
FROM featured
""", "featured")
def feature_table(v: Views) -> DataFrame:
    return v.featured.select("transaction_id", "new_counterparty", *features.FEATURES)


_RULED = f"""
SELECT transaction_id, {', '.join(RULE_COLUMNS)}, risk_score::BIGINT AS risk_score, rule_reasons, rule_review
FROM """


@query("R1 R2 R3 R4", _RULED + "ruled", "ruled")
def rule_scores(v: Views) -> DataFrame:
    return v.ruled.select("transaction_id", *RULE_COLUMNS, "risk_score", "rule_reasons", "rule_review")


@query("R1 R2 R3 R4", _RULED + "day_ruled", "day_ruled")
def rule_scores_with_day_velocity(v: Views) -> DataFrame:
    day = Views(v.spark, v.folder, DAY_CONTROLS)
    return day.ruled.select("transaction_id", *RULE_COLUMNS, "risk_score", "rule_reasons", "rule_review")


@query("R5", """
SELECT transaction_id, unnest(string_split(rule_reasons, '|')) AS rule_name FROM ruled WHERE rule_reasons <> ''
""", "ruled")
def rule_evidence_names(v: Views) -> DataFrame:
    evidence = F.explode(rules.rule_evidence(v.controls)).alias("e")
    return v.featured.select("transaction_id", evidence).select("transaction_id", "e.rule_name")


@query("R5")
def rule_evidence_rows(v: Views) -> DataFrame:
    evidence = F.explode(rules.rule_evidence(v.controls)).alias("e")
    return v.featured.select("transaction_id", evidence).select("transaction_id", "e.*")


@query("R7", "SELECT transaction_id, rule_review, model_review, recommendation, alert_flag FROM scored", "scored")
def alert_decisions(v: Views) -> DataFrame:
    return v.scored.select("transaction_id", "rule_review", "model_review", "recommendation", "alert_flag")


@query("R8", f"""
SELECT alert_id, transaction_id, customer_id, counterparty_id, alert_type, {r6('risk_score')}, rules_triggered,
       model_version, screening_version, {us('created_at')}, status, {r6('amount_ratio')}, {r6('screening_score')}, velocity_1h
FROM alerts
""", "alerts")
def alert_table(v: Views) -> DataFrame:
    rows = alerts.alert_rows(v.scored, v.controls)
    return rows.select(
        "alert_id", "transaction_id", "customer_id", "counterparty_id", "alert_type", "risk_score", "rules_triggered",
        "model_version", "screening_version", "created_at", "status", "evidence.amount_ratio",
        "evidence.screening_score", "evidence.velocity_1h",
    )


@query("R9", f"""
SELECT transaction_id, {r6('model_probability', 'probability')}, {MODEL_THRESHOLD}::DOUBLE AS model_threshold,
       risk_score::BIGINT AS risk_score, CASE WHEN alert_flag THEN 'REVIEW' ELSE 'CLEAR' END AS recommendation,
       len(list_filter(string_split(rule_reasons, '|'), lambda s: s <> '')) AS rules_hit, alert_flag AS human_review_required
FROM scored
""", "scored")
def payment_score_lookup(v: Views) -> DataFrame:
    """Every raw payment id is requested; those without a positive amount are unknown."""
    sheet, _ = alerts.payment_scores(v.all_payments, v.scored, v.controls, MODEL_THRESHOLD)
    return sheet.select(
        "transaction_id", "probability", "model_threshold", "risk_score", "recommendation",
        F.size("rules").alias("rules_hit"), "human_review_required",
    )


@query("R9", "SELECT transaction_id || '-VOID' AS transaction_id FROM all_payments", "all_payments")
def unknown_score_requests(v: Views) -> DataFrame:
    """Every payment id is requested, and every id with an ending that no payment has."""
    ids = v.all_payments.select("transaction_id")
    requests = ids.union(ids.select(F.concat("transaction_id", F.lit("-VOID"))))
    _, unknown = alerts.payment_scores(requests, v.all_payments.withColumns({
        "model_probability": F.lit(0.0), "rule_review": F.lit(False), "recommendation": F.lit("CLEAR"),
        "risk_score": F.lit(0), **{r.feature: F.lit(0) for r in v.controls.rules},
    }), v.controls, MODEL_THRESHOLD)
    return unknown


@query("R10 R11", """
SELECT alert_id, printf('Transaction %s has amount / expected baseline ratio %.2f [amount_ratio], synthetic reference similarity %.1f/100 [screening_score], and %d prior payments in one hour [velocity_1h]. Triggered controls: %s [rules_triggered]. Human review required.',
       transaction_id, amount_ratio, screening_score, velocity_1h, CASE WHEN rules_triggered = '' THEN 'MODEL_THRESHOLD' ELSE rules_triggered END) AS summary,
       'deterministic_fallback' AS mode, 'amount_ratio|screening_score|velocity_1h|rules_triggered' AS evidence_fields,
       true AS human_review_required
FROM alerts
""", "alerts")
def evidence_summaries(v: Views) -> DataFrame:
    return alerts.summarise_cases(alerts.alert_rows(v.scored, v.controls))


@query("R11", """
SELECT CASE WHEN event_id % 2 = 0 THEN 'validated_template' ELSE 'deterministic_fallback' END AS mode, count(*) AS n
FROM alerts GROUP BY 1
""", "alerts")
def accepted_summaries(v: Views) -> DataFrame:
    """Texts of even payments are the template itself, those of odd ones are altered."""
    odd = F.expr("cast(substring(transaction_id, 4) as bigint)") % 2 == 1
    rows = alerts.alert_rows(v.scored, v.controls).withColumn("text", alerts.summary_text())
    supplied = rows.withColumn("text", F.when(odd, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return alerts.summarise_cases(supplied, "text").groupBy("mode").agg(F.count(F.lit(1)).alias("n"))
