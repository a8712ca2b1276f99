"""Star schema, marts, measures, operational aggregates and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.bands import flag
from riskweave.operators import aggregates, contracts, marts, measures, sampling, warehouse
from riskweave.operators.cases import list_cases
from riskweave.operators.measures import VISUALS
from riskweave.operators.warehouse import STAR_CONSTRAINTS
from riskweave.plans.registry import day, query, r6, us
from riskweave.plans.views import Views
from riskweave.sources.adapters import RISK_COUNTRIES

KEYS = ", ".join(marts.KEYS[:5])


@query("A1", f"""
SELECT count(*) AS transactions_screened, sum(alert_flag::INT)::BIGINT AS alerts, {r6('avg(alert_flag::INT)', 'alert_rate')},
       {r6('avg(risk_score)', 'average_risk_score')}, sum((alert_flag AND risk_score >= 70)::INT)::BIGINT AS high_risk_alerts
FROM scored
""", "scored")
def operations_summary(v: Views) -> DataFrame:
    return aggregates.operations_summary(v.scored)


@query("A2 J5", f"""
SELECT {day('timestamp', 'calendar_date')}, count(*) AS transactions, sum(alert_flag::INT)::BIGINT AS alerts,
       round(sum(amount::DECIMAL(18,2))::DOUBLE, 6) AS payment_value_gbp, {r6('avg(risk_score)', 'average_risk_score')}
FROM scored GROUP BY 1
""", "scored")
def daily_operations(v: Views) -> DataFrame:
    facts = v.scored.withColumn("date_key", warehouse.date_key("timestamp"))
    return aggregates.daily_operations(facts, warehouse.dim_date(v.payments))


@query("A3", f"""
SELECT {day('timestamp', 'day')}, count(*) AS transactions, sum(alert_flag::INT)::BIGINT AS alerts
FROM scored WHERE payment_channel IN ('click', 'view', 'purchase') GROUP BY 1
""", "scored")
def daily_counts_of_channels(v: Views) -> DataFrame:
    return aggregates.daily_counts(aggregates.in_channels(v.scored, ["click", "view", "purchase"]))


@query("A4", f"SELECT payment_channel, {r6('avg(alert_flag::INT)', 'alert_rate')} FROM scored GROUP BY 1", "scored")
def alert_rate_by_channel(v: Views) -> DataFrame:
    return aggregates.alert_rate_by(v.scored, "payment_channel")


@query("A5", f"""
SELECT destination_country, count(*) AS payments, sum(alert_flag::INT)::BIGINT AS alerts, {r6('avg(risk_score)', 'average_risk')}
FROM scored GROUP BY 1
""", "scored")
def geography_profile(v: Views) -> DataFrame:
    return aggregates.geography_profile(v.scored)


@query("A6", """
SELECT reason, count(*) AS alerts FROM (SELECT unnest(string_split(rule_reasons, '|')) AS reason FROM scored WHERE alert_flag) r
WHERE reason <> '' GROUP BY 1
""", "scored")
def reason_frequency(v: Views) -> DataFrame:
    return aggregates.reason_frequency(v.scored)


@query("A7", """
SELECT 'country' AS kind, destination_country AS value, count(*) AS n FROM payments GROUP BY 2
UNION ALL SELECT 'channel', payment_channel, count(*) FROM payments GROUP BY 2
UNION ALL SELECT 'status', status, count(*) FROM payments GROUP BY 2
""", "payments")
def payment_value_counts(v: Views) -> DataFrame:
    parts = [
        aggregates.value_counts(v.payments, column).select(
            F.lit(kind).alias("kind"), F.col(column).alias("value"), "n"
        )
        for kind, column in (("country", "destination_country"), ("channel", "payment_channel"), ("status", "status"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("A9", """
SELECT high_risk_geo::BIGINT AS high_risk_geo, sum((NOT alert_flag)::INT)::BIGINT AS not_flagged,
       sum(alert_flag::INT)::BIGINT AS flagged FROM scored GROUP BY 1
""", "scored")
def geography_alert_crosstab(v: Views) -> DataFrame:
    return aggregates.crosstab(v.scored, "high_risk_geo", "alert_flag")


@query("A10", """
SELECT greatest(least(floor(screening_score / (100.0::DOUBLE / 35))::BIGINT + 1, 36), 0) AS bin, count(*) AS n FROM scored GROUP BY 1
""", "scored")
def screening_score_histogram(v: Views) -> DataFrame:
    return aggregates.histogram(v.scored, "screening_score", 0, 100, 35)


@query("A10", """
SELECT alert_flag, greatest(least(floor(amount / 500)::BIGINT + 1, 81), 0) AS bin, count(*) AS n FROM scored GROUP BY 1, 2
""", "scored")
def amount_histogram_by_alert(v: Views) -> DataFrame:
    return aggregates.histogram(v.scored, "amount", 0, 40_000, 80, by="alert_flag")


@query("A11", "SELECT count(DISTINCT customer_id) AS n FROM payments", "payments")
def observed_customers(v: Views) -> DataFrame:
    return aggregates.distinct_count(v.payments, "customer_id")


@query("A12", "SELECT count(*) AS rows, round(sum(amount::DECIMAL(18,2))::DOUBLE, 6) AS total FROM payments", "payments")
def payment_totals(v: Views) -> DataFrame:
    return aggregates.column_totals(v.payments)


@query("A13", """
SELECT counterparty_id, count(*) AS alerts FROM scored WHERE alert_flag GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""", "scored")
def top_counterparties_by_alerts(v: Views) -> DataFrame:
    return aggregates.top_by_alerts(v.scored, "counterparty_id", 10)


@query("A14", """
SELECT payment_channel, sum((alert_flag AND investigation_label = 0)::INT)::BIGINT AS false_positives,
       sum((NOT alert_flag AND investigation_label = 1)::INT)::BIGINT AS false_negatives FROM scored GROUP BY 1
""", "scored")
def policy_errors_by_channel(v: Views) -> DataFrame:
    return aggregates.policy_errors_by(v.scored, "payment_channel")


@query("D1", f"""
SELECT customer_id + 1 AS customer_key, customer_id, account_id, customer_type, residence_country,
       account_age_days::BIGINT AS account_age_days, industry, risk_segment, kyc_status, pep_flag,
       expected_monthly_volume::BIGINT AS expected_monthly_volume, {r6('expected_amount')}, {r6('expected_min')}, {r6('expected_max')}
FROM customers
""", "customers")
def dim_customer(v: Views) -> DataFrame:
    return warehouse.dim_customer(v.customers)


@query("D1", """
SELECT counterparty_id + 1 AS counterparty_key, counterparty_id, counterparty_name, country, counterparty_type FROM counterparties
""", "counterparties")
def dim_counterparty(v: Views) -> DataFrame:
    return warehouse.dim_counterparty(v.counterparties)


@query("D2", f"""
SELECT date_key::BIGINT AS date_key, {day('calendar_date', 'calendar_date')}, year, month, day FROM dim_date
""", "dim_date")
def dim_date(v: Views) -> DataFrame:
    return warehouse.dim_date(v.payments)


@query("D3", "SELECT * FROM dim_geography", "dim_geography")
def dim_geography(v: Views) -> DataFrame:
    return warehouse.dim_geography(v.payments, RISK_COUNTRIES)


@query("D4", "SELECT * FROM dim_payment_channel", "dim_payment_channel")
def dim_payment_channel(v: Views) -> DataFrame:
    return warehouse.dim_payment_channel(v.payments)


@query("D5", """
SELECT r.risk_key::BIGINT AS risk_key, risk_category, count(f.transaction_id) AS payments
FROM dim_risk_category r LEFT JOIN fact f ON f.risk_key = r.risk_key GROUP BY 1, 2
""", "dim_risk_category", "fact")
def risk_categories_with_payments(v: Views) -> DataFrame:
    payments = v.scored.groupBy(warehouse.risk_key("risk_score").alias("risk_key")).agg(
        F.count(F.lit(1)).alias("payments")
    )
    return warehouse.dim_risk_category(v.spark).join(payments, "risk_key", "left").withColumn(
        "payments", F.coalesce("payments", F.lit(0))
    )


@query("D6", f"""
SELECT transaction_id, customer_key, counterparty_key, date_key::BIGINT AS date_key, origin_geography_key,
       destination_geography_key, channel_key, risk_key::BIGINT AS risk_key, {us('timestamp')}, {r6('amount')}, currency,
       payment_type, payment_category, originating_bank, network, beneficiary_bank, status, {r6('risk_score')},
       {r6('model_probability')}, {r6('screening_score')}, alert_flag, rule_reasons,
       investigation_label::BIGINT AS investigation_label, screening_truth::BIGINT AS screening_truth
FROM fact
""", "fact")
def fact_transactions(v: Views) -> DataFrame:
    return warehouse.fact_transactions(
        v.scored, warehouse.dim_geography(v.payments, RISK_COUNTRIES), warehouse.dim_payment_channel(v.payments)
    )


@query("D7 K7", f"""
SELECT alert_id, transaction_id, customer_id + 1 AS customer_key, counterparty_id + 1 AS counterparty_key,
       strftime(created_at, '%Y%m%d')::BIGINT AS date_key, alert_type, {r6('risk_score')}, rules_triggered, model_version,
       screening_version, {us('created_at')}, status, investigator_notes, disposition, reason_code, {us('reviewed_at')}
FROM cases
""", "cases")
def fact_screening_alerts(v: Views) -> DataFrame:
    return warehouse.fact_screening_alerts(v.cases)


def _constraint_sql() -> str:
    named = {
        "dim_customer": "(SELECT customer_id + 1 AS customer_key, customer_id FROM customers)",
        "dim_counterparty": "(SELECT counterparty_id + 1 AS counterparty_key, counterparty_id FROM counterparties)",
        "dim_date": "dim_date", "dim_geography": "dim_geography", "dim_payment_channel": "dim_payment_channel",
        "dim_risk_category": "dim_risk_category", "fact_transactions": "fact", "fact_screening_alerts": "alerts_mart",
    }
    parts = []
    for c in STAR_CONSTRAINTS:
        t, col = named[c.table], c.column
        if c.kind == "foreign":
            body = f"SELECT count(*) FROM {t} x WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {c.parent_column} FROM {named[c.parent]} y)"
        elif c.kind == "not_null":
            body = f"SELECT count(*) FROM {t} x WHERE {col} IS NULL"
        else:
            body = f"SELECT count({col}) - count(DISTINCT {col}) FROM {t} x"
        parts.append(f"""SELECT '{c.name}' AS "constraint", ({body})::BIGINT AS violations""")
    return "\nUNION ALL ".join(parts)


@query("C6", _constraint_sql(), "customers", "counterparties", "dim_date", "dim_geography", "dim_payment_channel",
       "dim_risk_category", "fact", "alerts_mart")
def star_constraints(v: Views) -> DataFrame:
    return contracts.check_constraints(v.star, STAR_CONSTRAINTS)


@query("B1", f"""
SELECT counterparty_key, counterparty_id, counterparty_name, country, counterparty_type, baseline_risk, matched_entity,
       matched_entity_id, {r6('name_similarity_score')}, alias_match, country_match, {r6('screening_score')},
       screening_threshold, recommendation, reason_codes, match_method
FROM dim_counterparty_rich
""", "dim_counterparty_rich")
def mart_counterparties(v: Views) -> DataFrame:
    return marts.enriched_counterparties(
        warehouse.dim_counterparty(v.counterparties), v.counterparties, v.screened, check=False
    )


@query("B2", f"""
SELECT transaction_id, customer_key, counterparty_key, date_key::BIGINT AS date_key, origin_geography_key,
       destination_geography_key, channel_key, risk_key::BIGINT AS risk_key,
       strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS timestamp, {r6('amount')}, currency, payment_type, payment_category,
       originating_bank, network, beneficiary_bank, status, {r6('risk_score')}, {r6('model_probability')},
       {r6('screening_score')}, alert_flag::BIGINT AS alert_flag, rule_reasons,
       investigation_label::BIGINT AS investigation_label, screening_truth::BIGINT AS screening_truth, velocity_1h,
       {r6('amount_ratio')}, night::BIGINT AS night, new_counterparty::BIGINT AS new_counterparty, recommendation, hour_utc,
       screening_review::BIGINT AS screening_review, screening_score_band::BIGINT AS screening_score_band, amount_band
FROM fact
""", "fact")
def mart_transactions(v: Views) -> DataFrame:
    return v.marts["fact_transactions"]


@query("B3", f"""
SELECT alert_id, transaction_id, customer_id, counterparty_id, alert_type, {r6('risk_score')}, rules_triggered,
       model_version, screening_version, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at, status,
       investigator_notes, disposition, reason_code, strftime(reviewed_at, '%Y-%m-%dT%H:%M:%S') AS reviewed_at,
       {KEYS}, channel_key, risk_key::BIGINT AS risk_key, {r6('age_at_data_cutoff_days')}
FROM (SELECT * REPLACE (date_key::BIGINT AS date_key) FROM alerts_mart) a
""", "alerts_mart")
def mart_alerts(v: Views) -> DataFrame:
    return v.marts["fact_screening_alerts"]


@query("B4 J12", "SELECT alert_id, rule_name FROM bridge", "bridge")
def mart_alert_rules(v: Views) -> DataFrame:
    return v.marts["bridge_alert_rules"]


@query("J12", """
SELECT rule_name, alert_type, count(*) AS n FROM bridge JOIN (SELECT alert_id, alert_type FROM alerts) a USING (alert_id) GROUP BY 1, 2
""", "bridge", "alerts")
def rules_by_alert_type(v: Views) -> DataFrame:
    bridge = marts.alert_rules_bridge(v.alerts)
    return bridge.join(v.alerts.select("alert_id", "alert_type"), "alert_id").groupBy("rule_name", "alert_type").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("B8", """
SELECT unnest(['transactions', 'alerts', 'average_risk_score', 'high_risk_alerts']) AS "check", true AS passed
FROM (SELECT count(*) AS n FROM fact) f
""", "fact")
def mart_reconciliation(v: Views) -> DataFrame:
    return marts.reconcile_marts(
        v.marts["fact_transactions"], v.marts["fact_screening_alerts"], aggregates.operations_summary(v.kept_scored)
    )


@query("B9", """
SELECT 'transactions' AS metric, count(*)::DOUBLE AS value FROM fact
UNION ALL SELECT 'alert_rate', round(avg(alert_flag::INT), 6) FROM fact
UNION ALL SELECT 'high_risk_alerts', sum((alert_flag AND risk_score >= 70)::INT)::DOUBLE FROM fact
UNION ALL SELECT 'average_risk_score', round(avg(risk_score), 6) FROM fact
UNION ALL SELECT 'total_amount_gbp', round(sum(amount::DECIMAL(18,2))::DOUBLE, 6) FROM fact
UNION ALL SELECT 'alerts', count(*)::DOUBLE FROM alerts_mart
UNION ALL SELECT 'status_' || status, count(*)::DOUBLE FROM alerts_mart GROUP BY 1
""", "fact", "alerts_mart")
def mart_totals(v: Views) -> DataFrame:
    return marts.export_totals(v.marts["fact_transactions"], v.marts["fact_screening_alerts"])


@query("B10 J4", """
SELECT o.country_code AS origin, d.country_code AS destination, count(*) AS payments FROM fact
JOIN dim_geography o ON o.geography_key = origin_geography_key JOIN dim_geography d ON d.geography_key = destination_geography_key
GROUP BY 1, 2
""", "fact", "dim_geography")
def payments_by_route(v: Views) -> DataFrame:
    geography = warehouse.dim_geography(v.payments, RISK_COUNTRIES)
    roles = marts.role_geographies(geography)
    keyed = warehouse.lookup_keys(v.payments, geography, warehouse.dim_payment_channel(v.payments))
    per_route = keyed.groupBy("origin_geography_key", "destination_geography_key").agg(F.count(F.lit(1)).alias("payments"))

    def role(name, alias):
        return roles[f"dim_{name}_geography"].select(
            F.col("geography_key").alias(f"{name}_geography_key"), F.col("country_code").alias(alias)
        )

    return (
        per_route.join(role("origin", "origin"), "origin_geography_key")
        .join(role("destination", "destination"), "destination_geography_key")
        .select("origin", "destination", "payments")
    )


# SQL of the plain measures over the transaction or alert mart.
_MEASURE_SQL = {
    "Transactions Screened": ("fact", "count(*)"),
    "Review Alerts": ("alerts_mart", "count(*)"),
    "High-Risk Alerts": ("alerts_mart", "nullif(sum((risk_score >= 70)::INT), 0)"),
    "Average Risk Score": ("fact", "avg(risk_score)"),
    "Total Amount GBP": ("fact", "sum(amount::DECIMAL(18,2))"),
    "Average Amount GBP": ("fact", "sum(amount::DECIMAL(18,2))::DOUBLE / count(*)"),
    "Average Velocity": ("fact", "avg(velocity_1h)"),
    "Velocity Spike Payments": ("fact", "nullif(sum((velocity_1h >= 4)::INT), 0)"),
    "Unusual-Time Payments": ("fact", "nullif(sum(night), 0)"),
    "Screening Alerts": ("fact", "nullif(sum(screening_review), 0)"),
    "Screening TP": ("fact", "nullif(sum((screening_review = 1 AND screening_truth = 1)::INT), 0)"),
    "Screening FP": ("fact", "nullif(sum((screening_review = 1 AND screening_truth = 0)::INT), 0)"),
    "Screening FN": ("fact", "nullif(sum((screening_review = 0 AND screening_truth = 1)::INT), 0)"),
    "Screening TN": ("fact", "nullif(sum((screening_review = 0 AND screening_truth = 0)::INT), 0)"),
    "Open Alerts": ("alerts_mart", "sum((status = 'OPEN')::INT)"),
    "In Review Alerts": ("alerts_mart", "sum((status = 'IN_REVIEW')::INT)"),
    "Escalated Alerts": ("alerts_mart", "sum((status = 'ESCALATED')::INT)"),
    "Closed Alerts": ("alerts_mart", "sum((status = 'CLOSED')::INT)"),
    "Reviewed False Positives": ("alerts_mart", "sum((disposition = 'FALSE_POSITIVE')::INT)"),
    "Average Case Age at Cutoff": ("alerts_mart", "avg(age_at_data_cutoff_days)"),
    "Rule Alerts": ("bridge", "count(*)"),
}
_FORMULA_SQL = {
    "Alert Rate": '"Review Alerts" / "Transactions Screened"',
    "Screening Precision": '"Screening TP" / ("Screening TP" + coalesce("Screening FP", 0))',
    "Screening Recall": '"Screening TP" / ("Screening TP" + coalesce("Screening FN", 0))',
    "Screening F1": '2 * "Screening TP" / (2 * "Screening TP" + coalesce("Screening FP", 0) + coalesce("Screening FN", 0))',
    "Screening FPR": '"Screening FP" / ("Screening FP" + coalesce("Screening TN", 0))',
    "Screening FNR": '"Screening FN" / ("Screening FN" + coalesce("Screening TP", 0))',
    "Reviewed FP Share": '"Reviewed False Positives" / nullif("Closed Alerts", 0)',
}


def _total_measures_sql(where: str = "true") -> str:
    picks = [
        f'(SELECT ({expr})::DOUBLE FROM {table} WHERE {where}) AS "{name}"'
        for name, (table, expr) in _MEASURE_SQL.items()
    ]
    names = [f'round("{n}", 6) AS "{n}"' for n in _MEASURE_SQL]
    formulas = [f'round({f}, 6) AS "{n}"' for n, f in _FORMULA_SQL.items()]
    return f"SELECT {', '.join(names + formulas)} FROM (SELECT {', '.join(picks)}) m"


MART_MEASURES = [*_MEASURE_SQL, *_FORMULA_SQL]


@query("M1 M2 M3 M4 M5 M6 M7 M8 M9 M10 M11 M12 M13 M14 M15 M16 M17 M18 M19 M20 M21 M22 M23 M24 M25 M26 M27 M28",
       _total_measures_sql(), "fact", "alerts_mart", "bridge")
def measures_in_total(v: Views) -> DataFrame:
    return measures.measure_by(v.marts, MART_MEASURES)


FILTERS = {
    ("dim_payment_channel", "payment_channel"): ["purchase", "view"],
    ("dim_risk_category", "risk_category"): ["MEDIUM", "HIGH"],
}
_FILTER_SQL = (
    "risk_key IN (2, 3) AND channel_key IN (SELECT channel_key FROM dim_payment_channel"
    " WHERE payment_channel IN ('purchase', 'view'))"
)


@query("M1 M3 A15", _total_measures_sql(_FILTER_SQL), "fact", "alerts_mart", "bridge", "dim_payment_channel")
def measures_under_filters(v: Views) -> DataFrame:
    return measures.measure_by(v.marts, MART_MEASURES, filters=FILTERS)


_ATTRIBUTE_SQL = {
    ("dim_date", "calendar_date"): "strftime(strptime(date_key::VARCHAR, '%Y%m%d'), '%Y-%m-%d')",
    ("dim_risk_category", "risk_category"): "(SELECT risk_category FROM dim_risk_category r WHERE r.risk_key = x.risk_key)",
    ("dim_payment_channel", "payment_channel"):
        "(SELECT payment_channel FROM dim_payment_channel c WHERE c.channel_key = x.channel_key)",
    ("dim_origin_geography", "country_code"):
        "(SELECT country_code FROM dim_geography g WHERE g.geography_key = x.origin_geography_key)",
    ("dim_destination_geography", "country_code"):
        "(SELECT country_code FROM dim_geography g WHERE g.geography_key = x.destination_geography_key)",
    ("dim_counterparty", "match_method"):
        "(SELECT match_method FROM dim_counterparty_rich p WHERE p.counterparty_key = x.counterparty_key)",
    ("dim_counterparty", "baseline_risk"):
        "(SELECT baseline_risk FROM dim_counterparty_rich p WHERE p.counterparty_key = x.counterparty_key)",
}


def _page_sql(page: str) -> str:
    parts = []
    for name, (measure, table, column) in VISUALS[page].items():
        label = _ATTRIBUTE_SQL.get((table, column), f"{column}::VARCHAR")
        if measure == "Alert Rate":
            body = (
                f"SELECT t.g AS group_value, a.n / t.n::DOUBLE AS value FROM"
                f" (SELECT {label} AS g, count(*) AS n FROM fact x GROUP BY 1) t JOIN"
                f" (SELECT {label} AS g, count(*) AS n FROM alerts_mart x GROUP BY 1) a USING (g)"
            )
        else:
            source, expression = _MEASURE_SQL[measure]
            body = f"SELECT {label} AS group_value, ({expression})::DOUBLE AS value FROM {source} x GROUP BY 1"
        parts.append(f"SELECT '{name}' AS visual, group_value, round(value, 6) AS value FROM ({body}) b WHERE value IS NOT NULL")
    return "\nUNION ALL ".join(parts)


_PAGE_CTES = ("fact", "alerts_mart", "bridge", "dim_risk_category", "dim_payment_channel", "dim_geography", "dim_counterparty_rich")


@query("A15", _page_sql("executive"), *_PAGE_CTES)
def executive_visuals(v: Views) -> DataFrame:
    return measures.page_visuals(v.marts, "executive")


@query("A15", _page_sql("screening"), *_PAGE_CTES)
def screening_visuals(v: Views) -> DataFrame:
    return measures.page_visuals(v.marts, "screening")


@query("A15", _page_sql("payment"), *_PAGE_CTES)
def payment_visuals(v: Views) -> DataFrame:
    return measures.page_visuals(v.marts, "payment")


@query("A15", _page_sql("investigation"), *_PAGE_CTES)
def investigation_visuals(v: Views) -> DataFrame:
    return measures.page_visuals(v.marts, "investigation")


@query("A15", _page_sql("statistics"), *_PAGE_CTES)
def statistics_visuals(v: Views) -> DataFrame:
    return measures.page_visuals(v.marts, "statistics")


@query("A15", f"SELECT transaction_id, {r6('amount')}, {r6('risk_score')} FROM scored", "scored")
def amount_risk_scatter(v: Views) -> DataFrame:
    return measures.amount_risk_points(v.scored)


@query("A15", f"""
SELECT transaction_id, status, counterparty_name, {r6('p.screening_score', 'screening_score')}, matched_entity,
       {r6('name_similarity_score')}, reason_codes
FROM cases c JOIN dim_counterparty_rich p USING (counterparty_id)
""", "cases", "dim_counterparty_rich")
def screening_detail_table(v: Views) -> DataFrame:
    return measures.screening_details(v.marts)


@query("A15", f"""
SELECT alert_id, transaction_id, {r6('risk_score')}, rules_triggered, status, {r6('age_at_data_cutoff_days')} FROM alerts_mart
""", "alerts_mart")
def case_explorer_table(v: Views) -> DataFrame:
    return measures.case_explorer(v.marts["fact_screening_alerts"])


@query("L1 K2", f"""
SELECT alert_id, status, {r6('risk_score')} FROM cases WHERE status = 'CLOSED' ORDER BY alert_id LIMIT 100 OFFSET 50
""", "cases")
def closed_cases_page(v: Views) -> DataFrame:
    return list_cases(v.cases, limit=100, offset=50, status="CLOSED").select("alert_id", "status", "risk_score")


@query("L2", f"""
SELECT transaction_id, counterparty_name, matched_entity, {r6('screening_score')}, recommendation FROM scored
ORDER BY screening_score DESC, transaction_id LIMIT 100
""", "scored")
def strongest_matches(v: Views) -> DataFrame:
    rows = v.scored.select("transaction_id", "counterparty_name", "matched_entity", "screening_score", "recommendation")
    return rows.orderBy(F.desc("screening_score"), "transaction_id").limit(100)


@query("L4", f"""
SELECT transaction_id, {r6('amount')} FROM payments ORDER BY md5(transaction_id || ':42'), transaction_id LIMIT 5000
""", "payments")
def explorer_sample(v: Views) -> DataFrame:
    return sampling.fixed_sample(v.payments.select("transaction_id", "amount"), "transaction_id", 5000)


@query("L5 U2", """
SELECT transaction_id, injected_pattern FROM (
  SELECT *, row_number() OVER (PARTITION BY injected_pattern ORDER BY md5(transaction_id || ':42'), transaction_id) AS place
  FROM payments) p WHERE place <= 20
""", "payments")
def pattern_sample(v: Views) -> DataFrame:
    rows = v.payments.select("transaction_id", "injected_pattern")
    return sampling.stratified_sample(rows, "injected_pattern", "transaction_id", 20)


@query("J6 L5", """
SELECT customer_id, account_id FROM customers WHERE customer_id IN (SELECT customer_id FROM (
  SELECT *, row_number() OVER (PARTITION BY injected_pattern ORDER BY md5(transaction_id || ':42'), transaction_id) AS place
  FROM payments) p WHERE place <= 20)
""", "customers", "payments")
def customers_of_pattern_sample(v: Views) -> DataFrame:
    rows = v.payments.select("transaction_id", "injected_pattern", "customer_id")
    sample = sampling.stratified_sample(rows, "injected_pattern", "transaction_id", 20)
    return contracts.referenced(v.customers.select("customer_id", "account_id"), sample, "customer_id")


@query("L6", f"""
SELECT payment_channel, round(sum(amount::DECIMAL(18,2))::DOUBLE, 6) AS total FROM payments GROUP BY 1 ORDER BY 2, 1 LIMIT 1
""", "payments")
def smallest_channel(v: Views) -> DataFrame:
    totals = v.payments.groupBy("payment_channel").agg(
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total")
    )
    return sampling.cheapest(totals, "total", "payment_channel")


@query("L7", """
SELECT payment_type, status, count(*) AS n FROM payments GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2
""", "payments")
def payment_kinds_by_size(v: Views) -> DataFrame:
    return v.payments.groupBy("payment_type", "status").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "payment_type", "status"
    )


@query("P11 A1", "SELECT payment_type, sum(alert_flag::INT)::BIGINT AS alerts FROM scored GROUP BY 1", "scored")
def alerts_by_payment_type(v: Views) -> DataFrame:
    return v.scored.groupBy("payment_type").agg(F.sum(flag("alert_flag")).alias("alerts"))


