"""Scans, projections, filters, joins and contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import bands
from riskweave.operators import aggregates, contracts, features, marts, ranking, warehouse
from riskweave.plans.registry import day, query, r6, us
from riskweave.plans.sql_views import amount_band
from riskweave.plans.views import Views
from riskweave.sources.adapters import RISK_COUNTRIES
from riskweave.sources.files import run_sql
from riskweave.sources.sinks import run_manifest, table_manifest

PAYMENT_TEXT = (
    "origin_country, destination_country, payment_channel, payment_type, payment_category,"
    " device_id, originating_bank, network, beneficiary_bank, status, injected_pattern"
)


@query("SRC1 P1", f"SELECT event_id, user_id, event_type, {r6('value')} FROM events")
def parquet_scan(v: Views) -> DataFrame:
    return v.table("events").select("event_id", "user_id", "event_type", "value")


@query("SRC1", f"""
SELECT transaction_id, customer_id, counterparty_id, {us('timestamp')}, {r6('amount')}, currency,
       {PAYMENT_TEXT}, investigation_label::BIGINT AS investigation_label FROM all_payments
""", "all_payments")
def payments_view(v: Views) -> DataFrame:
    return v.all_payments


@query("SRC1", f"""
SELECT customer_id, account_id, account_age_days::BIGINT AS account_age_days, customer_type, residence_country,
       industry, risk_segment, kyc_status, pep_flag, expected_monthly_volume::BIGINT AS expected_monthly_volume,
       {r6('expected_amount')}, {r6('expected_min')}, {r6('expected_max')} FROM customers
""", "customers")
def customers_view(v: Views) -> DataFrame:
    return v.customers


@query("SRC1", "SELECT * FROM counterparties", "counterparties")
def counterparties_view(v: Views) -> DataFrame:
    return v.counterparties


@query("SRC4 J5", f"""
SELECT {day('timestamp', 'calendar_date')}, count(*) AS transactions, sum(alert_flag::INT)::BIGINT AS alerts,
       round(sum(amount::DECIMAL(18,2))::DOUBLE, 6) AS payment_value_gbp, {r6('avg(risk_score)', 'average_risk_score')}
FROM scored GROUP BY 1
""", "scored")
def sql_text_over_star(v: Views) -> DataFrame:
    tables = {
        "fact_transactions": warehouse.fact_transactions(
            v.scored, warehouse.dim_geography(v.payments, RISK_COUNTRIES),
            warehouse.dim_payment_channel(v.payments),
        ),
        "dim_date": warehouse.dim_date(v.payments),
    }
    return run_sql(v.spark, warehouse.DAILY_SQL, tables)


@query("SNK5", f"SELECT count(*) AS rows, {us('max(timestamp)', 'watermark')} FROM payments", "payments")
def run_manifest_counts(v: Views) -> DataFrame:
    return run_manifest(v.payments, v.controls, seed=42).select("rows", "watermark")


@query("SNK5")
def run_manifest_full(v: Views) -> DataFrame:
    return run_manifest(v.payments, v.controls, seed=42)


@query("SNK6", """
SELECT 'customers' AS "table", count(*) AS rows, 13::BIGINT AS columns FROM customers
UNION ALL SELECT 'counterparties', count(*), 7 FROM counterparties
UNION ALL SELECT 'payments', count(*), 18 FROM payments
""", "customers", "counterparties", "payments")
def table_manifest_counts(v: Views) -> DataFrame:
    return table_manifest(
        {"customers": v.customers, "counterparties": v.counterparties, "payments": v.payments}
    ).drop("digest")


@query("P2 P5 P6 P13", f"""
SELECT transaction_id, {r6('amount')}, {day('timestamp', 'payment_date')}, {r6('ln(1 + amount)', 'amount_log')}
FROM payments
""", "payments")
def prepared_payments(v: Views) -> DataFrame:
    doubled = v.all_payments.unionByName(v.all_payments)
    return features.prepare_payments(doubled).select("transaction_id", "amount", "payment_date", "amount_log")


@query("P13", f"""
SELECT customer_id, transaction_id, {us('timestamp')}, {r6('amount')}
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY timestamp, transaction_id) AS place FROM payments) p
WHERE place = 1
""", "payments")
def first_payment_per_customer(v: Views) -> DataFrame:
    rows = v.payments.select("customer_id", "timestamp", "transaction_id", "amount")
    return features.first_version(rows, "customer_id", "timestamp")


@query("P3", """
SELECT payment_channel, count(*) AS n FROM payments WHERE payment_channel IN ('purchase', 'error') GROUP BY 1
""", "payments")
def chosen_channels(v: Views) -> DataFrame:
    return aggregates.value_counts(aggregates.in_channels(v.payments, ["purchase", "error"]), "payment_channel")


@query("P4", f"SELECT transaction_id, risk_score::BIGINT AS risk_score, {r6('model_probability')} FROM scored WHERE alert_flag",
       "scored")
def alerted_payments(v: Views) -> DataFrame:
    return v.scored.where("alert_flag").select("transaction_id", "risk_score", "model_probability")


@query("P7", "SELECT match_method, count(*) AS n FROM dim_counterparty_rich GROUP BY 1", "dim_counterparty_rich")
def match_methods(v: Views) -> DataFrame:
    method = bands.match_method("alias_match", "name_similarity_score").alias("match_method")
    return v.screened.groupBy(method).agg(F.count(F.lit(1)).alias("n"))


@query("P8 P9 P10 P11", f"""
SELECT transaction_id, {amount_band('amount')} AS amount_band,
       CASE WHEN risk_score <= 39 THEN 1 WHEN risk_score <= 69 THEN 2 ELSE 3 END::BIGINT AS risk_key,
       least(floor(screening_score / 10) * 10, 90)::BIGINT AS screening_score_band,
       alert_flag::BIGINT AS alert_flag
FROM scored
""", "scored")
def payment_bands(v: Views) -> DataFrame:
    return v.scored.select(
        "transaction_id",
        bands.amount_band("amount").alias("amount_band"),
        bands.risk_key("risk_score").alias("risk_key"),
        bands.score_band("screening_score").alias("screening_score_band"),
        bands.flag("alert_flag").alias("alert_flag"),
    )


@query("P12", """
SELECT coalesce(disposition, 'NOT_REVIEWED') AS disposition, coalesce(reason_code, '') AS reason_code, count(*) AS n
FROM cases GROUP BY 1, 2
""", "cases")
def dispositions_filled(v: Views) -> DataFrame:
    return v.cases.groupBy(
        F.coalesce("disposition", F.lit("NOT_REVIEWED")).alias("disposition"),
        F.coalesce("reason_code", F.lit("")).alias("reason_code"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("P14", f"""
SELECT alert_id, {r6('(epoch_us((SELECT max(timestamp) FROM payments)) - epoch_us(created_at)) / 86400000000.0::DOUBLE', 'age_at_data_cutoff_days')}
FROM alerts
""", "alerts")
def case_age(v: Views) -> DataFrame:
    return marts.with_age(v.alerts, v.payments).select("alert_id", "age_at_data_cutoff_days")


@query("P15", f"""
SELECT {day('timestamp', 'payment_day')},
       CASE WHEN risk_score >= 70 THEN 'HIGH' WHEN risk_score >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band,
       high_risk_geo = 1 AS risk_geography, count(*) AS payments, sum(alert_flag::INT)::BIGINT AS alerts,
       sum((alert_flag AND investigation_label = 0)::INT)::BIGINT AS benchmark_false_positives,
       sum((investigation_label = 0)::INT)::BIGINT AS benchmark_negatives,
       round(sum(alert_flag::INT) / count(*)::DOUBLE, 6) AS alert_rate,
       round(sum((alert_flag AND investigation_label = 0)::INT)::DOUBLE / nullif(sum((investigation_label = 0)::INT), 0), 6) AS benchmark_fpr,
       round(sum((alert_flag AND investigation_label = 0)::INT)::DOUBLE / nullif(sum(alert_flag::INT), 0), 6) AS review_fp_share
FROM scored GROUP BY 1, 2, 3
""", "scored")
def explorer_calculations(v: Views) -> DataFrame:
    return aggregates.explorer_rates(v.scored)


@query("P16", f"""
SELECT transaction_id, {r6('amount')} FROM payments
WHERE amount >= 0 AND amount <= (SELECT quantile_cont(amount, 0.99) FROM payments)
""", "payments")
def amounts_below_p99(v: Views) -> DataFrame:
    return ranking.clip_at_percentile(v.payments.select("transaction_id", "amount"), "amount", 0.99)


@query("J1", f"""
SELECT transaction_id, account_id, counterparty_name, {r6('expected_amount')}, recommendation
FROM payments JOIN customers USING (customer_id) JOIN counterparties USING (counterparty_id)
JOIN screened USING (counterparty_id)
""", "payments", "customers", "counterparties", "screened")
def payments_with_dimensions(v: Views) -> DataFrame:
    return (
        v.payments.select("transaction_id", "customer_id", "counterparty_id")
        .join(v.customers.select("customer_id", "account_id", "expected_amount"), "customer_id")
        .join(v.counterparties.select("counterparty_id", "counterparty_name"), "counterparty_id")
        .join(v.screened.select("counterparty_id", "recommendation"), "counterparty_id")
        .drop("customer_id", "counterparty_id")
    )


@query("J2", f"""
SELECT transaction_id, risk_segment, {r6('amount')} FROM payments JOIN customers USING (customer_id)
""", "payments", "customers")
def many_to_one_join(v: Views) -> DataFrame:
    left = v.payments.select("transaction_id", "customer_id", "amount")
    right = v.customers.select("customer_id", "risk_segment")
    return contracts.join_many_to_one(left, right, "customer_id").drop("customer_id")


@query("J3 J4", """
SELECT transaction_id, o.geography_key AS origin_geography_key, d.geography_key AS destination_geography_key, channel_key
FROM payments JOIN dim_geography o ON o.country_code = origin_country
JOIN dim_geography d ON d.country_code = destination_country JOIN dim_payment_channel USING (payment_channel)
""", "payments", "dim_geography", "dim_payment_channel")
def surrogate_key_lookup(v: Views) -> DataFrame:
    geography = warehouse.dim_geography(v.payments, RISK_COUNTRIES)
    channel = warehouse.dim_payment_channel(v.payments)
    return warehouse.lookup_keys(v.payments, geography, channel).select(
        "transaction_id", "origin_geography_key", "destination_geography_key", "channel_key"
    )


@query("J6", "SELECT customer_id, account_id FROM customers WHERE customer_id IN (SELECT customer_id FROM payments)",
       "customers", "payments")
def referenced_customers(v: Views) -> DataFrame:
    return contracts.referenced(v.customers.select("customer_id", "account_id"), v.payments, "customer_id")


@query("J7 C2", "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphan_documents(v: Views) -> DataFrame:
    return contracts.orphans(v.table("documents").select("doc_id", "lang", "source"), v.table("labels"), "doc_id")


@query("J10", """
SELECT counterparty_id, synthetic_sanctions_flag::BIGINT AS truth, (recommendation = 'REVIEW')::BIGINT AS review
FROM screened JOIN counterparties USING (counterparty_id)
""", "screened", "counterparties")
def screening_truth(v: Views) -> DataFrame:
    truth = v.counterparties.select("counterparty_id", bands.flag("synthetic_sanctions_flag").alias("truth"))
    return v.screened.select(
        "counterparty_id", bands.flag(F.col("recommendation") == "REVIEW").alias("review")
    ).join(truth, "counterparty_id")


@query("J11", """
SELECT 'TX-' || lpad(event_id::VARCHAR, 9, '0') AS transaction_id, 'MISSING_IN_DERIVED' AS problem
FROM all_payments WHERE amount < 100
""", "all_payments")
def parity_of_derived_payments(v: Views) -> DataFrame:
    """Payments below 100 are left out of the derived side, so they must be reported."""
    derived = features.prepare_payments(v.all_payments).where("amount >= 100")
    return contracts.parity(v.all_payments, derived)


@query("U1", """
SELECT origin_country AS country FROM payments UNION SELECT destination_country FROM payments
""", "payments")
def all_countries(v: Views) -> DataFrame:
    p = v.payments
    return p.select(F.col("origin_country").alias("country")).distinct().union(
        p.select("destination_country").distinct()
    ).distinct()


@query("U2", """
SELECT payment_channel, count(*) AS n
FROM (SELECT * FROM payments UNION ALL SELECT * FROM all_payments) u GROUP BY 1
""", "payments", "all_payments")
def union_of_payments(v: Views) -> DataFrame:
    return aggregates.value_counts(v.payments.unionByName(v.all_payments), "payment_channel")


@query("U3", """
SELECT coalesce(c.customer_id, p.customer_id) AS customer_id, CASE WHEN c.customer_id IS NULL THEN 'right' ELSE 'left' END AS only_in
FROM (SELECT DISTINCT customer_id FROM customers) c FULL JOIN (SELECT DISTINCT customer_id FROM payments) p USING (customer_id)
WHERE c.customer_id IS NULL OR p.customer_id IS NULL
""", "customers", "payments")
def customers_without_payments(v: Views) -> DataFrame:
    return contracts.set_difference(v.customers, v.payments, "customer_id")


@query("C1", """
SELECT 'user_id' AS key, sum(CASE WHEN user_id IS NULL THEN n ELSE 0 END)::BIGINT AS null_keys,
       sum((user_id IS NOT NULL AND n > 1)::INT)::BIGINT AS duplicate_keys
FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) g
UNION ALL
SELECT 'event_id', sum(CASE WHEN event_id IS NULL THEN n ELSE 0 END)::BIGINT, sum((n > 1)::INT)::BIGINT
FROM (SELECT event_id, count(*) AS n FROM events GROUP BY 1) g
""")
def key_contract(v: Views) -> DataFrame:
    events = v.table("events")
    parts = [
        contracts.key_problems(events, key).select(F.lit(key).alias("key"), "null_keys", "duplicate_keys")
        for key in ("user_id", "event_id")
    ]
    return parts[0].unionByName(parts[1])


@query("C3 C4", """
SELECT sum((amount IS NULL OR NOT amount > 0)::INT)::BIGINT AS bad_amounts,
       sum((timestamp IS NULL)::INT)::BIGINT AS missing_times, sum((currency <> 'GBP')::INT)::BIGINT AS other_currencies
FROM all_payments
""", "all_payments")
def value_contract(v: Views) -> DataFrame:
    return contracts.value_problems(v.all_payments)


@query("C5", """
SELECT count(*) AS records, round(sum(amount::DECIMAL(18,2))::DOUBLE, 6) AS amount_total,
       0::BIGINT AS orphan_keys, 0::BIGINT AS duplicate_keys
FROM payments
""", "payments")
def validated_quality_summary(v: Views) -> DataFrame:
    return contracts.validate(v.customers, v.counterparties, v.payments)


@query("A12", """
SELECT a.n AS left_rows, round(a.t, 6) AS left_total, b.n AS right_rows, round(b.t, 6) AS right_total,
       a.n <> b.n OR abs(a.t - b.t) > 0.01 AS differ
FROM (SELECT count(*) AS n, sum(amount::DECIMAL(18,2))::DOUBLE AS t FROM payments) a,
     (SELECT count(*) AS n, sum(amount::DECIMAL(18,2))::DOUBLE AS t FROM payments WHERE status <> 'FAILED') b
""", "payments")
def reconciliation_totals(v: Views) -> DataFrame:
    return contracts.totals_differ(v.payments, v.payments.where("status <> 'FAILED'"))
