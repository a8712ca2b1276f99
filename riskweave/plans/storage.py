"""Sinks read back through the sources: each query writes below the shared folder first."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.config import Controls, controls_from_dict
from riskweave.operators import aggregates, rules, warehouse
from riskweave.plans.registry import query, r6, us
from riskweave.plans.views import CONTROLS, Views
from riskweave.schemas import PAYMENTS, WATCHLIST
from riskweave.session import shared_folder
from riskweave.sources import files, sinks


def _target(v: Views, name: str) -> str:
    return f"{shared_folder(v.spark)}/{name}-{uuid.uuid4().hex}"


@query("SRC2 SNK2", """
SELECT entity_id, canonical_name, aliases, country, entity_type, 'SYNTHETIC' AS sanctions_program,
       'SYNTHETIC-LIST' AS source, active FROM watchlist
""", "watchlist")
def watchlist_from_csv(v: Views) -> DataFrame:
    path = _target(v, "watchlist")
    sinks.write_csv(v.watchlist, path)
    return files.read_csv_blank(v.spark, path, WATCHLIST)


_PAYMENTS = f"SELECT transaction_id, customer_id, {us('timestamp')}, {r6('amount')}, status FROM payments"


@query("SNK2", _PAYMENTS, "payments")
def payments_from_csv(v: Views) -> DataFrame:
    path = _target(v, "payments")
    sinks.write_csv(v.payments, path)
    return files.read_csv_blank(v.spark, path, PAYMENTS).select(
        "transaction_id", "customer_id", "timestamp", "amount", "status"
    )


@query("SNK1 SRC1", _PAYMENTS, "payments")
def payments_from_parquet(v: Views) -> DataFrame:
    path = _target(v, "payments")
    sinks.write_parquet(v.payments, path)
    return files.read_parquet(v.spark, path, PAYMENTS).select(
        "transaction_id", "customer_id", "timestamp", "amount", "status"
    )


@query("SNK3", f"""
SELECT count(*) AS transactions_screened, sum(alert_flag::INT)::BIGINT AS alerts, {r6('avg(alert_flag::INT)', 'alert_rate')},
       {r6('avg(risk_score)', 'average_risk_score')}, sum((alert_flag AND risk_score >= 70)::INT)::BIGINT AS high_risk_alerts
FROM scored
""", "scored")
def summary_from_json(v: Views) -> DataFrame:
    path = _target(v, "summary")
    summary = aggregates.operations_summary(v.scored)
    sinks.write_metrics(summary, path)
    return v.spark.read.schema(summary.schema).json(path)


@query("SNK4 C7 C6", """
SELECT 'dim_customer' AS "table", count(*) AS rows FROM customers UNION ALL SELECT 'dim_counterparty', count(*) FROM counterparties
UNION ALL SELECT 'dim_date', count(*) FROM dim_date UNION ALL SELECT 'dim_geography', count(*) FROM dim_geography
UNION ALL SELECT 'dim_payment_channel', count(*) FROM dim_payment_channel UNION ALL SELECT 'dim_risk_category', 3
UNION ALL SELECT 'fact_transactions', count(*) FROM fact UNION ALL SELECT 'fact_screening_alerts', count(*) FROM alerts
""", "customers", "counterparties", "dim_date", "dim_geography", "dim_payment_channel", "fact", "alerts")
def published_warehouse(v: Views) -> DataFrame:
    root = _target(v, "warehouse")
    warehouse.publish(v.star, root, v.payments)
    counts = [
        warehouse.read_published(v.spark, root, name)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table"), "rows")
        for name in v.star
    ]
    return reduce(DataFrame.unionByName, counts)


@query("SRC3 R6 R1", """
SELECT transaction_id, risk_score::BIGINT AS risk_score, rule_reasons, rule_review FROM ruled
""", "ruled")
def rules_from_document(v: Views) -> DataFrame:
    """Rules applied from their JSON document instead of from code."""
    document = json.loads(json.dumps(asdict(v.controls)))
    ruled = rules.apply_rules(v.featured, controls_from_dict(document))
    return ruled.select("transaction_id", "risk_score", "rule_reasons", "rule_review")


#: Thresholds and scores in the written document that differ from the defaults.
_CHANGED = {"R01": (2, 35), "R04": (1, 15), "R06": (60, 45)}


def _changed(controls: Controls) -> Controls:
    rules_ = tuple(
        replace(r, threshold=_CHANGED[r.rule_id][0], score=_CHANGED[r.rule_id][1]) if r.rule_id in _CHANGED else r
        for r in controls.rules
    )
    return controls.with_(rules=rules_)


@query("SRC3 R5 R1", " UNION ALL ".join(
    f"SELECT '{r.rule_name}' AS rule_name, count(*) AS payments, (count(*) * {r.score})::BIGINT AS score FROM featured"
    f" WHERE {r.feature} >= {r.threshold} HAVING count(*) > 0" for r in _changed(CONTROLS).rules
), "featured")
def rules_from_file(v: Views) -> DataFrame:
    """Controls read from a JSON file with thresholds of its own, and its rule list joined by name to where they fired."""
    path = _target(v, "controls")
    text = json.dumps(asdict(_changed(v.controls)))
    v.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    document = json.loads(v.spark.read.text(path, wholetext=True).first()[0])
    listed = files.read_rules(v.spark, path).select("rule_name", "score")
    ruled = rules.apply_rules(v.featured, controls_from_dict(document))
    fired = ruled.where("rule_reasons <> ''").select(F.explode(F.split("rule_reasons", r"\|")).alias("rule_name"))
    return fired.join(listed, "rule_name").groupBy("rule_name").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("score").cast("bigint").alias("score")
    )
