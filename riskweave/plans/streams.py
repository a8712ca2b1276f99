"""Streaming forms, drained once over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.plans.registry import day, query
from riskweave.plans.views import Views
from riskweave.schemas import TABLES
from riskweave.session import materialise, shared_folder
from riskweave.streaming import cases as case_streams
from riskweave.streaming.payments import daily_totals, drain_to_parquet, read_stream


def scratch(v: Views, name: str) -> str:
    return f"{shared_folder(v.spark)}/{name}-{uuid.uuid4().hex}"


@query("X1 SNK5", f"""
SELECT {day('ts', 'calendar_date')}, count(*) AS transactions, round(sum(round(value * 100, 2)::DECIMAL(18,2))::DOUBLE, 6) AS payment_value_gbp
FROM events GROUP BY ts::DATE, 1
HAVING ts::DATE + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
""")
def streamed_daily_totals(v: Views) -> DataFrame:
    """Closed days of the event stream, every event delivered twice."""
    events = read_stream(v.spark, v.folder, TABLES["events"], "events.parquet")
    payments = events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.round(F.col("value") * 100, 2).alias("amount"),
    )
    twice = payments.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    target = scratch(v, "daily")
    drain_to_parquet(daily_totals(twice), target, scratch(v, "state"))
    return v.spark.read.parquet(target)


@query("X2 K1", "SELECT alert_id, alert_type FROM alerts", "alerts")
def streamed_case_creation(v: Views) -> DataFrame:
    """The alerts arrive twice, in two deliveries; each gets one case."""
    source, root, state = scratch(v, "alerts"), scratch(v, "cases"), scratch(v, "state")
    schema = v.alerts.schema
    for _ in range(2):
        v.alerts.write.mode("append").parquet(source)
        case_streams.seed_cases_from(read_stream(v.spark, source, schema), root, state)
    return case_streams.stored_cases(v.spark, root, schema).select("alert_id", "alert_type")


@query("X3 K3 K4", """
SELECT f.action_id, f.alert_id, f.problem, coalesce(b.status, 'OPEN') AS status_before,
       CASE WHEN f.problem IS NULL THEN a.status ELSE coalesce(b.status, 'OPEN') END AS status_after
FROM fold f JOIN actions a USING (action_id)
LEFT JOIN actions b ON b.action_id = f.previous_action
WHERE f.action_id IS NOT NULL
""", "fold", "actions")
def streamed_review_actions(v: Views) -> DataFrame:
    """First steps arrive in one delivery, the others in a later one."""
    source, target, state = scratch(v, "actions"), scratch(v, "verdicts"), scratch(v, "state")
    actions = v.review_actions
    for part in (actions.where("action_id % 10 = 1"), actions.where("action_id % 10 > 1")):
        part.write.mode("append").parquet(source)
        stream = read_stream(v.spark, source, actions.schema)
        drain_to_parquet(case_streams.fold_actions(stream), target, state)
    return v.spark.read.parquet(target)


@query("X3 K3 K4", """
SELECT f.action_id, f.alert_id, f.problem, coalesce(b.status, 'OPEN') AS status_before,
       CASE WHEN f.problem IS NULL THEN a.status ELSE coalesce(b.status, 'OPEN') END AS status_after
FROM fold f JOIN actions a USING (action_id)
LEFT JOIN actions b ON b.action_id = f.previous_action
WHERE f.action_id IS NOT NULL
""", "fold", "actions")
def streamed_review_actions_any_order(v: Views) -> DataFrame:
    """Last steps arrive first: actions are held until the watermark has passed them, then folded in order."""
    source, target, state = scratch(v, "actions"), scratch(v, "verdicts"), scratch(v, "state")
    actions = materialise(v.review_actions)
    # One action of no alert, much later, lets the watermark pass all others.
    end = F.timestamp_micros(F.unix_micros("acted_at") + 50 * 86_400_000_000)
    tick = actions.orderBy(F.desc("acted_at"), "action_id").limit(1).withColumns({"acted_at": end, "alert_id": F.lit("tick")})
    for part in (actions.where("action_id % 10 > 2"), actions.where("action_id % 10 = 2"), actions.where("action_id % 10 = 1"), tick):
        part.write.mode("append").parquet(source)
        stream = read_stream(v.spark, source, actions.schema)
        drain_to_parquet(case_streams.fold_actions_in_time(stream, "40 days"), target, state)
    return v.spark.read.parquet(target).where("alert_id <> 'tick'")
