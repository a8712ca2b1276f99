"""Case creation, review actions, audit and snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.config import Controls, run_key
from riskweave.operators import cases
from riskweave.plans.registry import query, r6, us
from riskweave.plans.views import Views
from riskweave.session import materialise, shared_folder
from riskweave.sources import case_table


@query("K1 J9", f"SELECT alert_id, alert_type, {us('created_at')} FROM alerts WHERE alert_type <> 'SCREENING'", "alerts")
def new_alerts_only(v: Views) -> DataFrame:
    """Screening alerts already have cases; only the others are new."""
    existing = v.alerts.where("alert_type = 'SCREENING'")
    return cases.new_cases(v.alerts, existing).select("alert_id", "alert_type", "created_at")


@query("K1 K5", f"""
SELECT alert_id, 'pipeline' AS actor, 'CREATE' AS action, {us('created_at', 'timestamp')}, 'OPEN' AS status_after
FROM alerts WHERE alert_type <> 'SCREENING'
""", "alerts")
def creation_audit(v: Views) -> DataFrame:
    existing = v.alerts.where("alert_type = 'SCREENING'")
    _, audit = cases.seed_cases(v.alerts, existing)
    return audit.select("alert_id", "actor", "action", "timestamp", F.col("after_state.status").alias("status_after"))


@query("K1", "SELECT status, count(*) AS n FROM cases GROUP BY 1", "cases")
def reseeded_cases_keep_state(v: Views) -> DataFrame:
    """Seeding again after the review leaves every reviewed case as it is."""
    seeded, _ = cases.seed_cases(v.alerts, v.kept_cases)
    return seeded.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("K2", f"SELECT alert_id, {r6('risk_score')}, rules_triggered FROM alerts WHERE alert_type = 'SCREENING'", "alerts")
def requested_cases(v: Views) -> DataFrame:
    wanted = v.scored.where("recommendation = 'REVIEW'").select(
        F.concat(F.lit("ALERT-"), "transaction_id").alias("alert_id")
    )
    found, _ = cases.get_cases(v.alerts, wanted)
    return found.select("alert_id", "risk_score", "rules_triggered")


_AUDIT = f"""
SELECT f.action_id, f.alert_id, a.actor, 'HUMAN_REVIEW' AS action, {us('a.acted_at', 'timestamp')},
       coalesce(b.status, 'OPEN') AS status_before, a.status AS status_after,
       coalesce(b.notes, '') AS notes_before, a.notes AS notes_after,
       b.disposition AS disposition_before, a.disposition AS disposition_after
FROM fold f JOIN actions a USING (action_id) LEFT JOIN actions b ON b.action_id = f.previous_action
WHERE f.problem IS NULL AND f.action_id IS NOT NULL
"""


def _flat_audit(audit: DataFrame) -> DataFrame:
    return audit.select(
        "action_id", "alert_id", "actor", "action", "timestamp",
        F.col("before_state.status").alias("status_before"), F.col("after_state.status").alias("status_after"),
        F.col("before_state.investigator_notes").alias("notes_before"),
        F.col("after_state.investigator_notes").alias("notes_after"),
        F.col("before_state.disposition").alias("disposition_before"),
        F.col("after_state.disposition").alias("disposition_after"),
    )


@query("K3 K5", _AUDIT, "fold", "actions")
def review_audit(v: Views) -> DataFrame:
    return _flat_audit(v.reviewed[0])


@query("K3 K5", _AUDIT, "fold", "actions")
def review_audit_in_runs(v: Views) -> DataFrame:
    """The same audit when the actions are folded in many short runs."""
    audit, _ = cases.apply_actions(v.alerts, v.review_actions, run_rows=500)
    return _flat_audit(audit)


@query("K4", """
SELECT action_id, alert_id, problem FROM fold WHERE problem IS NOT NULL
""", "fold")
def refused_actions(v: Views) -> DataFrame:
    return v.reviewed[1].select("action_id", "alert_id", "problem")


@query("K7", f"SELECT alert_id, status, investigator_notes, disposition, reason_code, {us('reviewed_at')} FROM cases", "cases")
def case_snapshot(v: Views) -> DataFrame:
    return v.cases.select("alert_id", "status", "investigator_notes", "disposition", "reason_code", "reviewed_at")


# Two run configurations: the default one and one with another threshold.
_KEYS = tuple(run_key(0, 42, c) for c in (Controls(), Controls(risk_threshold=60)))


@query("K6", f"""
SELECT '{_KEYS[0]}' AS run_key, status, count(*) AS n FROM cases GROUP BY 2
UNION ALL SELECT '{_KEYS[1]}', 'OPEN', count(*) FROM alerts
""", "cases", "alerts")
def cases_by_run_key(v: Views) -> DataFrame:
    """Two runs' case tables, of which only one was reviewed: each key's folder holds its own state."""
    root = f"{shared_folder(v.spark)}/cases-{uuid.uuid4().hex}"
    found, parts = materialise(v.alerts), []
    for key in _KEYS:
        case_table.seed(found, f"{root}/run_key={key}")
    case_table.review(found, f"{root}/run_key={_KEYS[0]}", v.review_actions)
    for key in _KEYS:
        parts.append(case_table.current(found, f"{root}/run_key={key}").select(F.lit(key).alias("run_key"), "status"))
    return parts[0].unionByName(parts[1]).groupBy("run_key", "status").agg(F.count(F.lit(1)).alias("n"))


@query("K6", "SELECT status, count(*) AS n FROM cases GROUP BY 1", "cases")
def cases_of_run_key(v: Views) -> DataFrame:
    """Cases carry their run key; one configuration's state is one key's rows."""
    key = run_key(0, 42, v.controls)
    keyed = v.cases.withColumn("run_key", F.lit(key))
    return keyed.where(F.col("run_key") == key).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
