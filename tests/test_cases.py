import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import cases
from riskweave.schemas import REVIEW_ACTIONS
from riskweave.sources import case_table

CASE = (
    "alert_id string, transaction_id string, created_at timestamp, status string, investigator_notes string,"
    " disposition string, reason_code string, reviewed_at timestamp"
)


def open_cases(spark, at, ids):
    return spark.createDataFrame([(i, f"T{i}", at(0), "OPEN", "", None, None, None) for i in ids], CASE)


def actions(spark, at, rows):
    return spark.createDataFrame(
        [(n, alert, status, actor, notes, d, r, at(60 * n)) for n, alert, status, actor, notes, d, r in rows],
        REVIEW_ACTIONS,
    )


LIFE = [
    (1, "A", "CLOSED", "ana", "too early", "CLEARED", "RC"),
    (2, "A", "IN_REVIEW", "ana", "looked", None, None),
    (3, "A", "CLOSED", "ana", "no disposition", None, "RC"),
    (4, "A", "ESCALATED", "ana", "odd", "CLEARED", None),
    (5, "A", "CLOSED", "ana", "settled", "FALSE_POSITIVE", "RC"),
    (6, "A", "IN_REVIEW", "ana", "again", None, None),
    (7, "Z", "IN_REVIEW", "ana", "no such alert", None, None),
    (8, "B", "IN_REVIEW", "  ", "no actor", None, None),
    (9, "B", "PAUSED", "bo", "no such status", None, None),
]


def test_lifecycle(spark, at):
    start = open_cases(spark, at, "AB")
    audit, refused = cases.apply_actions(start, actions(spark, at, LIFE))
    assert {r.action_id: r.problem for r in refused.collect()} == {
        1: "INVALID_TRANSITION", 3: "CLOSE_NEEDS_DISPOSITION_AND_REASON", 4: "DISPOSITION_ONLY_ON_CLOSE",
        6: "INVALID_TRANSITION", 7: "UNKNOWN_ALERT", 8: "ACTOR_AND_NOTES_REQUIRED", 9: "INVALID_TRANSITION",
    }
    rows = audit.orderBy("action_id").collect()
    assert [(r.action_id, r.before_state.status, r.after_state.status) for r in rows] == [
        (2, "OPEN", "IN_REVIEW"), (5, "IN_REVIEW", "CLOSED")
    ]
    assert rows[1].before_state.investigator_notes == "looked"
    state = {r.alert_id: r for r in cases.case_snapshot(start, audit).collect()}
    assert (state["A"].status, state["A"].disposition, state["A"].reason_code) == ("CLOSED", "FALSE_POSITIVE", "RC")
    assert state["A"].reviewed_at is not None
    assert state["B"].status == "OPEN" and state["B"].reviewed_at is None


def simulate(rows, ids):
    """One action after the other, in action order."""
    status, verdicts = dict.fromkeys(ids, "OPEN"), {}
    for n, alert, target, actor, notes, disposition, reason in sorted(rows):
        ok = actor.strip() and notes.strip() and alert in status and target in cases.TRANSITIONS[status[alert]]
        if ok and target == "CLOSED":
            ok = disposition in cases.DISPOSITIONS and reason
        elif ok:
            ok = disposition is None
        verdicts[n] = bool(ok)
        if ok:
            status[alert] = target
    return status, verdicts


@pytest.mark.parametrize("run_rows", [1_000_000, 40, 3])
def test_random_actions_equal_a_plain_loop(spark, at, run_rows):
    rng, ids = random.Random(6), ["A", "B", "C", "D"]
    rows = [
        (n, rng.choice(["A", "A", "A", "B", "C", "D"]), rng.choice(["IN_REVIEW", "IN_REVIEW", "ESCALATED", "CLOSED"]),
         rng.choice(["ana", "bo", ""]), "notes", rng.choice([None, None, "CLEARED"]), rng.choice([None, "RC"]))
        for n in rng.sample(range(10_000), 600)
    ]
    # keep the busy alert from closing early, so that long chains occur
    rows = [r for r in rows if not (r[1] == "A" and r[2] == "CLOSED")]
    start = open_cases(spark, at, ids)
    audit, refused = cases.apply_actions(start, actions(spark, at, rows), run_rows)
    status, verdicts = simulate(rows, ids)
    accepted = {r.action_id for r in audit.select("action_id").collect()}
    assert accepted == {n for n, ok in verdicts.items() if ok}
    assert refused.count() == len(rows) - len(accepted)
    snapshot = {r.alert_id: r.status for r in cases.case_snapshot(start, audit).collect()}
    assert snapshot == status
    # each change starts where the one before it ended
    last = dict.fromkeys(ids, "OPEN")
    for r in audit.orderBy("action_id").collect():
        assert r.before_state.status == last[r.alert_id]
        last[r.alert_id] = r.after_state.status


def test_seeding_twice_changes_nothing(spark, at):
    alerts = open_cases(spark, at, "ABC")
    some, first_audit = cases.seed_cases(alerts.where("alert_id = 'A'"), open_cases(spark, at, "").limit(0))
    reviewed = some.withColumn("status", F.lit("CLOSED"))
    everything, audit = cases.seed_cases(alerts, reviewed)
    assert first_audit.count() == 1
    assert sorted(r.alert_id for r in audit.collect()) == ["B", "C"]
    assert {r.alert_id: r.status for r in everything.collect()} == {"A": "CLOSED", "B": "OPEN", "C": "OPEN"}
    again, nothing = cases.seed_cases(alerts, everything)
    assert nothing.isEmpty() and again.count() == 3


def test_get_and_list(spark, at):
    frame = open_cases(spark, at, "DBAC").withColumn(
        "status", F.when(F.col("alert_id") == "C", "CLOSED").otherwise(F.col("status"))
    )
    found, missing = cases.get_cases(frame, spark.createDataFrame([("A",), ("X",)], "alert_id string"))
    assert [r.alert_id for r in found.collect()] == ["A"]
    assert [r.alert_id for r in missing.collect()] == ["X"]
    assert [r.alert_id for r in cases.list_cases(frame, 2, 1).collect()] == ["B", "C"]
    assert [r.alert_id for r in cases.list_cases(frame, status="OPEN").collect()] == ["A", "B", "D"]


@pytest.mark.parametrize("blank", ["\t", "\n \r", "\u00a0", None])
def test_any_white_space_is_blank(spark, at, blank):
    rows = [(1, "A", "IN_REVIEW", blank, "notes", None, None), (2, "A", "IN_REVIEW", "ana", blank, None, None)]
    _, refused = cases.apply_actions(open_cases(spark, at, "A"), actions(spark, at, rows))
    assert {r.problem for r in refused.collect()} == {"ACTOR_AND_NOTES_REQUIRED"}


def test_repeated_action_ids_are_refused(spark, at):
    rows = [(1, "A", "IN_REVIEW", "ana", "n", None, None), (1, "B", "IN_REVIEW", "ana", "n", None, None),
            (2, "B", "IN_REVIEW", "ana", "n", None, None)]
    audit, refused = cases.apply_actions(open_cases(spark, at, "AB"), actions(spark, at, rows))
    assert [r.action_id for r in audit.collect()] == [2]
    assert [(r.action_id, r.problem) for r in refused.collect()] == [(1, "REPEATED_ACTION_ID")] * 2


def test_case_table_survives_breaks_and_repeats(spark, at, tmp_path, monkeypatch):
    folder, alerts = str(tmp_path / "cases"), open_cases(spark, at, "ABC")
    real = case_table.materialise

    def broken(frame):
        raise RuntimeError("lost")

    monkeypatch.setattr(case_table, "materialise", broken)
    with pytest.raises(RuntimeError):
        case_table.seed(alerts, folder)
    monkeypatch.setattr(case_table, "materialise", real)
    case_table.seed(alerts.where("alert_id = 'A'"), folder)
    case_table.seed(alerts, folder)
    case_table.seed(alerts, folder)
    delivery = actions(spark, at, LIFE)
    first = case_table.review(alerts, folder, delivery)
    assert first.count() == 7
    again = case_table.review(alerts, folder, delivery)
    assert {r.action_id for r in again.collect()} == {1, 3, 4, 6, 7, 8, 9}
    audit = case_table.audit(alerts, folder)
    assert audit.where("action = 'CREATE'").count() == 3
    assert sorted(r.action_id for r in audit.where("action_id is not null").collect()) == [2, 5]
    assert {r.alert_id: r.status for r in case_table.current(alerts, folder).collect()} == {
        "A": "CLOSED", "B": "OPEN", "C": "OPEN"
    }
