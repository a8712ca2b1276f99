from pyspark.sql import functions as F

from riskweave.schemas import REVIEW_ACTIONS
from riskweave.streaming import cases as case_streams
from riskweave.streaming import payments as payment_streams
from tests.test_cases import open_cases

PAYMENT = "transaction_id string, timestamp timestamp, amount double"


def test_copies_are_dropped_and_only_closed_days_come_out(spark, at, tmp_path):
    day = 86_400
    first = [("a", at(10), 5.0), ("a", at(10), 5.0), ("b", at(20), 1.0)]
    later = [("b", at(20), 1.0), ("c", at(day + 5), 2.0), ("d", at(2 * day + 4000), 3.0)]
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows in (first, later):
        frame = spark.createDataFrame(rows, PAYMENT)
        frame.write.mode("append").parquet(source)
        stream = payment_streams.read_stream(spark, source, frame.schema)
        payment_streams.drain_to_parquet(payment_streams.daily_totals(stream), out, state)
    rows = {str(r.calendar_date): (r.transactions, r.payment_value_gbp) for r in spark.read.parquet(out).collect()}
    assert rows == {"2024-01-01": (2, 6.0), "2024-01-02": (1, 2.0)}


def test_replayed_batch_adds_nothing(spark, at, tmp_path):
    alerts = open_cases(spark, at, "AB")
    root = str(tmp_path / "cases")
    spark.createDataFrame([], alerts.schema).write.parquet(f"{root}/batch=-1")
    write = case_streams.case_writer(root, alerts.schema)
    write(alerts, 0)
    write(alerts, 0)
    write(alerts.withColumn("status", F.lit("CLOSED")).union(open_cases(spark, at, "C")), 1)
    rows = case_streams.stored_cases(spark, root, alerts.schema).collect()
    assert sorted((r.alert_id, r.status, r.batch) for r in rows) == [("A", "OPEN", 0), ("B", "OPEN", 0), ("C", "OPEN", 1)]


def test_state_is_kept_and_late_actions_are_refused(spark, at, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    deliveries = [
        [(2, "A", "IN_REVIEW", "ana", "looked", None, None, at(0))],
        [(1, "A", "IN_REVIEW", "ana", "late", None, None, at(0)),
         (3, "A", "CLOSED", "ana", "settled", "CLEARED", "RC", at(0))],
    ]
    for rows in deliveries:
        spark.createDataFrame(rows, REVIEW_ACTIONS).write.mode("append").parquet(source)
        stream = payment_streams.read_stream(spark, source, REVIEW_ACTIONS)
        payment_streams.drain_to_parquet(case_streams.fold_actions(stream), out, state)
    got = {r.action_id: (r.status_before, r.status_after, r.problem) for r in spark.read.parquet(out).collect()}
    assert got == {
        2: ("OPEN", "IN_REVIEW", None), 1: ("IN_REVIEW", "IN_REVIEW", "OUT_OF_ORDER"), 3: ("IN_REVIEW", "CLOSED", None)
    }


TICK = 10**6


def in_time(spark, at, tmp_path, deliveries, delay="1 hour"):
    """Verdicts after each delivery, the stream restarted from its checkpoint every time."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    seen = []
    for rows in deliveries:
        frame = spark.createDataFrame(rows, REVIEW_ACTIONS).coalesce(1)
        frame.write.mode("append").parquet(source)
        stream = payment_streams.read_stream(spark, source, REVIEW_ACTIONS)
        payment_streams.drain_to_parquet(case_streams.fold_actions_in_time(stream, delay), out, state)
        seen.append(sorted((r.action_id, r.status_before, r.status_after, r.problem) for r in spark.read.parquet(out).collect() if r.alert_id != "tick"))
    return seen


def action(at, n, alert, status, seconds, actor="ana", disposition=None, reason=None):
    return (n, alert, status, actor, "notes", disposition, reason, at(seconds))


def test_any_order_within_the_delay_gives_the_batch_verdicts(spark, at, tmp_path):
    """Later steps first, another alert between, a restart after every delivery, nothing told too early."""
    rows = [
        action(at, 1, "A", "IN_REVIEW", 100), action(at, 2, "A", "ESCALATED", 200), action(at, 3, "A", "CLOSED", 300, disposition="CLEARED", reason="RC"),
        action(at, 4, "A", "IN_REVIEW", 400), action(at, 5, "B", "CLOSED", 150, disposition="CLEARED", reason="RC"), action(at, 6, "B", "IN_REVIEW", 250),
        action(at, 7, "B", "ESCALATED", 350, actor=" "), action(at, 8, "B", "ESCALATED", 450),
    ]
    order = [[2, 0, 5], [1, 7], [6, 3, 4]]
    tick = [action(at, TICK, "tick", "IN_REVIEW", 10 * 3600)]
    seen = in_time(spark, at, tmp_path, [*([rows[k] for k in part] for part in order), tick])
    assert seen[:3] == [[], [], []]
    from riskweave.operators import cases

    start = open_cases(spark, at, "AB")
    audit, refused = cases.apply_actions(start, spark.createDataFrame(rows, REVIEW_ACTIONS))
    accepted = {r.action_id: (r.before_state.status, r.after_state.status) for r in audit.collect()}
    problems = {r.action_id: r.problem for r in refused.collect()}
    assert {n: (b, a) for n, b, a, p in seen[3] if p is None} == accepted
    assert {n: p for n, _, _, p in seen[3] if p is not None} == problems
    assert len(seen[3]) == len(rows)


def test_actions_are_told_as_the_watermark_passes(spark, at, tmp_path):
    deliveries = [
        [action(at, 2, "A", "ESCALATED", 7_000), action(at, 1, "A", "IN_REVIEW", 10)],
        [action(at, 3, "A", "CLOSED", 9_000, disposition="CLEARED", reason="RC")],
        [action(at, TICK, "tick", "IN_REVIEW", 100_000)],
    ]
    seen = in_time(spark, at, tmp_path, deliveries)
    assert seen[0] == seen[1] == [(1, "OPEN", "IN_REVIEW", None)]
    assert seen[2] == [(1, "OPEN", "IN_REVIEW", None), (2, "IN_REVIEW", "ESCALATED", None), (3, "ESCALATED", "CLOSED", None)]


def test_calls_follow_shards_not_alerts(spark, at, tmp_path):
    """Alerts of one shard are told apart, with both folds; state has a row a shard, however many alerts."""
    rows = [action(at, 10 * k + step, f"A{k}", status, 100 * k + step) for k in range(300) for step, status in ((1, "IN_REVIEW"), (2, "ESCALATED"))]
    rows += [action(at, 3, "A0", "OPEN", 3), action(at, TICK, "tick", "IN_REVIEW", 10**6)]
    want = {n: ("OPEN", "IN_REVIEW", None) if n % 10 == 1 else ("IN_REVIEW", "ESCALATED", None) for n, *_ in rows[:-2]}
    want[3] = ("ESCALATED", "ESCALATED", "INVALID_TRANSITION")
    spark.createDataFrame(rows, REVIEW_ACTIONS).write.parquet(str(tmp_path / "in"))
    for name, fold in (
        ("plain", lambda s: case_streams.fold_actions(s, shards=3)), ("timed", lambda s: case_streams.fold_actions_in_time(s, "1 hour", shards=3))
    ):
        stream = payment_streams.read_stream(spark, str(tmp_path / "in"), REVIEW_ACTIONS)
        out, state = str(tmp_path / name), str(tmp_path / f"{name}-state")
        payment_streams.drain_to_parquet(fold(stream), out, state)
        got = {r.action_id: (r.status_before, r.status_after, r.problem) for r in spark.read.parquet(out).collect() if r.alert_id != "tick"}
        assert got == want
        assert spark.read.format("statestore").load(state).count() <= 3
