import random
import re

import pytest
from pyspark.sql import functions as F

from riskweave.config import Controls
from riskweave.operators import features

PAYMENT = "transaction_id string, customer_id bigint, counterparty_id bigint, timestamp timestamp, amount double"


def payments(spark, at, rows):
    return spark.createDataFrame([(t, c, p, at(s), a) for t, c, p, s, a in rows], PAYMENT)


def brute_force(rows, velocity=3600, adjacent=86400):
    out, seen = {}, set()
    for t, c, p, s, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        sec = int(s // 1)
        mine = [(int(x[3] // 1), x[4]) for x in rows if x[1] == c]
        out[t] = (
            sum(sec - velocity <= o < sec for o, _ in mine),
            sum(sec - adjacent <= o < sec and 9500 <= a < 10000 for o, a in mine),
            int((c, p) not in seen),
        )
        seen.add((c, p))
    return out


def got(frame):
    return {
        r.transaction_id: (r.velocity_1h, r.adjacent_prior_24h, r.new_counterparty) for r in frame.collect()
    }


def random_rows(seed, n=300):
    rng = random.Random(seed)
    # One customer holds a third of all payments; seconds and sub-seconds collide.
    return [
        (f"T{rng.randrange(10**6):06d}-{i}", rng.choice([1, 1, 2, 3, 4]), rng.randrange(4),
         rng.randrange(200_000) + rng.choice([0, 0.25, 0.75]), rng.choice([9499.99, 9500.0, 9999.99, 10000.0]))
        for i in range(n)
    ]


def test_six_payments_ten_minutes_apart(spark, at):
    rows = [(f"T{i}", 1, 1, 600 * i, 9800.0) for i in range(6)]
    result = got(features.history_features(payments(spark, at, rows), Controls()))
    assert [result[f"T{i}"] for i in range(6)] == [(i, i, int(i == 0)) for i in range(6)]


def test_window_edges_and_simultaneous_payments(spark, at):
    rows = [
        ("a", 1, 1, 0, 9500.0), ("b", 1, 1, 3600, 9500.0), ("c", 1, 1, 3600.5, 10000.0),
        ("d", 1, 2, 7201, 9999.99), ("e", 1, 1, 86400, 1.0), ("f", 1, 1, 86401, 1.0),
    ]
    assert got(features.history_features(payments(spark, at, rows), Controls())) == brute_force(rows)


@pytest.mark.parametrize("by_prefix", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_payments_equal_brute_force(spark, at, seed, by_prefix):
    rows = random_rows(seed)
    result = features.history_features(payments(spark, at, rows), Controls(), by_prefix)
    assert got(result) == brute_force(rows)


def test_later_payments_never_change_earlier_features(spark, at):
    rows = random_rows(3)
    whole = got(features.history_features(payments(spark, at, rows), Controls()))
    cut = sorted(r[3] for r in rows)[len(rows) // 2]
    past = [r for r in rows if r[3] < cut]
    assert got(features.history_features(payments(spark, at, past), Controls())) == {
        r[0]: whole[r[0]] for r in past
    }


def test_windows_are_cut_by_time_and_payments_are_shuffled_once(spark, at, tmp_path):
    path = str(tmp_path / "payments")
    payments(spark, at, random_rows(4)).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = features.history_features(spark.read.parquet(path), Controls())
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert all("block" in w for w in re.findall(r"windowspecdefinition\(([^)]*)\)", plan))
    shuffles = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert len(shuffles) == 6
    # the payments themselves: once, by customer and second
    assert sum(s.startswith("customer_id") and "sec" in s for s in shuffles) == 3


def test_preparing_payments(spark, at):
    rows = [("a", 1, 1, 0, 5.0), ("a", 1, 1, 0, 5.0), ("b", 1, 1, 90_000, -1.0), ("c", 1, 1, 90_000, 0.0)]
    result = features.prepare_payments(payments(spark, at, rows)).collect()
    assert [(r.transaction_id, str(r.payment_date)) for r in result] == [("a", "2024-01-01")]
    assert result[0].amount_log == pytest.approx(1.791759469228055)


def test_first_version_keeps_the_earliest(spark, at):
    rows = [("a", 2, 1, 50, 5.0), ("a", 1, 1, 10, 7.0), ("b", 1, 1, 0, 1.0)]
    result = features.first_version(payments(spark, at, rows))
    assert {r.transaction_id: r.amount for r in result.collect()} == {"a": 7.0, "b": 1.0}


def test_no_truth_or_identifier_is_a_feature():
    features.assert_no_leak(features.FEATURES)
    with pytest.raises(ValueError):
        features.assert_no_leak([*features.FEATURES, "screening_truth"])


def test_zero_expected_amount_gives_no_ratio(spark, at):
    frame = payments(spark, at, [("a", 1, 1, 0, 5.0)]).withColumns(
        {"expected_amount": F.lit(0.0), "destination_country": F.lit("XZ")}
    )
    row = features.row_features(frame, Controls()).first()
    assert row.amount_ratio is None and row.high_risk_geo == 1 and row.night == 1


def test_parts_of_payments_grow_with_them(spark, monkeypatch):
    """What a task joins and sorts is bounded: parts follow the number of payments, on both joins."""
    from riskweave import session
    from riskweave.plans.views import Views
    from tests.conftest import TINY

    names = ["transaction_id", "velocity_1h", "adjacent_prior_24h", "new_counterparty"]
    whole = Views(spark, TINY).featured.select(names).collect()
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of some size
    try:
        v = Views(spark, TINY)
        rows = v.payments.count()
        for frame in (v.payments, v.featured):
            assert frame.rdd.getNumPartitions() >= rows // 50
        assert sorted(map(tuple, v.featured.select(names).collect())) == sorted(map(tuple, whole))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
