import json
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from riskweave.config import ControlError, Controls, Rule, controls_from_dict, load_controls, run_key
from riskweave.functions.numbers import fixed_point
from riskweave.operators import alerts, rules
from riskweave.sources.files import read_rules

FEATURES = (
    "transaction_id string, amount_ratio double, high_risk_geo int, night int, velocity_1h bigint,"
    " new_counterparty_high_value int, screening_score double, adjacent_prior_24h bigint"
)
ROWS = [
    ("none", 1.0, 0, 0, 0, 0, 20.0, 0),
    ("edge", 4.0, 0, 0, 4, 0, 88.0, 2),
    ("all", 9.0, 1, 1, 9, 1, 99.0, 9),
    ("night", 1.0, 0, 1, 0, 0, 20.0, 0),
    ("blank", None, 0, 1, 0, 1, 20.0, 0),
]


@pytest.fixture
def ruled(spark):
    return rules.apply_rules(spark.createDataFrame(ROWS, FEATURES), Controls())


def test_scores_reasons_and_review(ruled):
    got = {r.transaction_id: (r.risk_score, r.rule_reasons, r.rule_review) for r in ruled.collect()}
    assert got["none"] == (0, "", False)
    assert got["edge"] == (
        100, "HIGH_AMOUNT_DEVIATION|VELOCITY_SPIKE|WATCHLIST_SIMILARITY|REPEATED_THRESHOLD_ADJACENT", True
    )
    assert got["all"][0] == 100 and got["all"][1].count("|") == 6
    assert got["night"] == (10, "UNUSUAL_TIME", False)
    assert got["blank"] == (30, "UNUSUAL_TIME|NEW_COUNTERPARTY", False)


def test_evidence_lists_triggered_rules_with_observed_values(ruled):
    row = ruled.where("transaction_id = 'edge'").select(rules.rule_evidence(Controls()).alias("e")).first()
    assert [(e.rule_id, e.observed_value) for e in row.e] == [
        ("R01", 4.0), ("R04", 4.0), ("R06", 88.0), ("R07", 2.0)
    ]


def test_only_known_operators():
    with pytest.raises(ControlError):
        Rule("R99", "X", "night", 1, 1, operator="lt")
    with pytest.raises(ControlError):
        controls_from_dict({"rules": [
            {"rule_id": "R1", "rule_name": "A", "feature": "night", "threshold": 1, "score": 1, "operator": "eq"}
        ]})
    with pytest.raises(ControlError):
        Controls(rules=(Rule("R1", "A", "night", 1, 1), Rule("R1", "B", "night", 1, 1)))


def test_controls_document(spark, tmp_path):
    path = tmp_path / "controls.json"
    document = {
        "risk_threshold": 50, "high_risk_countries": ["AA"],
        "rules": [{"rule_id": "R1", "rule_name": "NIGHT", "feature": "night", "threshold": 1, "score": 60}],
    }
    path.write_text(json.dumps(document))
    controls = load_controls(path)
    assert controls.risk_threshold == 50 and controls.high_risk_countries == ("AA",)
    assert [r.rule_name for r in read_rules(spark, str(path)).collect()] == ["NIGHT"]
    scored = rules.apply_rules(spark.createDataFrame(ROWS, FEATURES), controls)
    assert scored.where("rule_review").count() == 3


def test_run_key_follows_every_input():
    keys = {
        run_key(1, 42, Controls()), run_key(2, 42, Controls()), run_key(1, 43, Controls()),
        run_key(1, 42, Controls(risk_threshold=41)),
    }
    assert len(keys) == 4 and all(len(k) == 12 for k in keys)


def scored(ruled):
    return alerts.combined_alert(
        ruled.withColumns({
            "model_probability": F.when(F.col("transaction_id") == "night", 0.5).otherwise(0.1),
            "recommendation": F.when(F.col("transaction_id") == "all", "REVIEW").otherwise("CLEAR"),
            "timestamp": F.to_timestamp(F.lit("2024-01-01 00:00:00")),
            "customer_id": F.lit(1), "counterparty_id": F.lit(2),
        }),
        0.5,
    )


def test_any_signal_raises_an_alert(ruled):
    rows = {r.transaction_id: r for r in alerts.alert_rows(scored(ruled), Controls()).collect()}
    assert set(rows) == {"edge", "all", "night"}
    assert rows["all"].alert_type == "SCREENING" and rows["edge"].alert_type == "PAYMENT_RISK"
    assert rows["night"].alert_id == "ALERT-night" and rows["night"].status == "OPEN"
    assert rows["edge"].evidence.velocity_1h == 4


def test_score_lookup_reports_unknown_ids(spark, ruled):
    wanted = spark.createDataFrame([("edge",), ("night",), ("nope",), ("none",)], "transaction_id string")
    sheet, unknown = alerts.payment_scores(wanted, scored(ruled), Controls(), 0.5)
    got = {r.transaction_id: (r.recommendation, len(r.rules)) for r in sheet.collect()}
    assert got == {"edge": ("REVIEW", 4), "night": ("REVIEW", 1), "none": ("CLEAR", 0)}
    assert [r.transaction_id for r in unknown.collect()] == ["nope"]


def test_only_the_template_itself_is_accepted(ruled):
    rows = alerts.alert_rows(scored(ruled), Controls())
    text = alerts.summary_text()
    supplied = rows.withColumn(
        "text",
        F.when(F.col("transaction_id") == "edge", text)
        .when(F.col("transaction_id") == "all", F.concat(text, F.lit(" "))),
    )
    got = {r.alert_id: r for r in alerts.summarise_cases(supplied, "text").collect()}
    assert got["ALERT-edge"].mode == "validated_template"
    assert got["ALERT-all"].mode == got["ALERT-night"].mode == "deterministic_fallback"
    assert "ratio 4.00 [" in got["ALERT-edge"].summary and "88.0/100" in got["ALERT-edge"].summary


def test_model_only_alert_names_the_model(spark, ruled):
    rows = alerts.alert_rows(scored(ruled).where("transaction_id = 'night'"), Controls())
    bare = rows.withColumn("rules_triggered", F.lit(""))
    assert "Triggered controls: MODEL_THRESHOLD" in alerts.summarise_cases(bare).first().summary


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_fixed_point_rounds_the_binary_value_half_to_even(spark, digits):
    values = [61.25, 61.35, 61.65, 2.675, 0.125, 0.375, 1.0005, 2.5, 0.0, -1.005, -0.125, 12345.6785, 1e-9, 7.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.t for r in frame.select(fixed_point(F.col("v"), digits).alias("t")).collect()]
    step = Decimal(1).scaleb(-digits)
    want = [str(Decimal(abs(v)).quantize(step, ROUND_HALF_EVEN)) for v in values]
    assert [g.lstrip("-") for g in got] == want
