"""Alert decision, alert rows, payment score lookup and evidence summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.config import Controls
from riskweave.functions.numbers import fixed_point
from riskweave.operators.rules import rule_evidence

NO_RULE = "MODEL_THRESHOLD"
EVIDENCE_FIELDS = ("amount_ratio", "screening_score", "velocity_1h", "rules_triggered")


def combined_alert(frame: DataFrame, model_threshold: float) -> DataFrame:
    """Adds model_review and alert_flag; any of rules, model and screening raises an alert."""
    return frame.withColumn("model_review", F.col("model_probability") >= model_threshold).withColumn(
        "alert_flag",
        F.col("rule_review") | F.col("model_review") | (F.col("recommendation") == "REVIEW"),
    )


def alert_rows(scored: DataFrame, controls: Controls) -> DataFrame:
    """One open case per alerted payment."""
    contributors = (
        F.col("top_contributors") if "top_contributors" in scored.columns else F.lit(None)
    ).cast("string")
    missing = F.lit(None).cast("string")
    return scored.where("alert_flag").select(
        F.concat(F.lit("ALERT-"), "transaction_id").alias("alert_id"),
        "transaction_id", "customer_id", "counterparty_id",
        F.when(F.col("recommendation") == "REVIEW", "SCREENING").otherwise("PAYMENT_RISK").alias("alert_type"),
        F.col("risk_score").cast("double").alias("risk_score"),
        F.col("rule_reasons").alias("rules_triggered"),
        F.lit(controls.model_version).alias("model_version"),
        F.lit(controls.screening_version).alias("screening_version"),
        F.col("timestamp").alias("created_at"),
        F.lit("OPEN").alias("status"),
        F.lit("").alias("investigator_notes"),
        missing.alias("disposition"),
        missing.alias("reason_code"),
        F.lit(None).cast("timestamp").alias("reviewed_at"),
        F.struct(
            F.col("amount_ratio").cast("double").alias("amount_ratio"),
            F.col("screening_score").cast("double").alias("screening_score"),
            F.col("velocity_1h").cast("bigint").alias("velocity_1h"),
            contributors.alias("top_contributors"),
        ).alias("evidence"),
    )


def payment_scores(
    requests: DataFrame, scored: DataFrame, controls: Controls, model_threshold: float
) -> tuple[DataFrame, DataFrame]:
    """(score sheet of the requested payments, requested ids that are unknown)."""
    wanted = requests.select("transaction_id").distinct()
    found = scored.join(wanted, "transaction_id", "left_semi")
    review = (
        (F.col("model_probability") >= model_threshold)
        | F.col("rule_review")
        | (F.col("recommendation") == "REVIEW")
    )
    contributors = (
        F.col("top_contributors") if "top_contributors" in scored.columns else F.lit(None)
    ).cast("string")
    sheet = found.select(
        "transaction_id",
        F.col("model_probability").alias("probability"),
        F.lit(float(model_threshold)).alias("model_threshold"),
        F.col("risk_score").cast("int").alias("risk_score"),
        F.when(review, "REVIEW").otherwise("CLEAR").alias("recommendation"),
        rule_evidence(controls).alias("rules"),
        F.lit(controls.model_version).alias("model_version"),
        contributors.alias("top_contributors"),
        review.alias("human_review_required"),
    )
    unknown = wanted.join(scored.select("transaction_id"), "transaction_id", "left_anti")
    return sheet, unknown


def summary_text() -> Column:
    """The one accepted summary of a case. Fixed value: its wording."""
    rules = F.coalesce(F.nullif(F.col("rules_triggered"), F.lit("")), F.lit(NO_RULE))
    return F.format_string(
        "Transaction %s has amount / expected baseline ratio %s [amount_ratio], synthetic "
        "reference similarity %s/100 [screening_score], and %d prior payments in one hour "
        "[velocity_1h]. Triggered controls: %s [rules_triggered]. Human review required.",
        F.col("transaction_id"),
        fixed_point(F.col("evidence.amount_ratio"), 2),
        fixed_point(F.col("evidence.screening_score"), 1),
        F.col("evidence.velocity_1h"),
        rules,
    )


def summarise_cases(cases: DataFrame, generated: str | None = None) -> DataFrame:
    """Evidence summary of every case; ``generated`` names a column with supplied texts.

    A supplied text counts only when it equals the template word for word.
    """
    text = summary_text()
    matches = F.col(generated).eqNullSafe(text) if generated else F.lit(False)
    return cases.select(
        "alert_id",
        text.alias("summary"),
        F.when(matches, "validated_template").otherwise("deterministic_fallback").alias("mode"),
        F.array(*map(F.lit, EVIDENCE_FIELDS)).alias("evidence_fields"),
        F.lit(True).alias("human_review_required"),
    )
