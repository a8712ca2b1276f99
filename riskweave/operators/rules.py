"""Rule flags, capped additive score, reasons and evidence, generated from the controls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.config import Controls, Rule


def triggered(rule: Rule) -> Column:
    return F.coalesce(F.col(rule.feature) >= F.lit(rule.threshold), F.lit(False))


def rule_score(controls: Controls) -> Column:
    hits = [F.when(F.col(r.rule_id), F.lit(r.score)).otherwise(F.lit(0)) for r in controls.rules]
    return F.least(F.lit(100), sum(hits, F.lit(0)))


def rule_reasons(controls: Controls) -> Column:
    names = [F.when(F.col(r.rule_id), F.lit(r.rule_name)) for r in controls.rules]
    return F.array_compact(F.array(*names))


def apply_rules(frame: DataFrame, controls: Controls) -> DataFrame:
    """Adds R01.., risk_score, rule_reasons (bar-joined, "" when none) and rule_review."""
    flagged = frame.withColumns({r.rule_id: triggered(r) for r in controls.rules})
    return flagged.withColumns(
        {
            "risk_score": rule_score(controls),
            "rule_reasons": F.array_join(rule_reasons(controls), "|"),
        }
    ).withColumn("rule_review", F.col("risk_score") >= controls.risk_threshold)


def rule_evidence(controls: Controls) -> Column:
    """Triggered rules with their settings and the value observed, as an array of structs."""
    entries = [
        F.when(
            triggered(r),
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.rule_name).alias("rule_name"),
                F.lit(r.feature).alias("feature"),
                F.lit(r.operator).alias("operator"),
                F.lit(float(r.threshold)).alias("threshold"),
                F.lit(r.severity).alias("severity"),
                F.lit(r.score).alias("score"),
                F.lit(r.explanation).alias("explanation"),
                F.col(r.feature).cast("double").alias("observed_value"),
            ),
        )
        for r in controls.rules
    ]
    return F.array_compact(F.array(*entries))
