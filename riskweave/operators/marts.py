"""Reporting marts built on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.bands import amount_band, flag, match_method, score_band
from riskweave.operators.contracts import join_one_to_one

KEYS = (
    "customer_key", "counterparty_key", "date_key", "origin_geography_key",
    "destination_geography_key", "channel_key", "risk_key",
)
CELLS = (
    ("Negative", "Clear", "tn"), ("Negative", "Review", "fp"),
    ("Positive", "Clear", "fn"), ("Positive", "Review", "tp"),
)
ISO = "yyyy-MM-dd'T'HH:mm:ss"


def _join_1to1(left: DataFrame, right: DataFrame, key: str, check: bool) -> DataFrame:
    return join_one_to_one(left, right, key) if check else left.join(right, key)


def enriched_counterparties(
    dim: DataFrame, counterparties: DataFrame, screened: DataFrame, check: bool = True
) -> DataFrame:
    base = counterparties.select("counterparty_id", "baseline_risk")
    joined = _join_1to1(dim, base, "counterparty_id", check)
    joined = _join_1to1(joined, screened.drop("counterparty"), "counterparty_id", check)
    return joined.withColumn("match_method", match_method("alias_match", "name_similarity_score"))


def fact_extras(scored: DataFrame) -> DataFrame:
    return scored.select(
        "transaction_id", "velocity_1h", "amount_ratio", "night", "new_counterparty", "recommendation",
        F.hour("timestamp").alias("hour_utc"),
        flag(F.col("recommendation") == "REVIEW").alias("screening_review"),
        score_band("screening_score").alias("screening_score_band"),
        amount_band("amount").alias("amount_band"),
    )


def transactions_mart(fact: DataFrame, scored: DataFrame, check: bool = True) -> DataFrame:
    """33 columns: the fact plus point-in-time features, hour and bands."""
    return _join_1to1(fact, fact_extras(scored), "transaction_id", check).withColumns(
        {"alert_flag": flag("alert_flag"), "timestamp": F.date_format("timestamp", ISO)}
    )


def age_in_days(cutoff: Column, moment: Column) -> Column:
    return (F.unix_micros(cutoff) - F.unix_micros(moment)) / F.lit(86_400_000_000.0)


def with_age(cases: DataFrame, payments: DataFrame) -> DataFrame:
    """Days from the creation of a case to the last payment seen."""
    cutoff = payments.select(F.max("timestamp")).scalar()
    return cases.withColumn("age_at_data_cutoff_days", age_in_days(cutoff, F.col("created_at")))


def alerts_mart(cases: DataFrame, fact: DataFrame, payments: DataFrame, check: bool = True) -> DataFrame:
    """23 columns: live case state without evidence, fact keys, age, formatted times."""
    keys = fact.select("transaction_id", *KEYS)
    joined = _join_1to1(cases.drop("evidence"), keys, "transaction_id", check)
    return with_age(joined, payments).withColumns(
        {
            "disposition": F.coalesce("disposition", F.lit("NOT_REVIEWED")),
            "created_at": F.date_format("created_at", ISO),
            "reviewed_at": F.date_format("reviewed_at", ISO),
        }
    )


def alert_rules_bridge(cases: DataFrame) -> DataFrame:
    """One row per alert and triggered rule; alerts without a rule have none."""
    names = F.split(F.coalesce("rules_triggered", F.lit("")), r"\|")
    return cases.select("alert_id", F.explode(names).alias("rule_name")).where("rule_name <> ''")


def confusion_cells(comparison: DataFrame) -> DataFrame:
    """(model, actual, predicted, cell, count): four rows per model."""
    cells = [
        F.struct(
            F.lit(actual).alias("actual"), F.lit(predicted).alias("predicted"),
            F.lit(cell.upper()).alias("cell"), F.col(cell).cast("bigint").alias("count"),
        )
        for actual, predicted, cell in CELLS
    ]
    return comparison.select("model", F.explode(F.array(*cells)).alias("c")).select("model", "c.*")


def plain_feature_names(importance: DataFrame) -> DataFrame:
    return importance.withColumn("feature", F.regexp_replace("feature", "^(numeric|category)__", ""))


def role_geographies(geography: DataFrame) -> dict[str, DataFrame]:
    """The geography dimension once per role."""
    return {"dim_origin_geography": geography, "dim_destination_geography": geography}


FINDINGS = (
    "chi_square", "chi_p_value", "cramers_v", "mann_whitney_u", "rank_biserial", "spearman_rho",
    "ci_lower", "ci_upper", "alerted_median", "nonalerted_median",
)
INTERPRETATION = (
    "Associations are exploratory: rules partly define them and payments of one customer "
    "depend on each other, so p-values are descriptive only."
)


def statistical_findings(statistics: DataFrame) -> DataFrame:
    """One wide row from (metric, value) rows."""
    picks = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in FINDINGS]
    return statistics.agg(*picks).withColumn("interpretation", F.lit(INTERPRETATION))


def export_totals(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """(metric, value) rows: counts, rate, amount, mean risk, alerts per status."""
    one = transactions.agg(
        F.count(F.lit(1)).cast("double").alias("transactions"),
        F.avg("alert_flag").alias("alert_rate"),
        F.count_if((F.col("alert_flag") == 1) & (F.col("risk_score") >= 70)).cast("double").alias("high_risk_alerts"),
        F.avg("risk_score").alias("average_risk_score"),
        F.sum("amount").cast("double").alias("total_amount_gbp"),
    )
    totals = one.unpivot([], one.columns, "metric", "value")
    status = alerts.groupBy(F.concat(F.lit("status_"), "status").alias("metric")).agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )
    count = alerts.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("alerts").alias("metric"), "value"
    )
    return totals.unionByName(count).unionByName(status)


def reconcile_marts(transactions: DataFrame, alerts: DataFrame, summary: DataFrame) -> DataFrame:
    """The four equalities between marts and the operations summary: (check, passed)."""
    flagged = F.col("alert_flag") == 1
    facts = transactions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("alert_flag"), F.lit(0)).alias("flagged"),
        F.avg("risk_score").alias("mean_risk"),
        F.count_if(flagged & (F.col("risk_score") >= 70)).alias("high_risk"),
    ).withColumn("k", F.lit(1))
    cases = alerts.agg(F.count(F.lit(1)).alias("cases")).withColumn("k", F.lit(1))
    both = facts.join(cases, "k").join(summary.withColumn("k", F.lit(1)), "k")
    checks = both.select(
        (F.col("rows") == F.col("transactions_screened")).alias("transactions"),
        ((F.col("cases") == F.col("alerts")) & (F.col("cases") == F.col("flagged"))).alias("alerts"),
        (F.abs(F.col("mean_risk") - F.col("average_risk_score")) < 1e-9).alias("average_risk_score"),
        (F.col("high_risk") == F.col("high_risk_alerts")).alias("high_risk_alerts"),
    )
    return checks.unpivot([], checks.columns, "check", "passed")
