"""Operational aggregates over scored payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.bands import risk_band

MONEY = "decimal(18,2)"


def _money(column: str) -> Column:
    """Exact sum of a two-decimal amount."""
    return F.sum(F.col(column).cast(MONEY)).cast("double")


def operations_summary(facts: DataFrame) -> DataFrame:
    flagged = F.col("alert_flag").cast("int")
    return facts.agg(
        F.count(F.lit(1)).alias("transactions_screened"),
        F.coalesce(F.sum(flagged), F.lit(0)).alias("alerts"),
        F.avg(flagged).alias("alert_rate"),
        F.avg("risk_score").alias("average_risk_score"),
        F.count_if((flagged == 1) & (F.col("risk_score") >= 70)).alias("high_risk_alerts"),
    )


def daily_operations(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Per calendar date, ordered. Facts are aggregated by key before they meet the dates."""
    per_key = facts.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum(F.col("alert_flag").cast("int")).alias("alerts"),
        _money("amount").alias("payment_value_gbp"),
        F.avg("risk_score").alias("average_risk_score"),
    )
    return (
        per_key.join(dates.select("date_key", "calendar_date"), "date_key")
        .drop("date_key")
        .select("calendar_date", "transactions", "alerts", "payment_value_gbp", "average_risk_score")
        .orderBy("calendar_date")
    )


def in_channels(frame: DataFrame, channels: list[str]) -> DataFrame:
    """Rows of the chosen channels; choosing none gives none."""
    return frame.where(F.col("payment_channel").isin(channels)) if channels else frame.limit(0)


def daily_counts(frame: DataFrame) -> DataFrame:
    return frame.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("transactions"), F.sum(F.col("alert_flag").cast("int")).alias("alerts")
    )


def alert_rate_by(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy(column).agg(F.avg(F.col("alert_flag").cast("int")).alias("alert_rate"))


def geography_profile(frame: DataFrame) -> DataFrame:
    return frame.groupBy("destination_country").agg(
        F.count(F.lit(1)).alias("payments"),
        F.sum(F.col("alert_flag").cast("int")).alias("alerts"),
        F.avg("risk_score").alias("average_risk"),
    )


def reason_frequency(frame: DataFrame) -> DataFrame:
    reasons = F.explode(F.split("rule_reasons", r"\|")).alias("reason")
    return (
        frame.where("alert_flag").select(reasons).where("reason <> ''")
        .groupBy("reason").agg(F.count(F.lit(1)).alias("alerts"))
    )


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def crosstab(frame: DataFrame, rows: str, flag_column: str) -> DataFrame:
    flagged = F.col(flag_column)
    return frame.groupBy(rows).agg(
        F.count_if(~flagged).alias("not_flagged"), F.count_if(flagged).alias("flagged")
    )


def histogram(frame: DataFrame, column: str, low: float, high: float, bins: int, by: str | None = None) -> DataFrame:
    """Counts in equal-width bins; bin 0 and bins + 1 hold what lies outside [low, high)."""
    keys = ([by] if by else []) + [
        F.width_bucket(F.col(column).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)).alias("bin")
    ]
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def distinct_count(frame: DataFrame, column: str) -> DataFrame:
    return frame.agg(F.count_distinct(column).alias("n"))


def column_totals(frame: DataFrame, column: str = "amount") -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias("rows"), _money(column).alias("total"))


def top_by_alerts(frame: DataFrame, column: str, k: int) -> DataFrame:
    """The k values with most alerts, ties by value."""
    return (
        frame.where("alert_flag").groupBy(column).agg(F.count(F.lit(1)).alias("alerts"))
        .orderBy(F.desc("alerts"), column).limit(k)
    )


def policy_errors_by(frame: DataFrame, column: str) -> DataFrame:
    flagged, label = F.col("alert_flag"), F.col("investigation_label")
    return frame.groupBy(column).agg(
        F.count_if(flagged & (label == 0)).alias("false_positives"),
        F.count_if(~flagged & (label == 1)).alias("false_negatives"),
    )


def explorer_rates(frame: DataFrame) -> DataFrame:
    """Benchmark rates per day, risk band and kind of destination."""
    flagged, negative = F.col("alert_flag"), F.col("investigation_label") == 0
    grouped = frame.groupBy(
        F.date_trunc("day", "timestamp").cast("date").alias("payment_day"),
        risk_band("risk_score").alias("risk_band"),
        (F.col("high_risk_geo") == 1).alias("risk_geography"),
    ).agg(
        F.count(F.lit(1)).alias("payments"),
        F.count_if(flagged).alias("alerts"),
        F.count_if(flagged & negative).alias("benchmark_false_positives"),
        F.count_if(negative).alias("benchmark_negatives"),
    )
    return grouped.withColumns(
        {
            "alert_rate": F.try_divide("alerts", "payments"),
            "benchmark_fpr": F.try_divide("benchmark_false_positives", "benchmark_negatives"),
            "review_fp_share": F.try_divide("benchmark_false_positives", "alerts"),
        }
    )
