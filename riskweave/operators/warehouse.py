"""Star schema: dimensions, facts, declared constraints, staged publication."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.functions.bands import RISK_CATEGORIES, risk_key
from riskweave.operators.contracts import Constraint, ContractError, check_constraints, totals_differ
from riskweave.session import side_by_side
from riskweave.sources import publication

# Columns of the customer dimension and of both facts, in order.
CUSTOMER_COLUMNS = (
    "customer_key", "customer_id", "account_id", "customer_type", "residence_country",
    "account_age_days", "industry", "risk_segment", "kyc_status", "pep_flag",
    "expected_monthly_volume", "expected_amount", "expected_min", "expected_max",
)
FACT_COLUMNS = (
    "transaction_id", "customer_key", "counterparty_key", "date_key", "origin_geography_key",
    "destination_geography_key", "channel_key", "risk_key", "timestamp", "amount", "currency",
    "payment_type", "payment_category", "originating_bank", "network", "beneficiary_bank",
    "status", "risk_score", "model_probability", "screening_score", "alert_flag",
    "rule_reasons", "investigation_label", "screening_truth",
)
ALERT_COLUMNS = (
    "alert_id", "transaction_id", "customer_key", "counterparty_key", "date_key", "alert_type",
    "risk_score", "rules_triggered", "model_version", "screening_version", "created_at",
    "status", "investigator_notes", "disposition", "reason_code", "reviewed_at",
)


def date_key(moment) -> Column:
    return F.date_format(moment, "yyyyMMdd").cast("int")


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.withColumn("customer_key", F.col("customer_id") + 1).select(*CUSTOMER_COLUMNS)


def dim_counterparty(counterparties: DataFrame) -> DataFrame:
    """Without the truth flag."""
    return counterparties.select(
        (F.col("counterparty_id") + 1).alias("counterparty_key"),
        "counterparty_id", "counterparty_name", "country", "counterparty_type",
    )


def dim_date(payments: DataFrame) -> DataFrame:
    """Observed UTC dates only."""
    day = F.col("calendar_date")
    return (
        payments.select(F.to_date("timestamp").alias("calendar_date"))
        .distinct()
        .select(
            date_key(day).alias("date_key"), day,
            F.year(day).alias("year"), F.month(day).alias("month"), F.day(day).alias("day"),
        )
    )


def numbered(values: DataFrame, column: str, key: str) -> DataFrame:
    """Distinct codes numbered 1..n in order. For code lists: one window over the distinct values."""
    return values.select(column).distinct().select(
        F.row_number().over(W.orderBy(column)).alias(key), column
    )


def dim_geography(payments: DataFrame, high_risk: tuple[str, ...]) -> DataFrame:
    seen = payments.select(F.col("origin_country").alias("country_code")).distinct().union(
        payments.select("destination_country").distinct()
    )
    return numbered(seen, "country_code", "geography_key").withColumn(
        "fictional_high_risk", F.col("country_code").isin(*high_risk)
    )


def dim_payment_channel(payments: DataFrame) -> DataFrame:
    return numbered(payments, "payment_channel", "channel_key")


def dim_risk_category(spark: SparkSession) -> DataFrame:
    rows = [(key, name) for key, name, _ in RISK_CATEGORIES]
    return spark.createDataFrame(rows, "risk_key int, risk_category string")


def lookup_keys(payments: DataFrame, geography: DataFrame, channel: DataFrame) -> DataFrame:
    """Surrogate keys of both countries and the channel; a miss leaves a null to be caught."""
    def role(name):
        return geography.select(
            F.col("country_code").alias(f"{name}_country"),
            F.col("geography_key").alias(f"{name}_geography_key"),
        )

    return (
        payments.join(role("origin"), "origin_country", "left")
        .join(role("destination"), "destination_country", "left")
        .join(channel, "payment_channel", "left")
    )


def fact_transactions(scored: DataFrame, geography: DataFrame, channel: DataFrame) -> DataFrame:
    return (
        lookup_keys(scored, geography, channel)
        .withColumns(
            {
                "customer_key": F.col("customer_id") + 1,
                "counterparty_key": F.col("counterparty_id") + 1,
                "date_key": date_key("timestamp"),
                "risk_key": risk_key("risk_score"),
                "amount": F.col("amount").cast("decimal(18,2)"),
                "risk_score": F.col("risk_score").cast("double"),
            }
        )
        .select(*FACT_COLUMNS)
    )


def fact_screening_alerts(cases: DataFrame) -> DataFrame:
    return cases.withColumns(
        {
            "customer_key": F.col("customer_id") + 1,
            "counterparty_key": F.col("counterparty_id") + 1,
            "date_key": date_key("created_at"),
        }
    ).select(*ALERT_COLUMNS)


def build_star(
    customers: DataFrame,
    counterparties: DataFrame,
    payments: DataFrame,
    scored: DataFrame,
    cases: DataFrame,
    high_risk: tuple[str, ...],
) -> dict[str, DataFrame]:
    """The eight tables. Dimensions read the plain payments, not the scored chain."""
    geography = dim_geography(payments, high_risk)
    channel = dim_payment_channel(payments)
    return {
        "dim_customer": dim_customer(customers),
        "dim_counterparty": dim_counterparty(counterparties),
        "dim_date": dim_date(payments),
        "dim_geography": geography,
        "dim_payment_channel": channel,
        "dim_risk_category": dim_risk_category(scored.sparkSession),
        "fact_transactions": fact_transactions(scored, geography, channel),
        "fact_screening_alerts": fact_screening_alerts(cases),
    }


def _constraints() -> list[Constraint]:
    primary = {
        "dim_customer": "customer_key", "dim_counterparty": "counterparty_key",
        "dim_date": "date_key", "dim_geography": "geography_key",
        "dim_payment_channel": "channel_key", "dim_risk_category": "risk_key",
        "fact_transactions": "transaction_id", "fact_screening_alerts": "alert_id",
    }
    unique = {
        "dim_customer": "customer_id", "dim_counterparty": "counterparty_id",
        "dim_date": "calendar_date", "dim_geography": "country_code",
        "dim_payment_channel": "payment_channel", "dim_risk_category": "risk_category",
    }
    foreign = [
        ("fact_transactions", "customer_key", "dim_customer", "customer_key"),
        ("fact_transactions", "counterparty_key", "dim_counterparty", "counterparty_key"),
        ("fact_transactions", "date_key", "dim_date", "date_key"),
        ("fact_transactions", "origin_geography_key", "dim_geography", "geography_key"),
        ("fact_transactions", "destination_geography_key", "dim_geography", "geography_key"),
        ("fact_transactions", "channel_key", "dim_payment_channel", "channel_key"),
        ("fact_transactions", "risk_key", "dim_risk_category", "risk_key"),
        ("fact_screening_alerts", "transaction_id", "fact_transactions", "transaction_id"),
        ("fact_screening_alerts", "customer_key", "dim_customer", "customer_key"),
        ("fact_screening_alerts", "counterparty_key", "dim_counterparty", "counterparty_key"),
        ("fact_screening_alerts", "date_key", "dim_date", "date_key"),
    ]
    return (
        [Constraint("primary", t, c) for t, c in primary.items()]
        + [Constraint("unique", t, c) for t, c in unique.items()]
        + [Constraint("not_null", t, c) for t, c, _, _ in foreign]
        + [Constraint("not_null", t, f"{t[4:]}_id") for t in ("dim_customer", "dim_counterparty")]
        + [Constraint("foreign", *f) for f in foreign]
    )


STAR_CONSTRAINTS = _constraints()

# The two standard reports, as SQL over the registered star tables.
OPERATIONS_SQL = """
SELECT count(*) AS transactions_screened,
       sum(cast(alert_flag AS INT)) AS alerts,
       avg(cast(alert_flag AS INT)) AS alert_rate,
       avg(risk_score) AS average_risk_score,
       count_if(alert_flag AND risk_score >= 70) AS high_risk_alerts
FROM fact_transactions
"""
DAILY_SQL = """
SELECT calendar_date, count(*) AS transactions, sum(cast(alert_flag AS INT)) AS alerts,
       sum(amount) AS payment_value_gbp, avg(risk_score) AS average_risk_score
FROM fact_transactions JOIN dim_date USING (date_key)
GROUP BY calendar_date
ORDER BY calendar_date
"""


def publish(
    tables: dict[str, DataFrame], root: str, source: DataFrame | None = None, after: int | None = None
) -> str:
    """Write all tables under a new version, check them as written, then announce the version.

    Readers follow a numbered log of announcements, so a failed or partial load is never visible and a
    table being read is never overwritten. ``source`` reconciles count and amount. ``after`` announces
    only as the successor of that number in the log, for a load built on what was published then; without
    it a load replaces everything, whoever published meanwhile. Tables are written side by side.
    """
    spark = next(iter(tables.values())).sparkSession
    version = uuid.uuid4().hex

    def write(item: tuple[str, DataFrame]) -> None:
        item[1].write.mode("errorifexists").parquet(f"{root}/versions/{version}/{item[0]}")

    side_by_side(spark, write, list(tables.items()))
    staged = {name: spark.read.schema(tables[name].schema).parquet(f"{root}/versions/{version}/{name}") for name in tables}
    present = [
        c for c in STAR_CONSTRAINTS
        if c.table in staged and (not c.parent or c.parent in staged)
    ]
    if present:
        broken = check_constraints(staged, present).where("violations > 0").collect()
        if broken:
            raise ContractError(f"constraints broken: {[tuple(r) for r in broken]}")
    if source is not None and totals_differ(staged["fact_transactions"], source).first()["differ"]:
        raise ContractError("warehouse does not reconcile with its source")
    publication.append(spark, f"{root}/published", {"version": version}, after)
    return version


def published(spark: SparkSession, root: str) -> dict:
    """Number, version and path of what was announced last."""
    last = max(publication.entries(spark, f"{root}/published"))
    version = publication.read(spark, f"{root}/published", last)["version"]
    return {"number": last, "version": version, "path": f"{root}/versions/{version}"}


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{published(spark, root)['path']}/{table}")
