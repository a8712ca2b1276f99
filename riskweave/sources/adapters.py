"""The payment-risk entities, derived from the whole of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import tasks_for
from riskweave.sources.files import read_table

RISK_COUNTRIES = ("NATION_5", "NATION_6")

# Pattern names given to payments whose props carry a high k.
PATTERNS = (
    "SCREENING_HIT", "AMOUNT_SPIKE", "VELOCITY_BURST", "RISK_GEOGRAPHY",
    "NIGHT_TRANSFER", "NEW_BENEFICIARY", "THRESHOLD_ADJACENT",
)


def _pick(key, names):
    return F.element_at(F.array(*map(F.lit, names)), (key % len(names) + 1).cast("int"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    expected = 500 + F.abs("c_acctbal") / 4
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        read_table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("customer_id"),
            F.concat(F.lit("SYN-ACCOUNT-"), F.lpad(key.cast("string"), 9, "0")).alias("account_id"),
            (10 + key * 37 % 2990).cast("int").alias("account_age_days"),
            _pick(key, ("PERSON", "BUSINESS")).alias("customer_type"),
            F.col("n_name").alias("residence_country"),
            F.col("c_mktsegment").alias("industry"),
            _pick(key, ("LOW", "MEDIUM", "HIGH")).alias("risk_segment"),
            F.when(key % 25 == 0, "PENDING").otherwise("COMPLETE").alias("kyc_status"),
            (key % 50 == 0).alias("pep_flag"),
            (10 + key % 90).cast("int").alias("expected_monthly_volume"),
            expected.alias("expected_amount"),
            (expected * 0.2).alias("expected_min"),
            (expected * 3).alias("expected_max"),
        )
    )


def watchlist(spark: SparkSession, folder: str) -> DataFrame:
    """One listed entity per nation, named after the part that shares its key."""
    part = read_table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    key = F.col("entity_id")
    alias = F.concat_ws(" ", "p_brand", "p_name")
    return (
        read_table(spark, folder, "nation")
        .select(F.col("n_nationkey").cast("bigint").alias("entity_id"), F.col("n_name").alias("country"))
        .join(part, F.col("entity_id") == F.col("p_partkey"))
        .select(
            "entity_id",
            F.when(key % 2 == 0, F.upper(F.concat_ws(" ", "p_name", "p_type")))
            .otherwise(
                F.concat(
                    F.expr("substring(p_name, 1, 1)"), F.expr("substring(p_name, 3)"),
                    F.lit(" "), "p_type",
                )
            )
            .alias("canonical_name"),
            F.when(key % 7 == 3, "")
            .when(key % 5 == 0, F.concat(alias, F.lit(" | "), F.concat_ws(" ", "p_name", "p_brand")))
            .otherwise(alias)
            .alias("aliases"),
            "country",
            F.when(key % 6 == 5, "PERSON").otherwise("BUSINESS").alias("entity_type"),
            F.lit("SYNTHETIC").alias("sanctions_program"),
            F.lit("SYNTHETIC-LIST").alias("source"),
            (key % 10 != 9).alias("active"),
        )
    )


def counterparties(spark: SparkSession, folder: str) -> DataFrame:
    """One counterparty per part; the truth flag says whether its name is a listed one."""
    part = read_table(spark, folder, "part")
    key = F.col("p_partkey")
    product = F.concat_ws(" ", "p_name", "p_type")
    branded = F.concat_ws(" ", "p_brand", "p_name")
    listed = (
        read_table(spark, folder, "nation")
        .where(F.col("n_nationkey") % 10 != 9)
        .select(F.col("n_nationkey").cast("bigint").alias("p_partkey"))
        .join(part, "p_partkey")
        .select(F.explode(F.array(product, branded)).alias("listed_name"))
        .distinct()
    )
    return (
        part.select(
            key.alias("counterparty_id"),
            F.when(key % 4 == 3, branded).otherwise(product).alias("counterparty_name"),
            F.lit("").alias("aliases"),
            F.when(key % 2 == 0, F.concat(F.lit("NATION_"), (key % 25).cast("string")))
            .otherwise("NATION_0")
            .alias("country"),
            F.lit("BUSINESS").alias("counterparty_type"),
            F.when(F.col("p_size") > 40, "MEDIUM").otherwise("LOW").alias("baseline_risk"),
        )
        .join(listed, F.col("counterparty_name") == F.col("listed_name"), "left")
        .withColumn("synthetic_sanctions_flag", F.col("listed_name").isNotNull())
        .drop("listed_name")
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per event. Amounts of -0.0 are normalised to 0.0.

    They lie by customer, in as many parts as the events fill: what joins and sorts them by
    customer later stays in these parts, and a part does not grow with the table.
    """
    event, user = F.col("event_id"), F.col("user_id")
    events = read_table(spark, folder, "events")
    parts = tasks_for(events.count())
    n_parts = read_table(spark, folder, "part").select(F.count(F.lit(1))).scalar()
    residence = (
        read_table(spark, folder, "customer")
        .select("c_custkey", "c_nationkey")
        .join(read_table(spark, folder, "nation").select("n_nationkey", "n_name"),
              F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("origin_country"))
    )
    k = F.get_json_object("props", "$.k").cast("int")
    amount = F.round(F.col("value") * 100, 2) + F.lit(0.0)
    return (
        events.repartition(parts, "user_id")
        .join(residence, "user_id")
        .select(
            F.concat(F.lit("TX-"), F.lpad(event.cast("string"), 9, "0")).alias("transaction_id"),
            user.alias("customer_id"),
            ((user * 31 + event % 7) % n_parts).alias("counterparty_id"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            amount.alias("amount"),
            F.lit("GBP").alias("currency"),
            "origin_country",
            F.concat(F.lit("NATION_"), (event % 25).cast("string")).alias("destination_country"),
            F.col("event_type").alias("payment_channel"),
            _pick(event, ("TRANSFER", "CARD", "WIRE")).alias("payment_type"),
            _pick(F.expr("event_id div 3"), ("RETAIL", "SERVICES", "REMITTANCE")).alias("payment_category"),
            F.concat(F.lit("DEV-"), (user % 97).cast("string")).alias("device_id"),
            F.concat(F.lit("BANK-"), (user % 5).cast("string")).alias("originating_bank"),
            F.concat(F.lit("NET-"), (event % 2).cast("string")).alias("network"),
            F.concat(F.lit("BANK-"), (event % 6).cast("string")).alias("beneficiary_bank"),
            F.when(event % 20 == 0, "FAILED").when(event % 20 <= 2, "PENDING").otherwise("SETTLED")
            .alias("status"),
            F.when(k < 70, "NORMAL").otherwise(_pick(k, PATTERNS)).alias("injected_pattern"),
            F.when((k >= 95) | ((k >= 70) & (amount >= 2000)), 1).otherwise(0)
            .alias("investigation_label"),
        )
    )
