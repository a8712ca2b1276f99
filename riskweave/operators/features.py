"""Point-in-time features of payments.

Trailing windows look at whole seconds and leave out the current second, so a payment never
sees itself or a simultaneous one. That makes the (customer, second) the grain of every
window: payments are first counted to it, which bounds what one customer can put into one
window by elapsed time instead of by volume. A customer's seconds are then cut into blocks
as long as the window; each block also receives its predecessor, and windows run per
(customer, block). No customer, however busy, ends up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.config import Controls
from riskweave.operators.contracts import join_many_to_one
from riskweave.session import tasks_for

# Names and order of the model features.
NUMERIC = [
    "amount_ratio", "high_risk_geo", "night", "velocity_1h", "new_counterparty_high_value",
    "adjacent_prior_24h", "screening_score", "account_age_days", "pep_flag",
]
CATEGORICAL = ["payment_channel", "payment_type", "kyc_status"]
FEATURES = NUMERIC + CATEGORICAL
# Truth, labels and identifiers never enter a model.
FORBIDDEN = {
    "injected_pattern", "screening_truth", "investigation_label", "synthetic_sanctions_flag",
    "transaction_id", "customer_id", "counterparty_id",
}


def positive_amounts(payments: DataFrame) -> DataFrame:
    return payments.where(F.col("amount") > 0)


def with_date_and_log(payments: DataFrame) -> DataFrame:
    return payments.withColumn("payment_date", F.to_date("timestamp")).withColumn(
        "amount_log", F.log1p("amount")
    )


def prepare_payments(payments: DataFrame) -> DataFrame:
    """Date, log amount, positive amounts only, one row per transaction id.

    Which of several copies is kept is left open, as rows with equal ids are meant to be
    copies; ``first_version`` gives a fixed choice.
    """
    return positive_amounts(with_date_and_log(payments)).dropDuplicates(["transaction_id"])


def first_version(payments: DataFrame, key: str = "transaction_id", by: str = "timestamp") -> DataFrame:
    """One row per key: the earliest, then the one with the smallest remaining columns.

    A grouped minimum, so copies are already merged before they are shuffled.
    """
    rest = [c for c in payments.columns if c not in (key, by)]
    return (
        payments.groupBy(key)
        .agg(F.min(F.struct(by, *rest)).alias("row"))
        .select(key, "row.*")
        .select(*payments.columns)
    )


def trailing_sums(per_second: DataFrame, key: str, measures: dict[str, tuple[str, int]]) -> DataFrame:
    """Sums over [t - w, t) per key and second, for measures {name: (source column, w)}.

    ``per_second`` holds one row per (key, sec). The block length is the longest window.
    """
    block = max(w for _, w in measures.values())
    own = F.floor(F.col("sec") / block).cast("bigint")
    spread = per_second.withColumn("block", F.explode(F.array(own, own + 1)))
    ordered = W.partitionBy(key, "block").orderBy("sec")
    sums = [
        F.coalesce(F.sum(source).over(ordered.rangeBetween(-w, -1)), F.lit(0)).alias(name)
        for name, (source, w) in measures.items()
    ]
    return spread.select(key, "sec", "block", *sums).where(F.col("block") == own).drop("block")


def trailing_sums_by_prefix(
    per_second: DataFrame, key: str, measures: dict[str, tuple[str, int]]
) -> DataFrame:
    """The same sums as differences of two growing frames: linear in the rows of a block."""
    block = max(w for _, w in measures.values())
    own = F.floor(F.col("sec") / block).cast("bigint")
    spread = per_second.withColumn("block", F.explode(F.array(own, own + 1)))
    ordered = W.partitionBy(key, "block").orderBy("sec")

    def before(source: str, offset: int) -> Column:
        frame = ordered.rangeBetween(W.unboundedPreceding, -offset)
        return F.coalesce(F.sum(source).over(frame), F.lit(0))

    sums = [
        (before(source, 1) - before(source, w + 1)).alias(name)
        for name, (source, w) in measures.items()
    ]
    return spread.select(key, "sec", "block", *sums).where(F.col("block") == own).drop("block")


def velocity_features(payments: DataFrame, controls: Controls, by_prefix: bool = True) -> DataFrame:
    """(customer_id, sec, velocity_1h, adjacent_prior_24h), one row per customer and second."""
    adjacent = (F.col("amount") >= controls.adjacent_low) & (F.col("amount") < controls.adjacent_high)
    per_second = payments.groupBy("customer_id", F.unix_seconds("timestamp").alias("sec")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(adjacent).alias("n_adjacent")
    )
    run = trailing_sums_by_prefix if by_prefix else trailing_sums
    return run(
        per_second,
        "customer_id",
        {
            "velocity_1h": ("n", controls.velocity_seconds),
            "adjacent_prior_24h": ("n_adjacent", controls.adjacent_seconds),
        },
    )


def first_payments(payments: DataFrame) -> DataFrame:
    """(customer_id, sec, first_id) of the first payment of every customer-counterparty pair.

    Order is (timestamp, transaction_id). A grouped minimum, merged before the shuffle.
    """
    return (
        payments.groupBy("customer_id", "counterparty_id")
        .agg(F.min(F.struct("timestamp", "transaction_id")).alias("first"))
        .select(
            "customer_id",
            F.unix_seconds("first.timestamp").alias("sec"),
            F.col("first.transaction_id").alias("first_id"),
        )
    )


def history_features(payments: DataFrame, controls: Controls, by_prefix: bool = True) -> DataFrame:
    """Payments with velocity_1h, adjacent_prior_24h and new_counterparty.

    ``transaction_id`` must be unique. Both joins spread a busy customer over its seconds.
    """
    velocity = velocity_features(payments, controls, by_prefix)
    firsts = first_payments(payments)
    return (
        payments.withColumn("sec", F.unix_seconds("timestamp"))
        .join(velocity, ["customer_id", "sec"])
        .withColumn("first_id", F.col("transaction_id"))
        .join(firsts.withColumn("new_counterparty", F.lit(1)), ["customer_id", "sec", "first_id"], "left")
        .withColumn("new_counterparty", F.coalesce("new_counterparty", F.lit(0)))
        .drop("sec", "first_id")
    )


def row_features(frame: DataFrame, controls: Controls) -> DataFrame:
    """Features that need only the row: ratio, risk geography, night."""
    return frame.withColumns(
        {
            "amount_ratio": F.try_divide("amount", "expected_amount"),
            "high_risk_geo": F.col("destination_country").isin(*controls.high_risk_countries).cast("int"),
            "night": (F.hour("timestamp") < 5).cast("int"),
        }
    )


def build_features(
    payments: DataFrame,
    customers: DataFrame,
    counterparties: DataFrame,
    screened: DataFrame,
    controls: Controls,
    check_keys: bool = True,
) -> DataFrame:
    """Payments joined to their three dimensions, with every feature of ``FEATURES``."""
    join = join_many_to_one if check_keys else DataFrame.join
    names = counterparties.select(
        "counterparty_id", "counterparty_name", "synthetic_sanctions_flag"
    )
    # Both counterparty sides meet first, so that payments are moved once for the two.
    beneficiaries = join(names, screened.drop("counterparty"), "counterparty_id")
    # The payments follow this side's parts, which are as many as the payments fill.
    beneficiaries = beneficiaries.repartition(tasks_for(payments.count()), "counterparty_id")
    joined = history_features(payments, controls)
    for dimension, key in ((customers, "customer_id"), (beneficiaries, "counterparty_id")):
        joined = join(joined, dimension, key)
    return (
        row_features(joined, controls)
        .withColumn(
            "new_counterparty_high_value",
            ((F.col("new_counterparty") == 1) & (F.col("amount_ratio") >= 2)).cast("int"),
        )
        .withColumn("screening_truth", F.col("synthetic_sanctions_flag").cast("int"))
        .drop("synthetic_sanctions_flag")
    )


def assert_no_leak(features: list[str]) -> None:
    leaked = FORBIDDEN.intersection(features)
    if leaked:
        raise ValueError(f"truth or identifier columns among the features: {sorted(leaked)}")
