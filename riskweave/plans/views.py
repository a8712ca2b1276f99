"""The frames that queries start from, derived from the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.config import Controls
from riskweave.operators import alerts as alert_ops
from riskweave.operators import cases as case_ops
from riskweave.operators import features, marts, rules, screening, warehouse
from riskweave.session import materialise
from riskweave.sources import adapters
from riskweave.sources.files import read_table

CONTROLS = Controls(high_risk_countries=adapters.RISK_COUNTRIES)
# The default one-hour window holds too few of the given events for the velocity rule to fire.
DAY_CONTROLS = CONTROLS.with_(velocity_seconds=86_400)
MODEL_THRESHOLD = 0.6

# Review actions given to the alerts of the given tables, by alert number modulo six:
# (pattern, step, status, actor, notes, disposition, reason_code).
REVIEW_STEPS = [
    (0, 1, "IN_REVIEW", "ana", "looked at it", None, None),
    (0, 2, "CLOSED", "ana", "nothing found", "FALSE_POSITIVE", "RC-1"),
    (1, 1, "CLOSED", "bo", "closed at once", "CLEARED", "RC-2"),
    (2, 1, "IN_REVIEW", "bo", "looked at it", None, None),
    (2, 2, "ESCALATED", "bo", "needs a second look", None, None),
    (2, 3, "IN_REVIEW", "cy", "disposition too early", "CLEARED", None),
    (3, 1, "IN_REVIEW", "cy", "looked at it", None, None),
    (3, 2, "CLOSED", "cy", "reason left out", "CLEARED", None),
    (3, 3, "ESCALATED", " ", "actor left out", None, None),
    (5, 1, "IN_REVIEW", "ana", "looked at it", None, None),
    (5, 2, "ESCALATED", "ana", "needs a second look", None, None),
    (5, 3, "IN_REVIEW", "bo", "second look", None, None),
    (5, 4, "CLOSED", "bo", "settled", "CLEARED", "RC-3"),
    (5, 5, "IN_REVIEW", "cy", "opened again", None, None),
]


def stand_in_probability(frame: DataFrame) -> DataFrame:
    """A fixed score in place of a trained one, so that results can be checked in SQL."""
    return frame.withColumn(
        "model_probability", F.try_divide(F.col("amount_ratio"), F.col("amount_ratio") + 10)
    )


class Views:
    """Frames over one folder of the given tables; each is planned when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, controls: Controls = CONTROLS):
        self.spark, self.folder, self.controls = spark, folder, controls

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    @cached_property
    def customers(self) -> DataFrame:
        return adapters.customers(self.spark, self.folder)

    @cached_property
    def counterparties(self) -> DataFrame:
        return adapters.counterparties(self.spark, self.folder)

    @cached_property
    def watchlist(self) -> DataFrame:
        return adapters.watchlist(self.spark, self.folder)

    @cached_property
    def all_payments(self) -> DataFrame:
        return adapters.payments(self.spark, self.folder)

    @cached_property
    def payments(self) -> DataFrame:
        """Payments with a positive amount."""
        return features.positive_amounts(self.all_payments)

    @cached_property
    def screened(self) -> DataFrame:
        return screening.screen_counterparties(
            self.counterparties, self.watchlist, self.controls.screening_threshold
        )

    @cached_property
    def featured(self) -> DataFrame:
        # Keys of the derived dimensions are unique; the contract queries check them.
        return features.build_features(
            self.payments, self.customers, self.counterparties, self.screened, self.controls,
            check_keys=False,
        )

    @cached_property
    def ruled(self) -> DataFrame:
        return rules.apply_rules(self.featured, self.controls)

    @cached_property
    def scored(self) -> DataFrame:
        return alert_ops.combined_alert(stand_in_probability(self.ruled), MODEL_THRESHOLD)

    @cached_property
    def kept_scored(self) -> DataFrame:
        """Scored payments computed once, for queries that read them several times."""
        return materialise(self.scored)

    @cached_property
    def alerts(self) -> DataFrame:
        return alert_ops.alert_rows(self.kept_scored, self.controls)

    @cached_property
    def review_actions(self) -> DataFrame:
        steps = self.spark.createDataFrame(
            REVIEW_STEPS,
            "pattern bigint, step bigint, status string, actor string, notes string,"
            " disposition string, reason_code string",
        )
        number = F.expr("cast(substring(transaction_id, 4) as bigint)")
        return (
            self.alerts.select("alert_id", "created_at", number.alias("number"))
            .withColumn("pattern", F.col("number") % 6)
            .join(F.broadcast(steps), "pattern")
            .select(
                (F.col("number") * 10 + F.col("step")).alias("action_id"),
                "alert_id", "status", "actor", "notes", "disposition", "reason_code",
                F.timestamp_micros(F.unix_micros("created_at") + F.col("step") * 3_600_000_000).alias("acted_at"),
            )
        )

    @cached_property
    def reviewed(self) -> tuple[DataFrame, DataFrame]:
        """(audit, refused actions)."""
        return case_ops.apply_actions(self.alerts, self.review_actions)

    @cached_property
    def cases(self) -> DataFrame:
        return case_ops.case_snapshot(self.alerts, self.reviewed[0])

    @cached_property
    def kept_cases(self) -> DataFrame:
        return materialise(self.cases)

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return warehouse.build_star(
            self.customers, self.counterparties, self.payments, self.kept_scored, self.kept_cases,
            self.controls.high_risk_countries,
        )

    @cached_property
    def marts(self) -> dict[str, DataFrame]:
        """The reporting model: enriched dimensions, both facts, the rule bridge."""
        star = dict(self.star)
        fact = star["fact_transactions"]
        alerts = marts.alerts_mart(self.kept_cases, fact, self.payments, check=False)
        geography = star.pop("dim_geography")
        return star | marts.role_geographies(geography) | {
            "dim_counterparty": marts.enriched_counterparties(
                star["dim_counterparty"], self.counterparties, self.screened, check=False
            ),
            "fact_transactions": marts.transactions_mart(fact, self.kept_scored, check=False),
            "fact_screening_alerts": alerts,
            "bridge_alert_rules": marts.alert_rules_bridge(alerts),
        }
