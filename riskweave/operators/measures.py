"""Named measures over the marts, by any dimension attribute, under shared filters.

Every fact is aggregated on its own and only the grouped results are joined, so no measure
across facts ever multiplies rows. As in the BI model, a count of nothing is blank (null),
sums skip blanks, and a ratio with a blank or zero denominator is blank.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRANSACTIONS, ALERTS, BRIDGE = "fact_transactions", "fact_screening_alerts", "bridge_alert_rules"
COMPARISON, FINDINGS = "model_comparison", "statistical_findings"

# dimension -> (its key, the column of both facts that refers to it)
DIMENSIONS = {
    "dim_customer": ("customer_key", "customer_key"),
    "dim_counterparty": ("counterparty_key", "counterparty_key"),
    "dim_date": ("date_key", "date_key"),
    "dim_origin_geography": ("geography_key", "origin_geography_key"),
    "dim_destination_geography": ("geography_key", "destination_geography_key"),
    "dim_payment_channel": ("channel_key", "channel_key"),
    "dim_risk_category": ("risk_key", "risk_key"),
}
FACT_KEYS = [column for _, column in DIMENSIONS.values()]


@dataclass(frozen=True)
class Measure:
    """An aggregate over one table, or a formula over other measures."""

    table: str = ""
    aggregate: Callable[[], Column] | None = None
    parts: tuple[str, ...] = ()
    formula: Callable[..., Column] | None = None


def _rows(table: str, condition: Callable[[], Column] | None = None, blank: bool = True) -> Measure:
    def aggregate():
        n = F.count(F.lit(1)) if condition is None else F.count_if(condition())
        return (F.nullif(n, F.lit(0)) if blank else n).cast("double")

    return Measure(table, aggregate)


def _of(table: str, function, column: str) -> Measure:
    return Measure(table, lambda: function(F.col(column)).cast("double"))


def _plus(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)))


def _share(numerator: str, other: str) -> Measure:
    return Measure(parts=(numerator, other), formula=lambda a, b: F.try_divide(a, _plus(a, b)))


def _cell(review: int, truth: int) -> Measure:
    return _rows(
        TRANSACTIONS,
        lambda: (F.col("screening_review") == review) & (F.col("screening_truth") == truth),
    )


def _status(status: str) -> Measure:
    return _rows(ALERTS, lambda: F.col("status") == status, blank=False)


def _boosted(column: str) -> Measure:
    return Measure(
        COMPARISON,
        lambda: F.max(F.when(F.col("model") == BOOSTED, F.col(column))).cast("double"),
    )


BOOSTED = "GradientBoosting"

# Names and definitions of the 38 measures.
MEASURES: dict[str, Measure] = {
    "Transactions Screened": _rows(TRANSACTIONS),
    "Review Alerts": _rows(ALERTS),
    "Alert Rate": Measure(parts=("Review Alerts", "Transactions Screened"), formula=F.try_divide),
    "High-Risk Alerts": _rows(ALERTS, lambda: F.col("risk_score") >= 70),
    "Average Risk Score": _of(TRANSACTIONS, F.avg, "risk_score"),
    "Total Amount GBP": _of(TRANSACTIONS, F.sum, "amount"),
    "Average Amount GBP": Measure(
        parts=("Total Amount GBP", "Transactions Screened"), formula=F.try_divide
    ),
    "Average Velocity": _of(TRANSACTIONS, F.avg, "velocity_1h"),
    "Velocity Spike Payments": _rows(TRANSACTIONS, lambda: F.col("velocity_1h") >= 4),
    "Unusual-Time Payments": _rows(TRANSACTIONS, lambda: F.col("night") == 1),
    "Screening Alerts": _rows(TRANSACTIONS, lambda: F.col("screening_review") == 1),
    "Screening TP": _cell(1, 1),
    "Screening FP": _cell(1, 0),
    "Screening FN": _cell(0, 1),
    "Screening TN": _cell(0, 0),
    "Screening Precision": _share("Screening TP", "Screening FP"),
    "Screening Recall": _share("Screening TP", "Screening FN"),
    "Screening F1": Measure(
        parts=("Screening Precision", "Screening Recall"),
        formula=lambda p, r: F.try_divide(2 * p * r, _plus(p, r)),
    ),
    "Screening FPR": _share("Screening FP", "Screening TN"),
    "Screening FNR": _share("Screening FN", "Screening TP"),
    "Open Alerts": _status("OPEN"),
    "In Review Alerts": _status("IN_REVIEW"),
    "Escalated Alerts": _status("ESCALATED"),
    "Closed Alerts": _status("CLOSED"),
    "Reviewed False Positives": _rows(
        ALERTS, lambda: F.col("disposition") == "FALSE_POSITIVE", blank=False
    ),
    "Reviewed FP Share": Measure(
        parts=("Reviewed False Positives", "Closed Alerts"), formula=F.try_divide
    ),
    "Average Case Age at Cutoff": _of(ALERTS, F.avg, "age_at_data_cutoff_days"),
    "Rule Alerts": _rows(BRIDGE),
    "XGBoost Threshold": _boosted("threshold"),
    "Test TP": _boosted("tp"),
    "Test FP": _boosted("fp"),
    "Test FN": _boosted("fn"),
    "Test TN": _boosted("tn"),
    "Cramers V": _of(FINDINGS, F.max, "cramers_v"),
    "Rank Biserial": _of(FINDINGS, F.max, "rank_biserial"),
    "Spearman Rho": _of(FINDINGS, F.max, "spearman_rho"),
    "Wilson Lower": _of(FINDINGS, F.max, "ci_lower"),
    "Wilson Upper": _of(FINDINGS, F.max, "ci_upper"),
}

Filters = dict[tuple[str, str], list]


def base_measures(names: list[str]) -> list[str]:
    """The plain aggregates a list of measures is made of, each once."""
    found: list[str] = []
    for name in names:
        parts = MEASURES[name].parts
        for base in base_measures(list(parts)) if parts else [name]:
            if base not in found:
                found.append(base)
    return found


def evaluate(name: str) -> Column:
    """A measure as a column over its already aggregated parts."""
    measure = MEASURES[name]
    if not measure.parts:
        return F.col(f"`{name}`")
    return measure.formula(*[evaluate(p) for p in measure.parts])


def filtered_facts(tables: dict[str, DataFrame], filters: Filters) -> dict[str, DataFrame]:
    """Facts under the selected dimension values; facts do not filter each other."""
    facts = {n: tables[n] for n in (TRANSACTIONS, ALERTS) if n in tables}
    for (dimension, column), values in filters.items():
        key, fact_key = DIMENSIONS[dimension]
        chosen = tables[dimension].where(F.col(column).isin(values)).select(F.col(key).alias(fact_key))
        facts = {n: f.join(chosen, fact_key, "left_semi") for n, f in facts.items()}
    if BRIDGE in tables:
        bridge = tables[BRIDGE]
        if ALERTS in facts:
            bridge = bridge.join(facts[ALERTS].select("alert_id", *FACT_KEYS), "alert_id")
        facts[BRIDGE] = bridge
    for single in (COMPARISON, FINDINGS):
        if single in tables:
            facts[single] = tables[single]
    return facts


def measure_by(
    tables: dict[str, DataFrame],
    measures: list[str],
    by: tuple[str, str] | None = None,
    filters: Filters | None = None,
) -> DataFrame:
    """Measures per value of one column of a dimension or fact, or over everything.

    Groups in which every measure is blank are left out.
    """
    facts = filtered_facts(tables, filters or {})
    bases: dict[str, list[str]] = {}
    for name in base_measures(measures):
        bases.setdefault(MEASURES[name].table, []).append(name)
    results = []
    for table, names in bases.items():
        aggregates = [MEASURES[n].aggregate().alias(n) for n in names]
        frame = facts[table]
        if by is None:
            results.append(frame.agg(*aggregates).withColumn("group_value", F.lit("all")))
            continue
        dimension, column = by
        if dimension in DIMENSIONS and table != dimension:
            key, fact_key = DIMENSIONS[dimension]
            labels = tables[dimension].select(F.col(key).alias(fact_key), F.col(column).alias("group_value"))
            grouped = frame.groupBy(fact_key).agg(*_partials(names)).join(labels, fact_key)
            results.append(grouped.groupBy("group_value").agg(*_finals(names)))
        else:
            results.append(frame.groupBy(F.col(column).alias("group_value")).agg(*aggregates))
    joined = reduce(lambda a, b: a.join(b, "group_value", "full_outer"), results)
    values = joined.select("group_value", *[evaluate(m).alias(m) for m in measures])
    if by is None:
        return values.drop("group_value")
    return values.where(F.coalesce(*[F.col(f"`{m}`") for m in measures]).isNotNull())


def _partials(names: list[str]) -> list[Column]:
    """Per dimension key: what is needed to finish every base measure after the join."""
    out = []
    for n in names:
        if n.startswith("Average"):
            column = _AVERAGED[n]
            out += [F.sum(F.col(column).cast("double")).alias(f"{n}__sum"), F.count(column).alias(f"{n}__n")]
        else:
            out.append(MEASURES[n].aggregate().alias(n))
    return out


def _finals(names: list[str]) -> list[Column]:
    return [
        F.try_divide(F.sum(f"`{n}__sum`"), F.sum(f"`{n}__n`")).alias(n)
        if n.startswith("Average")
        else F.sum(f"`{n}`").alias(n)
        for n in names
    ]


_AVERAGED = {
    "Average Risk Score": "risk_score",
    "Average Velocity": "velocity_1h",
    "Average Case Age at Cutoff": "age_at_data_cutoff_days",
}

# Grouped visuals per report page: name -> (measure, table, column).
VISUALS: dict[str, dict[str, tuple[str, str, str]]] = {
    "executive": {
        "alerts_by_day": ("Review Alerts", "dim_date", "calendar_date"),
        "alerts_by_risk_category": ("Review Alerts", "dim_risk_category", "risk_category"),
        "alerts_by_status": ("Review Alerts", ALERTS, "status"),
        "alerts_by_channel": ("Review Alerts", "dim_payment_channel", "payment_channel"),
        "alerts_by_origin": ("Review Alerts", "dim_origin_geography", "country_code"),
        "alerts_by_destination": ("Review Alerts", "dim_destination_geography", "country_code"),
    },
    "screening": {
        "payments_by_score_band": ("Transactions Screened", TRANSACTIONS, "screening_score_band"),
        "reviews_by_match_method": ("Screening Alerts", "dim_counterparty", "match_method"),
        "alerts_by_baseline_risk": ("Review Alerts", "dim_counterparty", "baseline_risk"),
        "alerts_by_rule": ("Rule Alerts", BRIDGE, "rule_name"),
    },
    "payment": {
        "payments_by_amount_band": ("Transactions Screened", TRANSACTIONS, "amount_band"),
        "high_risk_by_destination": ("High-Risk Alerts", "dim_destination_geography", "country_code"),
        "alert_rate_by_channel": ("Alert Rate", "dim_payment_channel", "payment_channel"),
        "payments_by_type": ("Transactions Screened", TRANSACTIONS, "payment_type"),
        "payments_by_hour": ("Transactions Screened", TRANSACTIONS, "hour_utc"),
        "unusual_time_by_day": ("Unusual-Time Payments", "dim_date", "calendar_date"),
    },
    "investigation": {
        "alerts_by_status": ("Review Alerts", ALERTS, "status"),
        "alerts_by_disposition": ("Review Alerts", ALERTS, "disposition"),
        "alerts_by_day": ("Review Alerts", "dim_date", "calendar_date"),
    },
    "statistics": {
        "payments_by_amount_band": ("Transactions Screened", TRANSACTIONS, "amount_band"),
        "alert_rate_by_destination": ("Alert Rate", "dim_destination_geography", "country_code"),
    },
}


def _grouped_once(tables: dict[str, DataFrame], frame: DataFrame, table: str, axes: list[tuple[str, str]], names: list[str]) -> DataFrame:
    """(axis, group_value, base measures) of one fact by every axis, from one scan: a grouping set an axis.

    Rows are merged by key before they meet their dimension. A key without a row there is left out.
    """
    by_dimension = [(d, c) for d, c in axes if d in DIMENSIONS and d != table]
    keys = list(dict.fromkeys(DIMENSIONS[d][1] if (d, c) in by_dimension else c for d, c in axes))
    grouped = frame.groupingSets([[F.col(k)] for k in keys], *keys).agg(F.grouping_id().alias("set"), *_partials(names))
    # A set's id has a one for every key that it leaves out.
    ids = {k: (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i)) for i, k in enumerate(keys)}
    value = F.coalesce(*(F.when(F.col("set") == ids[k], F.col(k).cast("string")) for k in keys))
    merged = grouped.select("set", value.alias("value"), *[c for c in grouped.columns if c not in (*keys, "set")])
    own = [(F.col("set") == ids[c], f"{d}.{c}") for d, c in axes if (d, c) not in by_dimension]
    axis = F.coalesce(F.lit(None).cast("string"), *(F.when(here, F.lit(name)) for here, name in own))
    rows = merged.withColumn("axis", axis).withColumn("group_value", F.col("value"))
    if by_dimension:
        labels = reduce(DataFrame.unionByName, [
            tables[d].select(
                F.lit(ids[DIMENSIONS[d][1]]).cast("long").alias("set"), F.col(DIMENSIONS[d][0]).cast("string").alias("value"),
                F.lit(f"{d}.{c}").alias("named"), F.col(c).cast("string").alias("label"),
            )
            for d, c in by_dimension
        ])
        rows = rows.join(labels, ["set", "value"], "left").withColumn("group_value", F.when(F.col("axis").isNull(), F.col("label")).otherwise(F.col("value")))
        rows = rows.withColumn("axis", F.coalesce("axis", "named"))
    return rows.where("axis is not null").groupBy("axis", "group_value").agg(*_finals(names))


def page_visuals(tables: dict[str, DataFrame], page: str, filters: Filters | None = None) -> DataFrame:
    """All grouped visuals of a page as (visual, group_value, value) rows; each fact is scanned once."""
    facts = filtered_facts(tables, filters or {})
    wanted: dict[str, tuple[list, list]] = {}
    for measure, dimension, column in VISUALS[page].values():
        for name in base_measures([measure]):
            axes, names = wanted.setdefault(MEASURES[name].table, ([], []))
            axes += [(dimension, column)] * ((dimension, column) not in axes)
            names += [name] * (name not in names)
    if not filters and BRIDGE in wanted and all(d == BRIDGE for d, _ in wanted[BRIDGE][0]):
        facts[BRIDGE] = tables[BRIDGE]  # its rows come from the alerts: without filters they need not be met again
    results = [_grouped_once(tables, facts[t], t, axes, names) for t, (axes, names) in wanted.items()]
    bases = [n for _, names in wanted.values() for n in names]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
    # A group comes once a fact, so the largest of its values is the only one.
    together = together.groupBy("axis", "group_value").agg(*(F.max(f"`{n}`").alias(n) for n in bases))
    rows = F.explode(F.array(*(
        F.struct(F.lit(name).alias("visual"), F.when(F.col("axis") == f"{d}.{c}", evaluate(measure)).alias("value"))
        for name, (measure, d, c) in VISUALS[page].items()
    )))
    return together.select("group_value", rows.alias("v")).select("v.visual", "group_value", "v.value").where("value is not null")


def amount_risk_points(transactions: DataFrame) -> DataFrame:
    """Scatter of amount against rule score, summed per payment."""
    return transactions.groupBy("transaction_id").agg(
        F.sum("amount").cast("double").alias("amount"), F.sum("risk_score").cast("double").alias("risk_score")
    )


def screening_details(tables: dict[str, DataFrame]) -> DataFrame:
    """Detail table: an alert's screening evidence and current status."""
    evidence = tables["dim_counterparty"].select(
        "counterparty_key", "counterparty_name", "screening_score", "matched_entity",
        "name_similarity_score", F.array_join("reason_codes", "|").alias("reason_codes"),
    )
    return (
        tables[ALERTS].select("transaction_id", "counterparty_key", "status")
        .join(evidence, "counterparty_key")
        .drop("counterparty_key")
    )


def case_explorer(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "alert_id", "transaction_id", "risk_score", "rules_triggered", "status", "age_at_data_cutoff_days"
    )
