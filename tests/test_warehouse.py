import datetime
import re
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from riskweave.operators import aggregates, contracts, marts, measures, warehouse
from riskweave.plans.views import Views
from riskweave.schemas import WATCHLIST
from riskweave.sources import files, publication, sinks
from tests.conftest import TINY


@pytest.fixture(scope="module")
def views(spark):
    return Views(spark, TINY)


@pytest.fixture(scope="module")
def star(views):
    return views.star


def test_publishing_is_staged_and_repeatable(spark, views, star, tmp_path):
    root = str(tmp_path / "warehouse")
    first = warehouse.publish(star, root, views.payments)
    totals = warehouse.read_published(spark, root, "fact_transactions").agg(F.count("*"), F.sum("amount")).first()
    second = warehouse.publish(star, root, views.payments)
    assert first != second and warehouse.published(spark, root)["version"] == second
    again = warehouse.read_published(spark, root, "fact_transactions").agg(F.count("*"), F.sum("amount")).first()
    assert totals == again
    broken = dict(star)
    broken["dim_date"] = star["dim_date"].where("day <> 3")
    with pytest.raises(contracts.ContractError, match="date_key"):
        warehouse.publish(broken, root, views.payments)
    with pytest.raises(contracts.ContractError, match="reconcile"):
        warehouse.publish(star, root, views.payments.limit(10))
    assert warehouse.published(spark, root)["version"] == second


def test_constraints_find_each_kind_of_violation(star):
    assert len([c for c in warehouse.STAR_CONSTRAINTS if c.kind == "foreign"]) == 11
    assert len([c for c in warehouse.STAR_CONSTRAINTS if c.kind == "primary"]) == 8
    broken = dict(star)
    broken["dim_risk_category"] = star["dim_risk_category"].union(star["dim_risk_category"])
    used = star["fact_transactions"].agg(F.min("origin_geography_key")).first()[0]
    broken["dim_geography"] = star["dim_geography"].where(F.col("geography_key") != used)
    broken["fact_screening_alerts"] = star["fact_screening_alerts"].withColumn("transaction_id", F.lit("nope"))
    found = {r.constraint for r in contracts.check_constraints(broken, warehouse.STAR_CONSTRAINTS)
             .where("violations > 0").collect()}
    assert found == {
        "primary:dim_risk_category.risk_key", "unique:dim_risk_category.risk_category",
        "foreign:fact_transactions.origin_geography_key->dim_geography.geography_key",
        "foreign:fact_transactions.destination_geography_key->dim_geography.geography_key",
        "foreign:fact_screening_alerts.transaction_id->fact_transactions.transaction_id",
    }


def test_star_sql_agrees_with_the_frames(spark, star):
    by_sql = files.run_sql(spark, warehouse.OPERATIONS_SQL, star).first()
    by_frame = aggregates.operations_summary(star["fact_transactions"]).first()
    assert by_sql == by_frame
    daily = files.run_sql(spark, warehouse.DAILY_SQL, star).count()
    assert daily == star["dim_date"].count()


def test_facts_have_the_declared_columns(star):
    assert len(star["fact_transactions"].columns) == 24
    assert len(star["fact_screening_alerts"].columns) == 16
    assert star["fact_transactions"].schema["amount"].dataType.simpleString() == "decimal(18,2)"


def test_mart_widths(views):
    assert len(views.marts["fact_transactions"].columns) == 33
    assert len(views.marts["fact_screening_alerts"].columns) == 23
    assert len(views.marts["dim_counterparty"].columns) == 16


def test_alerts_without_rules_have_no_bridge_row(spark):
    frame = spark.createDataFrame([("A", "X|Y"), ("B", ""), ("C", None)], "alert_id string, rules_triggered string")
    assert sorted(tuple(r) for r in marts.alert_rules_bridge(frame).collect()) == [("A", "X"), ("A", "Y")]


def small_model(spark):
    keys = "customer_key int, counterparty_key int, date_key int, origin_geography_key int," \
           " destination_geography_key int, channel_key int, risk_key int"
    ones = (1, 1, 1, 1, 1)
    return {
        "fact_transactions": spark.createDataFrame(
            [(*ones, 1, 1, 10.0, 0), (*ones, 1, 3, 20.0, 1), (*ones, 2, 1, 70.0, 0)],
            keys + ", risk_score double, screening_review int",
        ).withColumn("screening_truth", F.lit(0)),
        "fact_screening_alerts": spark.createDataFrame(
            [("A", *ones, 1, 3, 80.0, "OPEN"), ("B", *ones, 1, 3, 10.0, "OPEN")],
            "alert_id string, " + keys + ", risk_score double, status string",
        ),
        "bridge_alert_rules": spark.createDataFrame([("A", "X"), ("A", "Y")], "alert_id string, rule_name string"),
        "dim_payment_channel": spark.createDataFrame([(1, "web"), (2, "api")], "channel_key int, payment_channel string"),
        "dim_risk_category": spark.createDataFrame([(1, "LOW"), (3, "HIGH")], "risk_key int, risk_category string"),
    }


def test_measures_follow_blank_rules(spark):
    tables = small_model(spark)
    names = ["Transactions Screened", "Alert Rate", "High-Risk Alerts", "Average Risk Score", "Screening TP",
             "Screening FP", "Screening Precision", "Closed Alerts", "Rule Alerts"]
    row = measures.measure_by(tables, names).first()
    assert row["Transactions Screened"] == 3 and row["Alert Rate"] == pytest.approx(2 / 3)
    assert row["High-Risk Alerts"] == 1 and row["Rule Alerts"] == 2 and row["Closed Alerts"] == 0
    assert row["Screening TP"] is None and row["Screening FP"] == 1 and row["Screening Precision"] is None
    by = measures.measure_by(tables, ["Alert Rate"], ("dim_payment_channel", "payment_channel")).collect()
    assert [(r.group_value, r["Alert Rate"]) for r in by] == [("web", 1.0)]
    filtered = measures.measure_by(tables, names, filters={("dim_payment_channel", "payment_channel"): ["api"]}).first()
    assert filtered["Transactions Screened"] == 1 and filtered["Rule Alerts"] is None
    average = measures.measure_by(tables, ["Average Risk Score"], ("dim_risk_category", "risk_category"))
    assert {r.group_value: r["Average Risk Score"] for r in average.collect()} == {"LOW": 40.0, "HIGH": 20.0}


def test_every_measure_is_there():
    assert len(measures.MEASURES) == 38
    assert sum(len(page) for page in measures.VISUALS.values()) == 21


def test_findings_are_one_wide_row(spark):
    frame = spark.createDataFrame([("cramers_v", 0.1), ("spearman_rho", 0.3), ("other", 9.0)], "metric string, value double")
    row = marts.statistical_findings(frame).first()
    assert row.cramers_v == 0.1 and row.spearman_rho == 0.3 and row.ci_lower is None and row.interpretation


def test_feature_names_lose_their_group(spark):
    frame = spark.createDataFrame([("numeric__night",), ("category__kyc_status_PENDING",)], "feature string")
    assert [r.feature for r in marts.plain_feature_names(frame).collect()] == ["night", "kyc_status_PENDING"]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    frame = spark.createDataFrame(
        [(1, datetime.date(2024, 1, 2), ["a", "b"], 0.1, None)], "k int, d date, l array<string>, x double, s string"
    )
    sinks.write_csv(frame, path)
    row = spark.read.csv(path, header=True).first()
    assert (row.k, row.d, row.l, row.x) == ("1", "2024-01-02", "a|b", "0.1")


def test_csv_scan_fills_blanks(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text(
        "entity_id,canonical_name,aliases,country,entity_type,sanctions_program,source,active\n1,Some Name,,GB,BUSINESS,P,S,true\n"
    )
    row = files.read_csv_blank(spark, str(path), WATCHLIST).first()
    assert row.aliases == "" and row.active is True and row.entity_id == 1


def test_parquet_and_metric_sinks_replace_their_target(spark, tmp_path):
    for value in (1, 2):
        frame = spark.createDataFrame([(value,)], "v int")
        sinks.write_parquet(frame, str(tmp_path / "p"))
        sinks.write_metrics(frame, str(tmp_path / "j"))
    assert files.read_parquet(spark, str(tmp_path / "p")).first().v == 2
    assert spark.read.json(str(tmp_path / "j")).first().v == 2


def test_manifest_digest_ignores_order_and_layout(spark, tmp_path):
    frame = spark.range(100).select("id", (F.col("id") * 2).alias("x"))
    shuffled = frame.orderBy(F.desc("id")).repartition(7)
    other = frame.where("id <> 5")
    manifest = {r.table: r for r in sinks.table_manifest({"a": frame, "b": shuffled, "c": other}).collect()}
    assert manifest["a"].digest == manifest["b"].digest != manifest["c"].digest
    assert (manifest["a"].rows, manifest["a"].columns) == (100, 2)
    exported = sinks.export_tables({"a": frame}, str(tmp_path)).first()
    assert exported.digest == manifest["a"].digest
    assert spark.read.csv(str(tmp_path / "a"), header=True).count() == 100


def test_two_publishers_never_hide_each_other(spark, star, views, tmp_path):
    """Both started from the same log: both versions are in it, in an order that no clock decides."""
    root = str(tmp_path / "warehouse")
    small = {name: star[name] for name in ("dim_risk_category", "dim_payment_channel")}
    first = warehouse.publish(small, root)
    with ThreadPool(6) as pool:
        versions = pool.map(lambda _: warehouse.publish(small, root), range(6))
    log = publication.entries(spark, f"{root}/published")
    assert log == list(range(1, 8))
    assert {publication.read(spark, f"{root}/published", n)["version"] for n in log} == {first, *versions}
    assert warehouse.published(spark, root)["number"] == 7


def test_a_load_built_on_an_older_version_fails(spark, star, tmp_path):
    root = str(tmp_path / "warehouse")
    small = {"dim_risk_category": star["dim_risk_category"]}
    warehouse.publish(small, root, after=0)
    second = warehouse.publish(small, root, after=1)
    with pytest.raises(publication.PublicationConflict):
        warehouse.publish(small, root, after=1)
    assert warehouse.published(spark, root)["version"] == second


def test_an_entry_is_made_once(spark, tmp_path):
    folder = str(tmp_path / "log")
    assert publication.entries(spark, folder) == []
    assert publication.put_if_absent(spark, folder, 1, {"version": "a"})
    assert not publication.put_if_absent(spark, folder, 1, {"version": "b"})
    assert publication.read(spark, folder, 1) == {"version": "a"} and publication.entries(spark, folder) == [1]


def test_constraints_read_each_table_once(spark, star, tmp_path):
    paths = {}
    for name, frame in star.items():
        frame.write.parquet(f"{tmp_path}/{name}")
        paths[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = contracts.check_constraints(paths, warehouse.STAR_CONSTRAINTS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == len(star)


def test_nulls_and_empty_tables_in_constraints(spark):
    kinds = [
        contracts.Constraint("primary", "p", "k"), contracts.Constraint("unique", "p", "u"), contracts.Constraint("not_null", "f", "k"),
        contracts.Constraint("foreign", "f", "k", "p", "k"), contracts.Constraint("not_null", "p", "v"), contracts.Constraint("foreign", "f", "j", "p", "k"),
    ]
    tables = {
        "p": spark.createDataFrame([(1, "a", None), (2, None, 1), (2, None, 1), (None, "b", 1)], "k int, u string, v int"),
        "f": spark.createDataFrame([(1, 1), (None, None), (9, 2), (9, 1)], "k long, j long"),
    }
    found = {r.constraint: r.violations for r in contracts.check_constraints(tables, kinds).collect()}
    assert found == {
        "primary:p.k": 2, "unique:p.u": 0, "not_null:f.k": 1, "foreign:f.k->p.k": 2, "not_null:p.v": 1, "foreign:f.j->p.k": 0,
    }
    empty = {name: frame.limit(0) for name, frame in tables.items()}
    assert {r.violations for r in contracts.check_constraints(empty, kinds).collect()} == {0}
    assert contracts.check_constraints(empty, kinds).count() == len(kinds)


def test_a_page_scans_each_fact_once(spark, views, tmp_path):
    """And gives what the measures give one visual at a time, filtered or not."""
    tables = {}
    for name, frame in views.marts.items():
        frame.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    channel = tables["dim_payment_channel"].first()["payment_channel"]
    for page, visuals in measures.VISUALS.items():
        for filters in (None, {("dim_payment_channel", "payment_channel"): [channel]}):
            whole = measures.page_visuals(tables, page, filters)
            got = sorted((r.visual, str(r.group_value), round(r.value, 6)) for r in whole.collect())
            want = sorted(
                (name, str(r.group_value), round(r[measure], 6))
                for name, (measure, table, column) in visuals.items()
                for r in measures.measure_by(tables, [measure], (table, column), filters).collect()
            )
            assert got == want, page
        whole = measures.page_visuals(tables, page)
        whole.collect()
        plan = whole._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        facts = {measures.MEASURES[m].table for measure, _, _ in visuals.values() for m in measures.base_measures([measure])}
        assert len(re.findall(r"FileScan[^\n]*(?:risk_score|screening_review|disposition|hour_utc|amount_band|status)", plan)) <= len(facts)
