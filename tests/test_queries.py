"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from riskweave.plans import learning
from riskweave.plans.catalog import catalog
from riskweave.plans.registry import comparable
from riskweave.plans.views import Views
from riskweave.session import configure
from tests.compare import connect, difference
from tests.conftest import TINY

SQL = {name: sql for name, sql in oracle_sql().items() if name in catalog()}


@pytest.fixture(scope="module")
def con():
    return connect(TINY)


@pytest.fixture(scope="module")
def views(spark):
    """One set of views for all queries: scored payments are computed once, then read.

    Queries on features, rules and alert decisions still plan the whole chain themselves.
    """
    shared = Views(configure(spark), TINY)
    shared.__dict__["scored"] = shared.kept_scored
    return shared


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(name, spark, con, views):
    """And says something: nothing is compared with nothing."""
    def run(*_):
        return comparable(catalog()[name].build(views))

    assert con.execute(SQL[name]).fetchone() is not None
    assert difference(name, run, SQL[name], spark, con, TINY) is None


@pytest.mark.parametrize("name", ["alert_decisions", "alert_table", "fact_transactions"])
def test_query_agrees_with_sql_on_its_own(name, spark, con):
    assert difference(name, queries()[name], SQL[name], spark, con, TINY) is None


def test_entry_returns_rows(spark):
    frame = entry(spark)
    assert frame.count() == 30
    assert frame.columns == [
        "calendar_date", "transactions", "alerts", "payment_value_gbp", "average_risk_score"
    ]


def test_queries_without_sql_are_the_ones_sql_cannot_say():
    learned = {n for n, f in vars(learning).items() if callable(f)}
    rest = set(catalog()) - set(SQL) - learned
    assert rest == {"run_manifest_full", "rule_evidence_rows", "statistics_bundle"}


@pytest.mark.parametrize("name", ["run_manifest_full", "rule_evidence_rows", "statistics_bundle"])
def test_queries_without_sql_run(name, spark):
    assert queries()[name](spark, TINY).count() > 0
