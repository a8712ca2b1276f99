import pytest
from pyspark.sql import functions as F

from riskweave.config import Controls
from riskweave.operators import contracts, features
from riskweave.operators.features import prepare_payments
from riskweave.plans.views import Views
from tests.conftest import TINY


@pytest.fixture(scope="module")
def frames(spark):
    v = Views(spark, TINY)
    return v.customers.persist(), v.counterparties.persist(), v.payments.persist()


def broken(payments, column, value):
    target = F.col("transaction_id") == "TX-000000007"
    kind = payments.schema[column].dataType
    return payments.withColumn(column, F.when(target, F.lit(value).cast(kind)).otherwise(F.col(column)))


def test_valid_payments_give_the_summary(frames):
    row = contracts.validate(*frames).first()
    assert (row.orphan_keys, row.duplicate_keys, row.records) == (0, 0, frames[2].count())


@pytest.mark.parametrize(
    "column, value",
    [
        ("customer_id", -1),
        ("counterparty_id", -1),
        ("transaction_id", "TX-000000008"),
        ("transaction_id", None),
        ("amount", -5.0),
        ("amount", float("inf")),
        ("amount", float("nan")),
        ("amount", None),
        ("currency", "USD"),
        ("timestamp", None),
    ],
)
def test_each_broken_payment_is_refused(frames, column, value):
    customers, counterparties, payments = frames
    with pytest.raises(contracts.ContractError):
        contracts.validate(customers, counterparties, broken(payments, column, value))


def test_many_to_one_join_refuses_a_repeated_key(frames):
    customers, _, payments = frames
    with pytest.raises(contracts.ContractError):
        contracts.join_many_to_one(payments, customers.unionByName(customers), "customer_id")
    with pytest.raises(contracts.ContractError):
        contracts.join_one_to_one(payments, customers, "customer_id")


def test_feature_joins_refuse_a_repeated_dimension_key(spark, frames):
    customers, counterparties, payments = frames
    screened = Views(spark, TINY).screened
    kept = features.build_features(payments, customers, counterparties, screened, Controls())
    assert kept.count() == payments.count()
    with pytest.raises(contracts.ContractError, match="counterparty_id"):
        features.build_features(payments, customers, counterparties, screened.union(screened), Controls())


def test_parity_names_each_kind_of_difference(spark, at):
    source = spark.createDataFrame(
        [("a", 1.0, at(0)), ("b", 2.0, at(0)), ("c", 3.0, at(0)), ("d", 4.0, at(0)), ("e", 5.0, at(0))],
        "transaction_id string, amount double, timestamp timestamp",
    )
    same = prepare_payments(source)
    assert contracts.parity(source, same).isEmpty()
    key = F.col("transaction_id")
    changed = (
        same.where("transaction_id <> 'e'")
        .withColumn("amount", F.when(key == "a", 9.0).otherwise(F.col("amount")))
        .withColumn("amount_log", F.when(key == "b", 9.0).otherwise(F.col("amount_log")))
        .withColumn("payment_date", F.when(key == "c", F.to_date(F.lit("1999-01-01"))).otherwise(F.col("payment_date")))
        .withColumn("transaction_id", F.when(key == "d", "x").otherwise(key))
    )
    found = {r.transaction_id: r.problem for r in contracts.parity(source, changed).collect()}
    assert found == {
        "a": "AMOUNT", "b": "LOG_AMOUNT", "c": "DATE", "d": "MISSING_IN_DERIVED",
        "e": "MISSING_IN_DERIVED", "x": "MISSING_IN_SOURCE",
    }


def test_key_problems_counts_null_rows(spark):
    frame = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert tuple(contracts.key_problems(frame, "k").first()) == (2, 1)
