"""Fixed schemas of the given tables and of the entities built on them."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TABLES = {
    "region": _schema("r_regionkey INT, r_name STRING"),
    "nation": _schema("n_nationkey INT, n_name STRING, n_regionkey INT"),
    "customer": _schema(
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "part": _schema(
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
        " p_retailprice DOUBLE"
    ),
    "events": _schema(
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,"
        " props STRING"
    ),
}

CUSTOMERS = _schema(
    "customer_id BIGINT, account_id STRING, account_age_days INT, customer_type STRING,"
    " residence_country STRING, industry STRING, risk_segment STRING, kyc_status STRING,"
    " pep_flag BOOLEAN, expected_monthly_volume INT, expected_amount DOUBLE,"
    " expected_min DOUBLE, expected_max DOUBLE"
)
COUNTERPARTIES = _schema(
    "counterparty_id BIGINT, counterparty_name STRING, aliases STRING, country STRING,"
    " counterparty_type STRING, baseline_risk STRING, synthetic_sanctions_flag BOOLEAN"
)
WATCHLIST = _schema(
    "entity_id BIGINT, canonical_name STRING, aliases STRING, country STRING,"
    " entity_type STRING, sanctions_program STRING, source STRING, active BOOLEAN"
)
PAYMENTS = _schema(
    "transaction_id STRING, customer_id BIGINT, counterparty_id BIGINT, timestamp TIMESTAMP,"
    " amount DOUBLE, currency STRING, origin_country STRING, destination_country STRING,"
    " payment_channel STRING, payment_type STRING, payment_category STRING, device_id STRING,"
    " originating_bank STRING, network STRING, beneficiary_bank STRING, status STRING,"
    " injected_pattern STRING, investigation_label INT"
)
REVIEW_ACTIONS = _schema(
    "action_id BIGINT, alert_id STRING, status STRING, actor STRING, notes STRING,"
    " disposition STRING, reason_code STRING, acted_at TIMESTAMP"
)
