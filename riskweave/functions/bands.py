"""Bands, categories and match methods as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Left-closed amount bands; each label covers [low, next low).
AMOUNT_BANDS = (
    (0, "01 | <500"),
    (500, "02 | 500-999"),
    (1000, "03 | 1k-2.5k"),
    (2500, "04 | 2.5k-5k"),
    (5000, "05 | 5k-10k"),
    (10000, "06 | 10k+"),
)
# Risk categories; each holds scores up to and including its limit.
RISK_CATEGORIES = ((1, "LOW", 39), (2, "MEDIUM", 69), (3, "HIGH", 100))


def _as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def amount_band(amount) -> Column:
    value = _as_column(amount)
    lows = [low for low, _ in AMOUNT_BANDS]
    band = F.lit(None).cast("string")
    for (low, label), high in reversed(list(zip(AMOUNT_BANDS, lows[1:] + [None], strict=True))):
        inside = (value >= low) if high is None else (value >= low) & (value < high)
        band = F.when(inside, label).otherwise(band)
    return band


def risk_key(score) -> Column:
    """Right-closed: (-1, 39], (39, 69], (69, 100]."""
    value = _as_column(score)
    low, medium, high = (limit for _, _, limit in RISK_CATEGORIES)
    return (
        F.when((value > -1) & (value <= low), 1)
        .when((value > low) & (value <= medium), 2)
        .when((value > medium) & (value <= high), 3)
    )


def risk_band(score) -> Column:
    value = _as_column(score)
    return F.when(value >= 70, "HIGH").when(value >= 40, "MEDIUM").otherwise("LOW")


def score_band(score) -> Column:
    """Ten-point band, the last one holding 90 to 100."""
    return F.least(F.floor(_as_column(score) / 10) * 10, F.lit(90)).cast("int")


def match_method(alias_match, name_similarity) -> Column:
    return (
        F.when(_as_column(alias_match), "Alias")
        .when(_as_column(name_similarity) == 100, "Exact")
        .otherwise("Fuzzy candidate")
    )


def flag(condition) -> Column:
    return _as_column(condition).cast("int")
