"""Data contracts: keys, references, values, parity, and joins that assert their cardinality."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """Data that breaks a declared contract."""


def key_problems(frame: DataFrame, key: str) -> DataFrame:
    """(null_keys, duplicate_keys) of a key column, one row. Counts are merged map-side."""
    return (
        frame.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
            F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"),
        )
    )


def orphans(facts: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None) -> DataFrame:
    """Fact rows whose key is missing from the dimension."""
    keys = dimension.select(F.col(dimension_key or key).alias(key))
    return facts.join(keys, key, "left_anti")


def referenced(dimension: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Dimension rows that some fact refers to."""
    return dimension.join(facts.select(key), key, "left_semi")


def finite(column: str | Column) -> Column:
    """True for numbers other than NaN and the infinities."""
    value = F.col(column) if isinstance(column, str) else column
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def value_problems(payments: DataFrame) -> DataFrame:
    """Counts of bad amounts, missing times and other currencies, in one pass."""
    good_amount = F.coalesce(finite("amount") & (F.col("amount") > 0), F.lit(False))
    return payments.agg(
        F.count_if(~good_amount).alias("bad_amounts"),
        F.count_if(F.col("timestamp").isNull()).alias("missing_times"),
        F.count_if(~F.coalesce(F.col("currency") == "GBP", F.lit(False))).alias("other_currencies"),
    )


def _fail_if(counts: dict, what: str) -> None:
    found = {k: v for k, v in counts.items() if v}
    if found:
        raise ContractError(f"{what}: {found}")


def require_unique(frame: DataFrame, key: str) -> None:
    """Fail when a key is null or repeated."""
    _fail_if(key_problems(frame, key).first().asDict(), f"invalid key {key}")


def validate(customers: DataFrame, counterparties: DataFrame, payments: DataFrame) -> DataFrame:
    """Fail on the first broken contract; otherwise the one-row quality summary."""
    for frame, key in (
        (customers, "customer_id"), (counterparties, "counterparty_id"), (payments, "transaction_id"),
    ):
        require_unique(frame, key)
    for dimension, key in ((customers, "customer_id"), (counterparties, "counterparty_id")):
        if not orphans(payments, dimension, key).isEmpty():
            raise ContractError(f"orphan key {key}")
    _fail_if(value_problems(payments).first().asDict(), "invalid payments")
    return quality_summary(payments)


def quality_summary(payments: DataFrame) -> DataFrame:
    """Of payments that passed: records, total, and the two zeroes the contracts prove."""
    return payments.agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount_total"),
        F.lit(0).alias("orphan_keys"),
        F.lit(0).alias("duplicate_keys"),
    )


def join_many_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that fails when the right side repeats a key."""
    require_unique(right, key)
    return left.join(right, key)


def join_one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    require_unique(left, key)
    return join_many_to_one(left, right, key)


def totals_differ(left: DataFrame, right: DataFrame, column: str = "amount", tolerance: float = 0.01) -> DataFrame:
    """Row count and column total of both sides, and whether they disagree."""
    def side(frame, name):
        return frame.agg(
            F.count(F.lit(1)).alias(f"{name}_rows"),
            F.sum(F.col(column).cast("decimal(18,2)")).cast("double").alias(f"{name}_total"),
        ).withColumn("k", F.lit(1))

    return (
        side(left, "left")
        .join(side(right, "right"), "k")
        .drop("k")
        .withColumn(
            "differ",
            (F.col("left_rows") != F.col("right_rows"))
            | (F.abs(F.coalesce("left_total", F.lit(0.0)) - F.coalesce("right_total", F.lit(0.0))) > tolerance),
        )
    )


def parity(source: DataFrame, derived: DataFrame, log_tolerance: float = 1e-12) -> DataFrame:
    """Rows on which a derived payment table disagrees with its source.

    Ids must agree both ways, amounts exactly, log amounts within a relative tolerance, dates
    exactly. Empty when the two agree.
    """
    left = source.select("transaction_id", "amount", "timestamp").withColumn("in_source", F.lit(True))
    right = derived.select(
        "transaction_id", F.col("amount").alias("derived_amount"), "amount_log", "payment_date"
    ).withColumn("in_derived", F.lit(True))
    expected_log = F.log1p("amount")
    problem = (
        F.when(F.col("in_derived").isNull(), "MISSING_IN_DERIVED")
        .when(F.col("in_source").isNull(), "MISSING_IN_SOURCE")
        .when(~F.col("amount").eqNullSafe(F.col("derived_amount")), "AMOUNT")
        .when(F.abs(F.col("amount_log") - expected_log) > log_tolerance * F.abs(expected_log), "LOG_AMOUNT")
        .when(~F.col("payment_date").eqNullSafe(F.to_date("timestamp")), "DATE")
    )
    return (
        left.join(right, "transaction_id", "full_outer")
        .select("transaction_id", problem.alias("problem"))
        .where("problem is not null")
    )


def set_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values on one side only, with the side they are on."""
    def values(frame, side):
        return frame.select(column).distinct().withColumn(side, F.lit(True))

    return (
        values(left, "in_left")
        .join(values(right, "in_right"), column, "full_outer")
        .where("in_left is null or in_right is null")
        .select(column, F.when(F.col("in_left").isNull(), "right").otherwise("left").alias("only_in"))
    )


@dataclass(frozen=True)
class Constraint:
    """One declared table constraint: kind is primary, unique, not_null or foreign."""

    kind: str
    table: str
    column: str
    parent: str = ""
    parent_column: str = ""

    @property
    def name(self) -> str:
        target = f"->{self.parent}.{self.parent_column}" if self.parent else ""
        return f"{self.kind}:{self.table}.{self.column}{target}"


def _targets(constraints: list[Constraint]) -> dict[tuple[str, str], list[Constraint]]:
    """Key columns to group, each with the foreign keys that point to it."""
    found: dict[tuple[str, str], list[Constraint]] = {}
    for c in constraints:
        if c.kind == "foreign":
            found.setdefault((c.parent, c.parent_column), []).append(c)
        elif c.kind in ("primary", "unique"):
            found.setdefault((c.table, c.column), [])
    return found


def check_constraints(tables: dict[str, DataFrame], constraints: list[Constraint]) -> DataFrame:
    """(constraint, violations) for every constraint.

    Each table is read once. Its rows are stacked to (target, key, slot): a key column's own values
    (slot 0) and the values of every foreign key that points to it (slots 1, 2, ..) meet in one aggregate
    by (target, key), merged before the shuffle. A key is repeated if slot 0 has several rows, and lost
    if it has none. Null keys are a group like any other, which counts the nulls.
    """
    spark = next(iter(tables.values())).sparkSession
    targets = _targets(constraints)
    slots = max([len(f) for f in targets.values()], default=0) + 1
    entries: dict[str, list[Column]] = {}

    def entry(table: str, column: str, target: int, slot: int) -> None:
        entries.setdefault(table, []).append(F.struct(
            F.lit(target).alias("target"), F.col(column).cast("string").alias("key"), F.lit(slot).alias("slot")
        ))

    place = {}
    for k, ((table, column), foreign) in enumerate(targets.items()):
        place[table, column] = (k, 0)
        entry(table, column, k, 0)
        for slot, c in enumerate(foreign, 1):
            place[c.table, c.column] = (k, slot)
            entry(c.table, c.column, k, slot)
    # Columns that only may not be null are targets of their own.
    for c in constraints:
        if c.kind == "not_null" and (c.table, c.column) not in place:
            place[c.table, c.column] = (len(place) + len(targets), 0)
            entry(c.table, c.column, *place[c.table, c.column])
    stacked = [tables[t].select(F.explode(F.array(*found)).alias("e")).select("e.*") for t, found in entries.items()]
    keys = reduce(DataFrame.unionByName, stacked).groupBy("target", "key").agg(
        *(F.count_if(F.col("slot") == k).alias(f"s{k}") for k in range(slots))
    )
    known = F.col("key").isNotNull()
    sums = keys.groupBy("target").agg(
        F.count_if(known & (F.col("s0") > 1)).alias("repeated"),
        *(F.sum(F.when(~known, F.col(f"s{k}"))).alias(f"null{k}") for k in range(slots)),
        *(F.sum(F.when(known & (F.col("s0") == 0), F.col(f"s{k}"))).alias(f"lost{k}") for k in range(1, slots)),
    )
    wanted = []
    for c in constraints:
        target, slot = place[c.table, c.column]
        if c.kind == "foreign":
            target = list(targets).index((c.parent, c.parent_column))
            slot = 1 + targets[c.parent, c.parent_column].index(c)
        wanted.append((c.name, c.kind, target, slot))
    rows = spark.createDataFrame(wanted, "constraint string, kind string, target int, slot int")

    def pick(name: str, first: int) -> Column:
        cases = [F.when(F.col("slot") == k, F.col(f"{name}{k}")) for k in range(first, slots)]
        return F.coalesce(*cases, F.lit(0))

    count = (
        F.when(F.col("kind") == "primary", F.col("repeated") + pick("null", 0))
        .when(F.col("kind") == "unique", F.col("repeated"))
        .when(F.col("kind") == "not_null", pick("null", 0))
        .otherwise(pick("lost", 1) if slots > 1 else F.lit(0))
    )
    # One row a constraint; a table without rows has no group.
    return rows.join(sums, "target", "left").select(
        "constraint", F.coalesce(count, F.lit(0)).cast("bigint").alias("violations")
    )
