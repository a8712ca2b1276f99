"""Registered queries: a function over ``Views`` and, where SQL can say it, the SQL to check it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.plans.sql_views import with_ctes
from riskweave.plans.views import Views
from riskweave.session import configure

DIGITS = 6


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    build: Callable[[Views], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, select: str | None = None, *ctes: str):
    """Register a function under its name. ``covers`` lists inventory ids."""

    def register(function):
        name = function.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        sql = None if select is None else with_ctes(select, *ctes)
        REGISTRY[name] = Query(name, covers, function, sql)
        return function

    return register


def comparable(frame: DataFrame) -> DataFrame:
    """Plain column types: rounded doubles, bigints, text for times and lists."""
    columns = []
    for field in frame.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("double", "float", "decimal"):
            column = F.round(column.cast("double"), DIGITS)
        elif kind in ("byte", "short", "integer"):
            column = column.cast("bigint")
        elif kind in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind == "array" and field.dataType.elementType.typeName() == "string":
            column = F.array_join(column, "|")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def runner(entry: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(entry.build(Views(configure(spark), folder)))

    return run


def r6(expression: str, name: str | None = None) -> str:
    """SQL: rounded as the query results are."""
    return f"round(({expression})::DOUBLE, {DIGITS}) AS {name or expression}"


def us(expression: str, name: str | None = None) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f') AS {name or expression}"


def day(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d') AS {name}"
