"""Readers with declared schemas, and SQL text run over registered tables."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskweave.schemas import TABLES


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, with its declared schema where there is one."""
    return read_parquet(spark, f"{folder}/{name}.parquet", TABLES.get(name))


def read_csv_blank(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header; missing text becomes the empty string."""
    frame = spark.read.schema(schema).csv(path, header=True)
    text = [f.name for f in schema.fields if f.dataType.typeName() == "string"]
    return frame.na.fill("", subset=text)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """The rule list of a control document as rows."""
    document = spark.read.json(path, multiLine=True)
    return document.select(F.explode("rules").alias("rule")).select("rule.*")


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run SQL text with the given frames visible under their names."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(text.strip().rstrip(";"))


def run_sql_file(spark: SparkSession, path: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    return run_sql(spark, Path(path).read_text(encoding="utf-8"), tables)
