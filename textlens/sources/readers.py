"""Inputs: Parquet, CSV with a declared schema, small in-memory tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = False
) -> DataFrame:
    """CSV with a header row. The schema is declared, so there is no pass over the data to infer it.

    ``multiline`` allows line breaks inside quoted fields, but makes each file one task.
    """
    reader = spark.read.schema(schema).option("header", True).option("multiLine", multiline)
    return reader.option("escape", '"').csv(path)


def read_lexicon(spark: SparkSession, path: str, separator: str = "\t") -> DataFrame:
    """A lexicon file of token and valence, further fields ignored; quotes are ordinary characters."""
    reader = spark.read.schema("token string, valence double").option("sep", separator)
    return reader.option("quote", "").option("mode", "PERMISSIVE").csv(path)


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def inline_table(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: str) -> DataFrame:
    """A small table from driver values."""
    return spark.createDataFrame(list(rows), schema)
