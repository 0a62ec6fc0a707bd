"""Inputs derived from the test tables.

A derived input is one SQL text that both engines read the same way. `{name}`
stands for a test table. What is computed from the input is stated twice, by the
library and by the oracle.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read off the file once per process; a later read
    that is given the schema starts no job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    names = {name for _, name, _, _ in Formatter().parse(text) if name}
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in names})


def sql(text: str) -> str:
    """The derivation as DuckDB reads it."""
    names = {name for _, name, _, _ in Formatter().parse(text) if name}
    return text.format(**{name: name for name in names})


def with_inputs(body: str, **inputs: str) -> str:
    """An oracle over derived inputs, which become its named subqueries."""
    ctes = ",\n".join(f"{name} AS ({sql(text)})" for name, text in inputs.items())
    joiner = ",\n" if body.lstrip().startswith("WITH ") else "\n"
    rest = body.lstrip()[5:] if joiner == ",\n" else body
    return f"WITH {ctes}{joiner}{rest}"


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Exact decimal sums leave as doubles, so that both engines give the same bits."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
