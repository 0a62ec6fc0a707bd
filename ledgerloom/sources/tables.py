"""Tables by name, parameterised names, snapshots and schema discovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.projection import MappingRow, apply_mapping

# The stem of the per-gateway table names.
GATEWAY_TABLE = "sms_companyname_db_gateway_{gateway}_{country}_{part}"


def catalog_table(spark: SparkSession, name: str, mapping: Sequence[MappingRow] | None = None) -> DataFrame:
    """A table of the catalog, pruned and cast by a mapping list if one is given."""
    df = spark.table(name)
    return apply_mapping(df, mapping) if mapping else df


def split_gateway_key(key: str) -> tuple[str, str]:
    """`gateway_country` to its two parts."""
    gateway, country = key.split("_")[:2]
    return gateway, country


def gateway_table(spark: SparkSession, key: str, part: str, mapping: Sequence[MappingRow]) -> DataFrame:
    """One of a gateway's tables (`cust`, `cust_data`, `info`); the job argument names it."""
    gateway, country = split_gateway_key(key)
    name = GATEWAY_TABLE.format(gateway=gateway, country=country, part=part)
    return apply_mapping(spark.sql("SELECT * FROM IDENTIFIER(:t)", args={"t": name}), mapping)


def where_equal(df: DataFrame, **values: object) -> DataFrame:
    """Chained equality filters; all of them reach the scan."""
    for name, value in values.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def jdbc_table(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read in parallel ranges of a numeric or date column."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=column, lowerBound=str(lower),
            upperBound=str(upper), numPartitions=str(partitions), **options,
        )
        .load()
    )


def merged_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Files of one table whose columns differ, under their merged schema."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def discover_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Registers exported files as a table whose schema is read off the files."""
    schema = merged_parquet(spark, path).schema
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return spark.table(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Stores the query under a name, replacing an older one."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
