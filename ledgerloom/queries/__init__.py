"""Every operator and job over the test tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import catalogues, cleansing, feeds, files, joins, sales, series, streams, tickets

MODULES = [tickets, sales, joins, cleansing, files, feeds, catalogues, series, streams]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
