"""Invocation alarms for the functions that a template names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.texts import strip_label
from ..operators.measures import daily_alarms

# Fixed values.
LABEL = "FunctionName"
INVOKE_LIMIT = 10


def function_names(lines: DataFrame, line: str = "value") -> DataFrame:
    """Names on the template's lines that hold the label."""
    return lines.where(F.col(line).contains(LABEL)).select(
        strip_label(line, LABEL + ": ").alias("FunctionName")
    )


def invocation_alarms(lines: DataFrame, invocations: DataFrame, limit: int = INVOKE_LIMIT) -> DataFrame:
    """(FunctionName, day, total) that reach the limit, for the named functions only."""
    named = invocations.join(function_names(lines), "FunctionName", "left_semi")
    return daily_alarms(named, "FunctionName", "ts", "Invocations", limit)
