"""Bins, changes, carried values, pivots and alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.projection import wide_by
from ..operators.series import change_since_previous_bin, last_per_bin, previous_bin_by_join
from ..operators.slices import carry_forward as carry
from ..plans.alarms import invocation_alarms
from ..plans.power import CONTROLLERS, heading, power_changes, power_output, wide_bins
from .base import decimals_to_double, derive, table, with_inputs

BIN = "date_trunc('hour', ts) + to_minutes(CAST((floor(minute(ts) / 10) + 1) * 10 AS BIGINT))"
BINS_SQL = f"""SELECT user_id, {BIN} AS bin, arg_max(value, event_id) AS value FROM events GROUP BY ALL"""


def _bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_per_bin(table(spark, sf_dir, "events"), ["user_id"], "ts", ["ts", "event_id"], ["value"])


def bin_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_since_previous_bin(_bins(spark, sf_dir), ["user_id"], ["value"])


def previous_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return previous_bin_by_join(_bins(spark, sf_dir), ["user_id"], "value")


# A third of the messages comes from one device.
SPARSE = """SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS device,
    CASE WHEN event_type IN ('click', 'error') THEN NULL ELSE value END AS value,
    CASE WHEN event_type = 'purchase' THEN props END AS detail FROM {events}"""
CARRY_SQL = """SELECT event_id, ts, device,
    last_value(value IGNORE NULLS) OVER w AS value, last_value(detail IGNORE NULLS) OVER w AS detail
    FROM src WINDOW w AS (PARTITION BY device ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carry(derive(spark, sf_dir, SPARSE), ["device"], ["ts", "event_id"], ["value", "detail"])


DAILY = """SELECT CAST(ts AS DATE) AS day, event_type, sum(CAST(value AS DECIMAL(18,4))) AS value
    FROM {events} GROUP BY CAST(ts AS DATE), event_type"""
KINDS = ["click", "error", "purchase", "signup", "view"]


def pivot_controllers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(wide_by(derive(spark, sf_dir, DAILY), ["day"], "event_type", KINDS, "value"))


READINGS = """SELECT 901 + user_id % 10 AS controller, ts,
    CASE WHEN event_type = 'error' THEN '0.00' ELSE CAST(value AS STRING) END AS reading FROM {events}"""


def power_by_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return power_output(power_changes(wide_bins(derive(spark, sf_dir, READINGS))))


def power_sql() -> str:
    latest = ", ".join(
        f"coalesce(max(CASE WHEN controller = {c} THEN CAST(reading AS DOUBLE) END), 0) AS c{c}" for c in CONTROLLERS
    )
    changes = ", ".join(
        f"""CASE WHEN bin - lag(bin) OVER w = INTERVAL 10 MINUTE THEN round(c{c} - lag(c{c}) OVER w, 2) ELSE 0.0 END
        AS "{heading(c)}\"""" for c in CONTROLLERS
    )
    return with_inputs(
        f"""WITH latest AS (SELECT controller, {BIN} AS bin, max(ts) AS ts, arg_max(reading, ts) AS reading FROM r
          WHERE controller <= 909 GROUP BY ALL),
        wide AS (SELECT bin, max(ts) AS polled_at, {latest} FROM latest GROUP BY bin)
        SELECT strftime(bin, '%d/%m/%Y %H:%M:00') AS "Time", {changes}, strftime(polled_at, '%Y') AS year,
        strftime(polled_at, '%m') AS month, strftime(polled_at, '%d') AS day FROM wide WINDOW w AS (ORDER BY bin)""",
        r=READINGS,
    )


CALLS = """SELECT event_type || CAST(user_id % 4 AS STRING) AS "FunctionName", ts, user_id % 3 AS "Invocations" FROM {events}"""
TEMPLATE = """SELECT CASE WHEN user_id % 4 = 3 THEN '      Runtime: ' ELSE '      FunctionName: ' END || event_type
    || CAST(user_id % 4 AS STRING) AS value FROM {events}"""


def alarm_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = derive(spark, sf_dir, CALLS.replace('"', "`"))
    return invocation_alarms(derive(spark, sf_dir, TEMPLATE), calls)


QUERIES = {
    "bin_delta": bin_delta,
    "previous_bin": previous_bin,
    "carry_forward": carry_forward,
    "pivot_controllers": pivot_controllers,
    "power_by_bin": power_by_bin,
    "alarm_daily": alarm_daily,
}
ORACLES = {
    "bin_delta": f"""SELECT user_id, bin, value, CASE WHEN bin - lag(bin) OVER w = INTERVAL 10 MINUTE
        THEN round(value - lag(value) OVER w, 2) ELSE 0.0 END AS value_change
        FROM ({BINS_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY bin)""",
    "previous_bin": f"""WITH b AS ({BINS_SQL}) SELECT b.user_id, b.bin, b.value, p.value AS previous_value FROM b
        LEFT JOIN b p ON p.user_id = b.user_id AND p.bin = b.bin - INTERVAL 10 MINUTE""",
    "carry_forward": with_inputs(CARRY_SQL, src=SPARSE),
    "pivot_controllers": with_inputs(
        "SELECT day, " + ", ".join(
            f"CAST(max(CASE WHEN event_type = '{k}' THEN value END) AS DOUBLE) AS \"{k}\"" for k in KINDS
        ) + " FROM d GROUP BY day",
        d=DAILY,
    ),
    "power_by_bin": power_sql(),
    "alarm_daily": with_inputs(
        """SELECT "FunctionName", CAST(ts AS DATE) AS day, CAST(sum("Invocations") AS BIGINT) AS total FROM calls
        WHERE "FunctionName" IN (SELECT replace(replace(value, 'FunctionName: ', ''), ' ', '') FROM template
          WHERE value LIKE '%FunctionName%')
        GROUP BY ALL HAVING sum("Invocations") >= 10""",
        calls=CALLS, template=TEMPLATE,
    ),
}
