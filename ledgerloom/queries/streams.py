"""Streams over the events, run until what has arrived is processed."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import utc_instant
from ..plans.power import CONTROLLERS, power_output
from ..plans.telemetry import delivery_text, flat_messages
from ..session import scratch_dir
from ..sinks.files import with_date_parts
from ..streaming.carrying import carry_in_batches, read_carried
from ..streaming.closing import land_and_close, with_closings
from ..streaming.runs import file_stream, finish, in_cycles, to_table
from ..streaming.telemetry import alarm_stream, bin_changes, closed_bins
from .base import table, with_inputs
from .series import BIN, BINS_SQL, CARRY_SQL, READINGS, SPARSE, power_sql


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_stream(spark, sf_dir, table(spark, sf_dir, "events").schema, name_filter="events.parquet")


def _with_time(stream: DataFrame) -> DataFrame:
    """A watermark needs a timestamp with a zone; the session's is UTC."""
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _derived(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text, events=_arriving(spark, sf_dir))


def _landed(spark: SparkSession, stream: DataFrame, label: str, partition_by: tuple = ()) -> str:
    path = scratch_dir(spark, label)
    finish(to_table(stream, f"{path}/table", f"{path}/checkpoint", partition_by))
    return f"{path}/table"


def _closed(
    messages: DataFrame, ts: str, made: Callable[[DataFrame], DataFrame], label: str, width: timedelta = timedelta(minutes=10),
    partition_by: tuple = (),
) -> str:
    """Lands what is made of the messages, the bins that were open at their end included."""
    path = scratch_dir(messages.sparkSession, label)
    known = with_closings(messages, ts, f"{path}/closings")
    land_and_close(
        made(known), known, ts, f"{path}/closings", f"{path}/table", f"{path}/checkpoint", width, partition_by=partition_by
    )
    return f"{path}/table"


def _plain_bin(df: DataFrame) -> DataFrame:
    return df.withColumn("bin", F.col("bin").cast("timestamp_ntz"))


def _bins_again(spark: SparkSession, path: str) -> DataFrame:
    return file_stream(spark, path, spark.read.parquet(path).schema)


def stream_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.sum(F.col("value").cast("decimal(18,4)"))

    def bins(messages: DataFrame) -> DataFrame:
        return closed_bins(messages, ["user_id"], "ts", {"total": total, "n": F.count("*")})

    landed = spark.read.parquet(_closed(_with_time(_arriving(spark, sf_dir)), "ts", bins, "stream-bins"))
    return _plain_bin(landed).withColumn("total", F.col("total").cast("double"))


def stream_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins close in one stream; a second one joins each with the bin before."""
    last = F.max_by("value", F.struct("ts", "event_id"))
    path = _closed(
        _with_time(_arriving(spark, sf_dir)), "ts", lambda m: closed_bins(m, ["user_id"], "ts", {"value": last}), "stream-last"
    )
    changed = _closed(_bins_again(spark, path), "bin", lambda b: bin_changes(b, ["user_id"], ["value"]), "stream-delta")
    return _plain_bin(spark.read.parquet(changed))


def stream_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the messages comes from one device, so they are filled by slices."""
    arriving, path = _derived(spark, sf_dir, SPARSE), scratch_dir(spark, "stream-carry")
    finish(
        carry_in_batches(arriving, f"{path}/table", f"{path}/checkpoint", "device", ["ts", "event_id"], ["value", "detail"])
    )
    return read_carried(spark, f"{path}/table", arriving.schema)


def stream_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide bins close in one stream; a second one writes their changes by the poll's day."""
    names = [f"c{c}" for c in CONTROLLERS]
    latest = {
        f"c{c}": F.coalesce(
            F.max_by("reading", F.when(F.col("controller") == c, F.col("ts"))).try_cast("double"), F.lit(0.0)
        )
        for c in CONTROLLERS
    }
    polled = {**latest, "polled_at": F.max("ts").cast("timestamp_ntz")}
    readings = _with_time(_derived(spark, sf_dir, READINGS)).where(F.col("controller").isin(CONTROLLERS))
    path = _closed(readings, "ts", lambda m: closed_bins(m, [], "ts", polled), "power-bins")

    def output(bins: DataFrame) -> DataFrame:
        changes = bin_changes(bins, [], names, ["polled_at"])
        return power_output(
            changes.select(F.col("bin").cast("timestamp_ntz").alias("bin"), "polled_at", *[F.col(f"{n}_change").alias(n) for n in names])
        )

    wide = _bins_again(spark, path)
    landed = _closed(wide, "bin", output, "power", partition_by=("year", "month", "day"))
    return spark.read.schema(output(wide).schema).parquet(landed)


def stream_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = _arriving(spark, sf_dir).withColumn("ts", utc_instant("ts"))
    landed = _closed(
        calls, "ts", lambda c: alarm_stream(c, "event_type", "ts", F.col("user_id") % 3), "stream-alarm", timedelta(days=1)
    )
    return spark.read.parquet(landed)


def stream_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that come in three deliveries, one a cycle, each cycle's written by its days."""
    path = scratch_dir(spark, "cycles")
    for third in range(3):
        part = table(spark, sf_dir, "events").where(F.col("event_id") % 3 == third)
        with_date_parts(part.select("event_id", "ts", "value"), "ts").coalesce(1).write.mode("append").parquet(f"{path}/in")
    arriving = file_stream(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema, files_per_trigger=1)
    in_cycles(
        arriving, f"{path}/out", f"{path}/checkpoint", "1 second", lambda cycles: len(cycles) == 3, ("year", "month", "day")
    )
    whole = T.StructType([*arriving.schema.fields, T.StructField("cycle", T.LongType())])
    return spark.read.schema(whole).parquet(f"{path}/out").drop("cycle")


BODIES = """SELECT '{{"Resources":{{"ID":"' || CAST(user_id AS STRING) || '","Created":"' ||
    replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T') || '.000Z","Data":{{"energy":{{"unit":"kWh","value":' ||
    CAST(event_id AS STRING) || '.5}}}},"Topic":"' || event_type || '"}}}}' AS body FROM {events}"""


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_messages(_derived(spark, sf_dir, BODIES), "body")
    sent = flat.select("ResourcesID", "created", delivery_text(flat).alias("text"))
    return spark.read.parquet(_landed(spark, sent, "stream-messages"))


SHIFTED = "(date_trunc('second', ts) + INTERVAL 8 HOUR)"
QUERIES = {
    "stream_bins": stream_bins,
    "stream_delta": stream_delta,
    "stream_carry": stream_carry,
    "stream_power": stream_power,
    "stream_alarm": stream_alarm,
    "stream_cycles": stream_cycles,
    "stream_messages": stream_messages,
}
ORACLES = {
    "stream_bins": f"""SELECT user_id, {BIN} AS bin, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total,
        COUNT(*) AS n FROM events GROUP BY ALL""",
    "stream_delta": f"""SELECT user_id, bin, value, CASE WHEN bin - lag(bin) OVER w = INTERVAL 10 MINUTE
        THEN round(value - lag(value) OVER w, 2) ELSE 0.0 END AS value_change
        FROM ({BINS_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY bin)""",
    "stream_carry": with_inputs(CARRY_SQL, src=SPARSE),
    "stream_power": power_sql(),
    "stream_cycles": """SELECT event_id, ts, value, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
        strftime(ts, '%d') AS day FROM events""",
    "stream_alarm": """SELECT event_type, CAST(ts AS DATE) AS day, CAST(sum(user_id % 3) AS BIGINT) AS total FROM events
        GROUP BY ALL HAVING sum(user_id % 3) >= 10""",
    "stream_messages": f"""SELECT CAST(user_id AS VARCHAR) AS "ResourcesID", {SHIFTED} AS created,
        '&DeviceID=' || CAST(user_id AS VARCHAR) || '&DateTimestamp=' ||
        strftime(date_trunc('hour', {SHIFTED}) + to_minutes(CAST((floor(minute(ts) / 10) + 1) * 10 AS BIGINT))
          + to_seconds(CAST(floor(second(ts)) AS BIGINT)), '%Y-%m-%dT%H:%M:%S')
        || '&ms1=kWh&ms2=' || CAST(event_id AS VARCHAR) || '.5'
        || (SELECT string_agg('&ms' || CAST(i AS VARCHAR) || '=NULL', '' ORDER BY i) FROM range(3, 49) t(i))
        || '&ms49=' || event_type AS text FROM events""",
}
