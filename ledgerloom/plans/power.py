"""Controller power: readings per cycle, one column per controller, change per bin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.series import change_since_previous_bin, last_per_bin
from ..sinks.files import with_date_parts

# Fixed values.
CONTROLLERS = list(range(901, 910))
TIME_LAYOUT = "dd/MM/yyyy HH:mm:00"


def heading(controller: int) -> str:
    return f"{controller} Total system power {{kW}}"


def wide_bins(readings: DataFrame, controllers: list[int] = CONTROLLERS) -> DataFrame:
    """One row per bin with a column per controller; an absent reading counts 0.00.

    `readings` holds (controller, ts, reading). `polled_at` is the latest poll in
    the bin, whose day names the output folder.
    """
    wanted = readings.where(F.col("controller").isin(controllers))
    latest = last_per_bin(wanted, ["controller"], "ts", ["ts"], ["ts", "reading"])
    value = {
        f"c{c}": F.coalesce(
            F.max(F.when(F.col("controller") == c, F.col("reading").try_cast("double"))), F.lit(0.0)
        )
        for c in controllers
    }
    return latest.groupBy("bin").agg(
        F.max("ts").alias("polled_at"), *[agg.alias(name) for name, agg in value.items()]
    )


def power_changes(wide: DataFrame, controllers: list[int] = CONTROLLERS) -> DataFrame:
    """Change of every controller since the bin before, 0.00 where that bin is absent."""
    names = [f"c{c}" for c in controllers]
    changed = change_since_previous_bin(wide, [], names)
    return changed.select("bin", "polled_at", *[F.col(f"{n}_change").alias(n) for n in names])


def power_output(changes: DataFrame, controllers: list[int] = CONTROLLERS) -> DataFrame:
    """Output columns with their headings, and the folder columns of the poll's day."""
    return with_date_parts(changes, "polled_at").select(
        F.date_format("bin", TIME_LAYOUT).alias("Time"),
        *[F.col(f"c{c}").alias(heading(c)) for c in controllers],
        "year", "month", "day",
    )
