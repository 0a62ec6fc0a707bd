"""Rows per second of column functions against row-at-a-time Python functions.

usage: python tools/compare_udf_forms.py [SF_DIR]
"""

from __future__ import annotations

import sys
import time
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.functions import dates, labels, texts  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402

def forms() -> dict:
    """Each Python form returns what its column function returns for these inputs."""
    return {
        "ip prefix": ("ip", texts.ip_prefix("ip", 3), lambda v: ".".join(v.split(".")[:3]), "string"),
        "timestamp text": (
            "stamp", dates.parse_timestamp("stamp"), lambda v: datetime.strptime(v, "%Y-%m-%d %H:%M:%S.%f"), "timestamp_ntz",
        ),
        "day-first date": (
            "day", dates.day_first_date("day"), lambda v: datetime.strptime(v, "%d/%m/%Y").date(), "date",
        ),
        "connection type": ("ip", labels.connection_type("ip"), lambda v: "3g" if v else "wifi", "string"),
        "show hour label": (
            "hhmm", labels.show_hour_label("hhmm"),
            lambda v: f"0{v // 100}:00AM" if v < 1200 else f"{v // 100 - 12}:00PM", "string",
        ),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "local[8]", spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.concat_ws(".", "l_linenumber", "l_suppkey", "l_partkey", F.lit("1")).alias("ip"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("stamp"),
        F.date_format("l_shipdate", "d/M/yyyy").alias("day"),
        ((F.col("l_suppkey") % 24) * 100 + F.col("l_linenumber")).cast("int").alias("hhmm"),
    ).repartition(8).cache()
    n = rows.count()
    for name, (source, built_in, python, kind) in forms().items():
        by_row = F.udf(python, kind)(source)
        assert rows.where(~built_in.eqNullSafe(by_row)).count() == 0, name
        speed = []
        for column in (built_in, by_row):
            took = []
            for _ in range(3):
                start = time.perf_counter()
                rows.select(F.max(F.hash(column))).collect()
                took.append(time.perf_counter() - start)
            speed.append(n / sorted(took)[1])
        print(f"{name}: built-in {speed[0]:,.0f} rows/s, Python {speed[1]:,.0f} rows/s")


if __name__ == "__main__":
    main()
