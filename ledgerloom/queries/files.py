"""Files and tables written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.texts import strip_label
from ..operators.projection import with_headings
from ..operators.sets import append_all
from ..plans import ticket_rollups as rollups
from ..plans.feeds import export_range
from ..plans.film import SCHEMA, write_films
from ..plans.snapshots import archive_and_reload, retention
from ..session import scratch_dir
from ..sinks import files as file_sinks
from ..sinks.tables import append_table, portfolio_table, write_all
from ..sources import files
from ..sources.tables import merged_parquet
from .base import derive, table, with_inputs
from .tickets import KEYS, ROLLUP_INPUTS, SHOWN_SQL, grain


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with and without a header row, read back in part."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = scratch_dir(spark, "csv")
    file_sinks.csv_with_header(customers, f"{path}/with")
    file_sinks.csv_without_header(customers, f"{path}/without", ["c_acctbal", "c_custkey"])
    left = files.csv_columns(spark, f"{path}/with", customers.schema, ["c_custkey", "c_mktsegment"])
    right = spark.read.schema("c_acctbal double, c_custkey long").csv(f"{path}/without")
    return left.join(right, "c_custkey")


def latin_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes and line ends; letters that Latin-1 does not have are
    masked first, as the file could not hold them."""
    texts = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.regexp_replace("text", "[^\\x00-\\xFF]", "?").alias("text"),
    )
    path = scratch_dir(spark, "latin")
    texts.write.options(header=True, quote='"', escape='"', encoding="iso-8859-1").csv(path)
    back = files.latin_csv(spark, path, texts.schema)
    return back.select("doc_id", F.length("text").alias("n"), F.md5("text").alias("digest"))


SHEET = T.StructType(
    [
        T.StructField("Item Number", T.LongType()),
        T.StructField("Day", T.StringType()),
        T.StructField("Store", T.StringType()),
        T.StructField("Sales Qty", T.DoubleType()),
    ]
)


def sheet_skip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets of 5,000 rows each, every one with four lines before its header line."""
    orders = table(spark, sf_dir, "orders")
    sheet = F.floor(F.col("o_orderkey") / 5000).alias("sheet")
    rows = orders.select(
        sheet, F.col("o_orderkey").alias("seq"),
        F.concat_ws(",", "o_orderkey", F.date_format("o_orderdate", "d/M/yyyy"), F.lit('"a, b"'), "o_totalprice").alias("line"),
    )
    top = [F.lit("Report,,,"), F.lit("Sheet,Sales,,"), F.lit(",,,"), F.lit("1,2,3,4"), F.lit("Item Number,Day,Store,Sales Qty")]
    preamble = orders.select(sheet).distinct().select(
        "sheet", F.posexplode(F.array(*top)).alias("pos", "line")
    ).select("sheet", (F.col("pos") - 10).cast("bigint").alias("seq"), "line")
    path = scratch_dir(spark, "sheets")
    (
        rows.unionByName(preamble).repartition("sheet").sortWithinPartitions("sheet", "seq")
        .select("sheet", "line").write.partitionBy("sheet").text(path)
    )
    return files.sheet_export(spark, f"{path}/sheet=*", SHEET, ["Item Number", "Day", "Sales Qty"])


def text_lines_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the whole texts that hold a word, without the word and blanks, counted."""
    path = scratch_dir(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    lines = files.text_lines(spark, path, "and ")
    return lines.select(strip_label("value", "and ").alias("line")).groupBy("line").agg(F.count("*").alias("n"))


def schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    path = scratch_dir(spark, "merge")
    part.where("p_size <= 25").select("p_partkey", "p_name").write.parquet(f"{path}/export=1")
    part.where("p_size > 25").select("p_partkey", "p_name", "p_retailprice").write.parquet(f"{path}/export=2")
    return merged_parquet(spark, path).select("p_partkey", "p_name", "p_retailprice", "export")


def snapshot_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current orders archived under their day, then replaced by a later snapshot."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch_dir(spark, "snapshot")
    orders.write.parquet(f"{path}/current")
    fresh = orders.where("o_orderstatus <> 'P'").withColumn("o_orderstatus", F.lit("N"))
    current = archive_and_reload(spark, f"{path}/current", f"{path}/archive", "2020-07-09", fresh)
    archived = spark.read.parquet(f"{path}/archive")
    return append_all([current, archived])


MANIFEST = """SELECT 'companyname-' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderstatus = 'F' THEN '-other'
    ELSE '-reporting' END AS "name", o_orderdate AS created FROM {orders}"""


def retention_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = derive(spark, sf_dir, MANIFEST.replace('"', "`"))
    return retention(manifest, "1998-01-06 00:00:00", "name", "created")


def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    path = scratch_dir(spark, "dated")
    file_sinks.dated_parquet(events, path, "ts")
    schema = T.StructType([*events.schema.fields, *[T.StructField(c, T.StringType()) for c in ("year", "month", "day")]])
    return spark.read.schema(schema).parquet(path)


def multi_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables of one prepared rollup under their published headings, read back as one
    list of totals."""
    path = scratch_dir(spark, "rollups")
    outputs = {
        "byday": lambda df: with_headings(rollups.rollup_day(df), rollups.DAY_HEADINGS),
        "hourly": lambda df: with_headings(rollups.rollup_day_hour(df), rollups.HOURLY_HEADINGS),
        "showtime": lambda df: with_headings(rollups.rollup_show(df), rollups.SHOW_HEADINGS),
    }
    write_all(grain(spark, sf_dir), outputs, lambda df, name: df.write.parquet(f"{path}/{name}"))
    totals = []
    for name in outputs:
        amount = "total seats" if name == "showtime" else "NBO"
        totals.append(
            spark.read.parquet(f"{path}/{name}").groupBy("movie date").agg(
                F.lit(name).alias("output"), F.count("*").alias("groups"), F.sum(amount).cast("double").alias("total")
            )
        )
    return append_all(totals)


def warehouse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders appended twice to a table whose name comes from parameters."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    name, path = portfolio_table("gate", uuid.uuid4().hex), scratch_dir(spark, "warehouse")
    append_table(orders, name, path)
    append_table(orders.withColumn("o_orderstatus", F.lit("again")), name, path)
    return spark.table(name)


def range_named_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month's events as CSV in a folder named by the days covered."""
    records = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"), "value"
    )
    path = export_range(
        records, scratch_dir(spark, "export"), "tickets", "2024-01-01", "2024-03-01", ["updated_at", "event_id"]
    )
    covered = path.rsplit("/", 1)[1].split("(")[1].split(")")[0].split("_")
    back = spark.read.schema(records.schema).option("header", True).csv(path)
    return back.withColumns({"range_start": F.lit(covered[0]), "range_end": F.lit(covered[1])})


FILMS = """SELECT p_partkey AS film_id, p_name AS film_title, CAST(p_size AS BIGINT) AS film_duration,
    CAST(p_partkey % 100 AS DOUBLE) AS film_film_parent_id, p_brand AS film_approve_datetime FROM {part}"""


def film_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "film")
    write_films(derive(spark, sf_dir, FILMS), path)
    films = spark.read.schema(SCHEMA).parquet(path)
    return films.select(
        "film_id", "film_title", "film_duration", "film_film_parent_id", "film_approve_datetime", "film_synopsis"
    )


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "latin_csv_roundtrip": latin_csv_roundtrip,
    "sheet_skip_rows": sheet_skip_rows,
    "text_lines_match": text_lines_match,
    "schema_merge": schema_merge,
    "snapshot_archive": snapshot_archive,
    "retention_split": retention_split,
    "partitioned_sink": partitioned_sink,
    "multi_sink": multi_sink,
    "warehouse_append": warehouse_append,
    "range_named_output": range_named_output,
    "film_layout": film_layout,
}


ORACLES = {
    "csv_roundtrip": "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
    "latin_csv_roundtrip": r"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(length(t) AS INT) AS n, md5(t) AS digest
        FROM (SELECT doc_id, regexp_replace(text, '[^\x00-\xFF]', '?', 'g') AS t FROM documents)""",
    "sheet_skip_rows": """SELECT o_orderkey AS "Item Number", strftime(o_orderdate, '%-d/%-m/%Y') AS "Day",
        o_totalprice AS "Sales Qty" FROM orders""",
    "text_lines_match": """SELECT replace(replace(l, 'and ', ''), ' ', '') AS line, COUNT(*) AS n
        FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM documents) WHERE contains(l, 'and ') GROUP BY ALL""",
    "schema_merge": """SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN p_retailprice END AS p_retailprice,
        CAST(CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS INT) AS export FROM part""",
    "snapshot_archive": """SELECT o_orderkey, 'N' AS o_orderstatus, CAST(NULL AS DATE) AS archive_date FROM orders
        WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, o_orderstatus, DATE '2020-07-09' FROM orders""",
    "retention_split": with_inputs(
        """SELECT name, CAST(floor(epoch(TIMESTAMP '1998-01-06 00:00:00' - created) / 86400) AS BIGINT) AS age_days,
        CASE WHEN created <= TIMESTAMP '1998-01-06 00:00:00' - INTERVAL 5 DAY THEN 'delete' ELSE 'keep' END AS action
        FROM m WHERE contains(name, 'reporting')""",
        m=MANIFEST,
    ),
    "partitioned_sink": """SELECT event_id, ts, value, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
        strftime(ts, '%d') AS day FROM events""",
    "multi_sink": with_inputs(
        SHOWN_SQL + f"""SELECT movie_date AS "movie date", 'byday' AS output, COUNT(*) AS groups, CAST(SUM(nbo) AS DOUBLE) AS total
          FROM (SELECT {KEYS}, SUM(net) AS nbo FROM shown GROUP BY ALL) GROUP BY movie_date
        UNION ALL SELECT movie_date, 'hourly', COUNT(*), CAST(SUM(nbo) AS DOUBLE)
          FROM (SELECT {KEYS}, show_time, SUM(net) AS nbo FROM shown GROUP BY ALL) GROUP BY movie_date
        UNION ALL SELECT movie_date, 'showtime', COUNT(*), CAST(SUM(seats) AS DOUBLE)
          FROM (SELECT movie_date, film_id, location_id, show_time, hall_no, hall_type, SUM(totalseats) AS seats
            FROM shown GROUP BY ALL) GROUP BY movie_date""",
        **ROLLUP_INPUTS,
    ),
    "warehouse_append": """SELECT o_orderkey, o_orderstatus FROM orders
        UNION ALL SELECT o_orderkey, 'again' FROM orders""",
    "range_named_output": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS updated_at, value,
        '2024-01-01' AS range_start, '2024-01-31' AS range_end FROM events
        WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-02-01 00:00:00'""",
    "film_layout": with_inputs(
        """SELECT film_id, film_title, film_duration, film_film_parent_id, film_approve_datetime,
        CAST(NULL AS VARCHAR) AS film_synopsis FROM f""",
        f=FILMS,
    ),
}
