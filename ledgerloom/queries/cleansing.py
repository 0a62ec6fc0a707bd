"""Casts, dates, labels and texts; projections without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casts, dates, labels, texts
from ..operators.projection import flatten, flatten_variant, with_headings
from ..plans.images import rendition_plan as rendition_plan_of
from ..plans.telemetry import PARAMETER_KEYS, delivery_text
from ..sources.tables import catalog_table, create_view
from .base import derive, table, with_inputs


def scan_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = [
        ("p_partkey", "bigint", "part_id", "bigint"),
        ("p_name", "string", "part_name", "string"),
        ("p_size", "int", "size_text", "string"),
        ("p_brand", "string", "brand_number", "int"),
        ("p_absent", "string", "absent", "string"),
        ("p_retailprice", "double", "price", "double"),
    ]
    create_view(table(spark, sf_dir, "part"), "part_list")
    return catalog_table(spark, "part_list", mapping)


NUMBER_TEXTS = """SELECT event_id, CASE event_id % 5 WHEN 0 THEN substr(props, 7, length(props) - 7)
    WHEN 1 THEN substr(props, 7, length(props) - 7) || '.0' WHEN 2 THEN 'x' || props WHEN 3 THEN NULL
    ELSE substr(props, 7, length(props) - 7) || '.75' END AS text FROM {events}"""


def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, NUMBER_TEXTS).select(
        "event_id",
        F.when(~F.coalesce(F.col("text").contains("."), F.lit(False)), casts.safe_bigint("text")).alias("whole"),
        casts.safe_bigint_via_double("text").alias("via_double"),
        casts.safe_cast("text", "double").alias("real"),
        casts.number_or("text").alias("or_one"),
        casts.text_left("text", 4).alias("left_four"),
    )


HEADINGS = {"o_orderkey": "Order Number", "o_orderdate": "Date Created", "o_totalprice": "Amount"}


def report_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_headings(table(spark, sf_dir, "orders").select(*HEADINGS), HEADINGS)


def param_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("ResourcesID"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ResourcesCreated"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("ResourcesDataenergyvalue"),
        F.col("event_type").alias("ResourcesTopic"),
    )
    return messages.select("event_id", delivery_text(messages).alias("text"))


def _param_sql() -> str:
    known = {
        "ResourcesDataenergyvalue": "coalesce(CASE WHEN event_type <> 'error' THEN CAST(value AS VARCHAR) END, 'NULL')",
        "ResourcesTopic": "event_type",
    }
    pieces = [
        "'&DeviceID=' || CAST(user_id AS VARCHAR)", "'&DateTimestamp=' || strftime(ts, '%Y-%m-%dT%H:%M:%S')"
    ]
    for i, key in enumerate(PARAMETER_KEYS, start=1):
        pieces.append(f"'&ms{i}=' || {known[key]}" if key in known else f"'&ms{i}=NULL'")
    return f"SELECT event_id, {' || '.join(pieces)} AS text FROM events"


NESTED = """SELECT event_id, '{{"Resources":{{"ID":"' || CAST(user_id AS STRING) || '","Data":{{"energy":{{"unit":"kWh","value":'
    || substr(props, 7, length(props) - 7) || '}},"list":[1,' || CAST(event_id AS STRING) || ']}},"Topic":"' || event_type
    || '"}}}}' AS body FROM {events}"""
NESTED_SCHEMA = (
    "Resources struct<ID:string,Data:struct<energy:struct<unit:string,value:double>,list:array<bigint>>,Topic:string>"
)


def flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = derive(spark, sf_dir, NESTED).select("event_id", F.from_json("body", NESTED_SCHEMA).alias("m"))
    flat = flatten(parsed.select("event_id", "m.*"))
    return flat.withColumn("ResourcesDatalist", F.to_json("ResourcesDatalist"))


def flatten_unknown_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts without a schema, as paths and values."""
    parsed = derive(spark, sf_dir, NESTED).select("event_id", F.parse_json("body").alias("m"))
    return flatten_variant(parsed, ["event_id"], "m")


# Up to eleven objects inside one another, beside a leaf at each level.
DEEP = """SELECT event_id, repeat('{{"in":', CAST(event_id % 12 AS INT)) || '{{"at":' || CAST(event_id AS STRING) || '}}'
    || repeat(',"by":"' || event_type || '"}}', CAST(event_id % 12 AS INT)) AS body FROM {events}"""


def flatten_deep_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = derive(spark, sf_dir, DEEP).select("event_id", F.parse_json("body").alias("m"))
    return flatten_variant(parsed, ["event_id"], "m")


PRICES = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS price,
    CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN CAST(l_quantity AS STRING) || '%'
        WHEN 2 THEN '0' ELSE 'x' END AS discount_text FROM {lineitem}"""


def discounted_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    discount = casts.percent_or("discount_text")
    return derive(spark, sf_dir, PRICES).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        discount.alias("discount"), casts.scaled_price("price", discount).alias("discounted_price"),
    )


BLANKS = """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE source END AS source FROM {documents}"""


def null_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, BLANKS).select(
        "doc_id",
        F.col("source").isNotNull().alias("present"),
        F.coalesce(casts.not_null_or_not_empty("source"), F.lit(False)).alias("loose"),
        casts.is_blank("source").alias("blank"),
        casts.not_blank("source").alias("filled"),
    )


SALE_POINTS = """SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'EPAY' WHEN '2' THEN 'KIOSK01'
    WHEN '3' THEN 'IOS' WHEN '4' THEN 'ANDROID' ELSE 'C1' END AS pos,
    CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'APP' ELSE '' END AS platform FROM {orders}"""


def platform_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, SALE_POINTS).select(
        "o_orderkey",
        labels.sale_platform("platform", "pos").alias("platform_label"),
        labels.sale_source("platform", "pos").alias("source_label"),
    )


def hour_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", labels.hour_label("ts").alias("label"))


DATE_TEXTS = """SELECT o_orderkey, CASE o_orderkey % 5
      WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
      WHEN 1 THEN CAST(CAST(substr(CAST(o_orderdate AS STRING), 9, 2) AS INT) AS STRING) || '/'
        || CAST(CAST(substr(CAST(o_orderdate AS STRING), 6, 2) AS INT) AS STRING) || '/'
        || substr(CAST(o_orderdate AS STRING), 1, 4)
      WHEN 2 THEN '' WHEN 3 THEN NULL ELSE '2020-13-45' END AS day_text,
    CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS STRING) || '.5' WHEN 1 THEN CAST(o_orderdate AS STRING) || '.123456'
      WHEN 2 THEN '' ELSE CAST(o_orderdate AS STRING) || '.000000000' END AS stamp_text,
    CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(CAST(substr(CAST(o_orderdate AS STRING), 6, 2) AS INT) AS STRING)
      || '/' || substr(CAST(o_orderdate AS STRING), 9, 2) || '/' || substr(CAST(o_orderdate AS STRING), 1, 4)
      END AS us_text FROM {orders}"""


def mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, DATE_TEXTS).select(
        "o_orderkey",
        dates.mixed_layout_date("day_text").alias("mixed"),
        dates.day_first_date("day_text").alias("day_first"),
        dates.parse_timestamp("stamp_text").alias("stamp"),
        dates.date_of_text("stamp_text").alias("date_of_26"),
        dates.month_first_iso("us_text").alias("iso"),
    )


HHMM = """SELECT event_id, CAST((CAST(substr(CAST(ts AS STRING), 12, 2) AS INT)) * 100
    + CAST(substr(CAST(ts AS STRING), 15, 2) AS INT) AS INT) AS hhmm FROM {events}"""


def showtime_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, HHMM).select("event_id", labels.showtime_band("hhmm").alias("band"))


def showtime_bands_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, HHMM).select("event_id", labels.showtime_band("hhmm", strict=True).alias("band"))


def show_hour_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, HHMM).select("event_id", labels.show_hour_label("hhmm").alias("label"))


CODES = "SELECT p_partkey, CAST(p_partkey * 7 AS STRING) AS code FROM {part}"


def code_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, CODES).select(
        "p_partkey",
        labels.prefixed_code("code", 3).alias("category_code"),
        labels.prefixed_code("code", 5).alias("group_code"),
    )


def year_end_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", dates.year_end_stamp("ts").alias("year_end"), dates.iso_stamp("ts").alias("stamp")
    )


def shift_and_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = dates.shift_hours("ts", 8)
    return table(spark, sf_dir, "events").select(
        "event_id",
        shifted.alias("shifted"),
        dates.bin_end(shifted).alias("bin"),
        dates.bin_end(shifted, keep_seconds=True).alias("bin_with_seconds"),
    )


ADDRESSES = """SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN CAST(c_custkey AS STRING)
    WHEN 3 THEN CAST(c_custkey AS STRING) || '.' WHEN 4 THEN CAST(c_custkey AS STRING) || '.2'
    ELSE CAST(c_custkey AS STRING) || '.2.3.4' END AS ip FROM {customer}"""


def ip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, ADDRESSES).select(
        "c_custkey", texts.ip_prefix("ip", 2).alias("ip2"), texts.ip_prefix("ip", 3).alias("ip3")
    )


SEATS = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END AS seat_row,
    CASE WHEN l_linenumber = 2 THEN 'x' ELSE '0' || CAST(l_suppkey AS STRING) END AS seat_col FROM {lineitem}"""


def seat_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, SEATS).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", texts.seat_number("seat_row", "seat_col").alias("seat")
    )


def explode_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text between `, `, counted; a piece is named by its hash, and
    its first six characters stand beside it."""
    pieces = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", ", ")).alias("tag"))
    return pieces.groupBy("doc_id", F.md5("tag").alias("tag"), F.substring("tag", 1, 6).alias("tag_start")).agg(
        F.count("*").alias("n")
    )


PICTURES = """SELECT page_id, 'img' || CAST(page_id AS STRING) || CASE WHEN page_id % 7 = 0 THEN '' ELSE '.jpg' END AS key,
    CAST(30 + (page_id * 37) % 2000 AS INT) AS width,
    CAST(CASE page_id % 4 WHEN 0 THEN 30 + (page_id * 37) % 2000 WHEN 1 THEN 10 ELSE 20 + (page_id * 91) % 1900 END AS INT)
    AS height FROM {pages}"""


def rendition_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendition_plan_of(derive(spark, sf_dir, PICTURES))


QUERIES = {
    "scan_mapped": scan_mapped,
    "safe_casts": safe_casts,
    "report_headings": report_headings,
    "param_string": param_string,
    "flatten_json": flatten_json,
    "flatten_unknown_json": flatten_unknown_json,
    "flatten_deep_json": flatten_deep_json,
    "discounted_price": discounted_price,
    "null_or_empty": null_or_empty,
    "platform_source": platform_source,
    "hour_label": hour_label,
    "mixed_dates": mixed_dates,
    "showtime_bands": showtime_bands,
    "showtime_bands_strict": showtime_bands_strict,
    "show_hour_label": show_hour_label,
    "code_prefix": code_prefix,
    "year_end_stamp": year_end_stamp,
    "shift_and_bin": shift_and_bin,
    "ip_prefix": ip_prefix,
    "seat_number": seat_number,
    "explode_tags": explode_tags,
    "rendition_plan": rendition_plan,
}
BINNED = "date_trunc('hour', {c}) + to_minutes(CAST((floor(minute({c}) / 10) + 1) * 10 AS BIGINT))"
SHIFTED = "(ts + INTERVAL 8 HOUR)"
ORACLES = {
    "scan_mapped": """SELECT p_partkey AS part_id, p_name AS part_name, CAST(p_size AS VARCHAR) AS size_text,
        TRY_CAST(p_brand AS INT) AS brand_number, p_retailprice AS price FROM part""",
    "safe_casts": with_inputs(
        """SELECT event_id, CASE WHEN position('.' IN text) = 0 THEN TRY_CAST(text AS BIGINT) END AS whole,
        CAST(trunc(TRY_CAST(text AS DOUBLE)) AS BIGINT) AS via_double, TRY_CAST(text AS DOUBLE) AS real,
        CASE WHEN text IS NULL OR text = '' THEN 1.0 ELSE TRY_CAST(text AS DOUBLE) END AS or_one,
        substr(text, 1, 4) AS left_four FROM src""",
        src=NUMBER_TEXTS,
    ),
    "report_headings": 'SELECT o_orderkey AS "Order Number", o_orderdate AS "Date Created", o_totalprice AS "Amount" FROM orders',
    "param_string": _param_sql(),
    "flatten_json": """SELECT event_id, CAST(user_id AS VARCHAR) AS "ResourcesID", 'kWh' AS "ResourcesDataenergyunit",
        CAST(json_extract_string(props, '$.k') AS DOUBLE) AS "ResourcesDataenergyvalue",
        '[1,' || CAST(event_id AS VARCHAR) || ']' AS "ResourcesDatalist", event_type AS "ResourcesTopic" FROM events""",
    "flatten_unknown_json": """SELECT event_id, 'ResourcesID' AS path, CAST(user_id AS VARCHAR) AS value FROM events
        UNION ALL SELECT event_id, 'ResourcesDataenergyunit', 'kWh' FROM events
        UNION ALL SELECT event_id, 'ResourcesDataenergyvalue', json_extract_string(props, '$.k') FROM events
        UNION ALL SELECT event_id, 'ResourcesDatalist', '[1,' || CAST(event_id AS VARCHAR) || ']' FROM events
        UNION ALL SELECT event_id, 'ResourcesTopic', event_type FROM events""",
    "flatten_deep_json": """SELECT event_id, repeat('in', CAST(event_id % 12 AS INT)) || 'at' AS path, CAST(event_id AS VARCHAR) AS value
        FROM events UNION ALL SELECT event_id, repeat('in', CAST(n AS INT)) || 'by', event_type
        FROM (SELECT *, unnest(range(event_id % 12)) AS n FROM events)""",
    "discounted_price": with_inputs(
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, discount,
        price * 100 / nullif(discount, 0) AS discounted_price FROM (SELECT *,
          CASE WHEN discount_text = '' THEN 1.0 ELSE TRY_CAST(replace(discount_text, '%', '') AS DOUBLE) END AS discount
          FROM src)""",
        src=PRICES,
    ),
    "null_or_empty": with_inputs(
        """SELECT doc_id, source IS NOT NULL AS present, source IS NOT NULL AS loose,
        coalesce(source, '') = '' AS blank, coalesce(source, '') <> '' AS filled FROM src""",
        src=BLANKS,
    ),
    "platform_source": with_inputs(
        """SELECT o_orderkey, CASE WHEN platform = '' AND pos = 'EPAY' THEN 'ONLINE' WHEN platform = ''
        AND pos LIKE '%KIOSK%' THEN 'KIOSK' ELSE 'POS' END AS platform_label,
        CASE WHEN platform = '' AND pos = 'EPAY' THEN 'ONLINE' WHEN platform = '' AND pos LIKE '%KIOSK%' THEN 'KIOSK'
        WHEN platform = '' AND pos IN ('IOS', 'ANDROID') THEN 'MOBILE' ELSE 'POS' END AS source_label FROM src""",
        src=SALE_POINTS,
    ),
    "hour_label": """SELECT event_id, CASE WHEN hour(ts) < 10 THEN '0' || CAST(hour(ts) AS VARCHAR) || ':00AM'
        WHEN hour(ts) < 12 THEN CAST(hour(ts) AS VARCHAR) || ':00AM' WHEN hour(ts) = 12 THEN NULL
        WHEN hour(ts) < 22 THEN '0' || CAST(hour(ts) - 12 AS VARCHAR) || ':00PM'
        ELSE CAST(hour(ts) - 12 AS VARCHAR) || ':00PM' END AS label FROM events""",
    "mixed_dates": with_inputs(
        """SELECT o_orderkey, CAST(CASE WHEN day_text LIKE '%-%-%' THEN try_strptime(day_text, '%Y-%m-%d')
          WHEN day_text LIKE '%/%/%' THEN try_strptime(day_text, '%d/%m/%Y') END AS DATE) AS mixed,
        CAST(try_strptime(day_text, '%d/%m/%Y') AS DATE) AS day_first,
        CASE WHEN length(stamp_text) <= 26 THEN try_strptime(stamp_text, '%Y-%m-%d %H:%M:%S.%f') END AS stamp,
        CAST(try_strptime(substr(stamp_text, 1, 26), '%Y-%m-%d %H:%M:%S.%f') AS DATE) AS date_of_26,
        CASE WHEN us_text = '' THEN '' ELSE strftime(strptime(us_text, '%m/%d/%Y'), '%Y-%m-%dT%H:%M:%S.%fZ') END AS iso
        FROM src""",
        src=DATE_TEXTS,
    ),
    "showtime_bands": with_inputs(
        """SELECT event_id, CASE WHEN hhmm BETWEEN 560 AND 2299 THEN 'Early (before 1pm)'
        ELSE 'Midnight (10pm onwards)' END AS band FROM src""",
        src=HHMM,
    ),
    "showtime_bands_strict": with_inputs(
        """SELECT event_id, CASE WHEN hhmm >= 2200 OR hhmm <= 559 THEN 'Midnight (10pm onwards)'
        WHEN hhmm >= 600 AND hhmm <= 1259 THEN 'Early (before 1pm)'
        WHEN hhmm >= 1300 AND hhmm <= 1759 THEN 'Afternoon (1pm - 5:59pm)'
        WHEN hhmm >= 1800 AND hhmm <= 2159 THEN 'Evening (6pm - 9:59pm)' END AS band FROM src""",
        src=HHMM,
    ),
    "show_hour_label": with_inputs(
        """SELECT event_id, CASE WHEN hhmm < 1200 THEN '0' || CAST(hhmm // 100 AS VARCHAR) || ':00AM'
        ELSE CAST(hhmm // 100 - 12 AS VARCHAR) || ':00PM' END AS label FROM src""",
        src=HHMM,
    ),
    "code_prefix": with_inputs(
        """SELECT p_partkey, CASE WHEN length(code) <= 3 THEN '0' || code ELSE code END AS category_code,
        CASE WHEN length(code) <= 5 THEN '0' || code ELSE code END AS group_code FROM src""",
        src=CODES,
    ),
    "year_end_stamp": """SELECT event_id, CAST(year(ts) AS VARCHAR) || '-12-31T23:59:59.999Z' AS year_end,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS stamp FROM events""",
    "shift_and_bin": f"""SELECT event_id, {SHIFTED} AS shifted, {BINNED.format(c=SHIFTED)} AS bin,
        {BINNED.format(c=SHIFTED)} + to_seconds(CAST(floor(second({SHIFTED})) AS BIGINT)) AS bin_with_seconds FROM events""",
    "ip_prefix": with_inputs(
        """SELECT c_custkey, CASE WHEN p1 <> '' AND p2 <> '' THEN p1 || '.' || p2 END AS ip2,
        CASE WHEN p1 <> '' AND p2 <> '' AND p3 <> '' THEN p1 || '.' || p2 || '.' || p3 END AS ip3
        FROM (SELECT *, split_part(ip, '.', 1) AS p1, split_part(ip, '.', 2) AS p2, split_part(ip, '.', 3) AS p3 FROM src)""",
        src=ADDRESSES,
    ),
    "seat_number": with_inputs(
        """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        seat_row || CAST(TRY_CAST(seat_col AS BIGINT) AS VARCHAR) AS seat FROM src""",
        src=SEATS,
    ),
    "explode_tags": """SELECT doc_id, md5(tag) AS tag, substr(tag, 1, 6) AS tag_start, COUNT(*) AS n
        FROM (SELECT doc_id, unnest(string_split(text, ', ')) AS tag FROM documents) GROUP BY doc_id, md5(tag), substr(tag, 1, 6)""",
    "rendition_plan": with_inputs(
        """SELECT key, size, target_width, target_height, split_part(key, '.', 1) || '_' || CAST(target_width AS VARCHAR)
          || '_' || CAST(target_height AS VARCHAR) || '.' || CASE WHEN key LIKE '%.%' THEN split_part(key, '.', 2) END
          AS target_key
        FROM (SELECT key, size,
          CASE WHEN width >= height THEN size ELSE CAST(trunc(CAST(size AS DOUBLE) / height * width) AS INT) END AS target_width,
          CASE WHEN width <= height THEN size ELSE CAST(trunc(CAST(size AS DOUBLE) / width * height) AS INT) END AS target_height
          FROM src CROSS JOIN (SELECT unnest([50, 100, 200, 400, 800, 1600]) AS size)
          WHERE size <= greatest(width, height)) WHERE target_width <> 0 AND target_height <> 0""",
        src=PICTURES,
    ),
}
