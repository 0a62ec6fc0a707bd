"""Subscription sales, refunds and the forecast table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import int_or_zero
from ..functions.dates import same_day_flag
from ..functions.labels import any_present_flag, connection_type, free_sale_flag, pixel_flags
from ..operators.measures import hold_out_months, row_count
from ..operators.paging import first_scalar, ordered_limit, page_slice, paged
from ..operators.projection import with_constants, with_load_stamp
from ..plans.forecast import forecast_table as forecast_plan
from ..plans.refunds import pending_refunds as refunds_plan
from ..plans.sales_portfolio import enabled_settings, sales_portfolio as portfolio_plan
from .base import derive, table, with_inputs

# Order dates moved on by twenty years, so that the start date cuts through them.
LATER = """CAST(CAST(substr(CAST(o_orderdate AS STRING), 1, 4) AS INT) + 20 AS STRING)
    || substr(CAST(o_orderdate AS STRING), 5, 6)"""
CUSTOMERS = f"""SELECT o_orderkey AS rid, {LATER} || ' 10:15:30.5' AS subscribe_time, o_custkey AS offer_id,
    CASE WHEN o_orderkey % 3 = 0 THEN 0.0E0 ELSE o_totalprice END AS offer_price,
    CAST(floor(o_custkey / 12) AS BIGINT) AS affiliate_id, 'p' || CAST(o_custkey AS STRING) AS publisher_id,
    o_totalprice AS total_billed, {LATER} AS last_billed, o_orderkey % 7 AS investor_campaign, 'done' AS sync,
    o_orderkey % 2 AS resub, o_orderkey % 4 AS status,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN {LATER} || ' 23:59:59.000000'
        ELSE '2030-01-01 00:00:00.000001' END AS unsubscribe_time,
    o_orderkey % 9000 AS shortcode, o_orderpriority AS keyword, o_orderstatus AS operator,
    600000000 + o_orderkey AS msisdn, 'mo' || CAST(o_orderkey AS STRING) AS mo_id FROM {{orders}}"""
ACTIVITY = """SELECT l_orderkey * 10 + l_linenumber AS rid,
    CAST(l_shipdate AS STRING) || '.25' AS click_time, CAST(l_shipdate AS STRING) || '.000000' AS view_time,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_shipdate AS STRING) END AS lead_time,
    'none' AS conversion_time, l_tax AS click_cost, l_discount AS view_cost, l_quantity AS lead_cost,
    l_extendedprice AS conversion_cost,
    CASE WHEN l_partkey % 13 = 0 THEN 'x' ELSE CAST(l_partkey % 30 AS STRING) END AS flow_type,
    CASE l_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '10'
        WHEN 3 THEN '10.' || CAST(l_suppkey AS STRING) WHEN 4 THEN '10..' || CAST(l_suppkey AS STRING) || '.7'
        ELSE '10.' || CAST(l_suppkey AS STRING) || '.' || CAST(l_linenumber AS STRING) || '.1' END AS remote_ip,
    CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'tel' END AS carrier, l_returnflag AS client_type,
    l_linestatus AS device_name, 'http://offer/' || CAST(l_partkey AS STRING) AS offer_url, 'app' AS webview_app,
    l_partkey AS total_click, l_suppkey AS total_view, CAST(l_linenumber AS BIGINT) AS total_lead,
    l_orderkey AS ref_table_id FROM {lineitem}"""
BILLING = """SELECT o_totalprice AS charge_price,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'first' ELSE 'next' END AS info_category, 1 AS dn_status
    FROM {orders}"""
OFFERS = "SELECT p_partkey AS offer_id, p_name AS name FROM {part}"
AFFILIATES = "SELECT s_suppkey AS aff_id, s_name AS name FROM {supplier}"
FLOWS = "SELECT CAST(n_nationkey AS BIGINT) AS flow_id, n_name AS flow_name FROM {nation}"
PORTFOLIO_INPUTS = dict(
    cust=CUSTOMERS, act=ACTIVITY, info=BILLING, offer=OFFERS, affiliate=AFFILIATES, flow=FLOWS
)


def sales_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [derive(spark, sf_dir, text) for text in PORTFOLIO_INPUTS.values()]
    return portfolio_plan(*frames, gateway="gate", country="my", run_date="2020-07-09")


STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def _text(c: str) -> str:
    return f"CAST(coalesce(try_strptime({c}, {STAMP}), try_strptime({c}, '%Y-%m-%d %H:%M:%S')) AS VARCHAR)"


PORTFOLIO_SQL = f"""SELECT a.rid AS ref_cust_data_table_rid, {_text('click_time')} AS click_time,
  {_text('view_time')} AS view_time, {_text('lead_time')} AS lead_time, {_text('conversion_time')} AS conversion_time,
  click_cost, view_cost, lead_cost, conversion_cost, a.flow_type, f.flow_name, remote_ip, carrier, client_type,
  device_name, offer_url, webview_app, total_click AS click_count, total_view AS view_count, total_lead AS lead_count,
  c.rid AS ref_cust_table_rid, o.name AS offer_name, mo_id, total_billed, last_billed, publisher_id, offer_price,
  {_text('unsubscribe_time')} AS unsubscribe_time, status, investor_campaign,
  CASE WHEN carrier = '' THEN 'wifi' ELSE '3g' END AS connection_type, CAST(1 AS BIGINT) AS sales_count,
  CAST(0 AS BIGINT) AS free_sales_count, '2020' AS update_year, '07' AS update_month, CAST(0 AS BIGINT) AS resub,
  CAST(CASE WHEN date_diff('day', CAST(try_strptime(unsubscribe_time, {STAMP}) AS DATE),
    CAST(try_strptime(subscribe_time, {STAMP}) AS DATE)) = 0 THEN 1 ELSE 0 END AS BIGINT) AS optout24,
  c.offer_id, c.affiliate_id, b.name AS affiliate_name, {_text('subscribe_time')} AS subscribe_time,
  'my' AS country, 'gate' AS gateway,
  CAST(CASE WHEN offer_price = 0 THEN 1 ELSE 0 END AS BIGINT) AS free_pixels_count,
  CAST(CASE WHEN offer_price <> 0 THEN 1 ELSE 0 END AS BIGINT) AS pixels_count,
  (SELECT CAST(CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0 END AS BIGINT) FROM info WHERE charge_price > 0
    AND info_category = 'first' AND dn_status = 1) AS first_billing_count,
  CASE WHEN split_part(remote_ip, '.', 1) <> '' AND split_part(remote_ip, '.', 2) <> ''
    THEN split_part(remote_ip, '.', 1) || '.' || split_part(remote_ip, '.', 2) END AS ip2,
  CASE WHEN split_part(remote_ip, '.', 1) <> '' AND split_part(remote_ip, '.', 2) <> ''
    AND split_part(remote_ip, '.', 3) <> '' THEN split_part(remote_ip, '.', 1) || '.'
    || split_part(remote_ip, '.', 2) || '.' || split_part(remote_ip, '.', 3) END AS ip3,
  shortcode, keyword, operator, CAST(msisdn AS BIGINT) AS msisdn
FROM cust c JOIN offer o ON c.offer_id = o.offer_id JOIN affiliate b ON c.affiliate_id = b.aff_id
JOIN act a ON a.ref_table_id = c.rid JOIN flow f ON TRY_CAST(a.flow_type AS BIGINT) = f.flow_id
WHERE try_strptime(subscribe_time, {STAMP}) > TIMESTAMP '2018-01-01 00:00:00'"""

FLAG_INPUT = """SELECT o_orderkey, CASE o_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'tel' END AS carrier,
    CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey END AS offer,
    CASE WHEN o_orderkey % 3 = 0 THEN 0.0E0 ELSE o_totalprice END AS price, o_orderdate AS joined,
    CASE o_orderkey % 3 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate + INTERVAL 1 DAY ELSE NULL END AS left_at
    FROM {orders}"""


def sales_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, FLAG_INPUT)
    free, paid = pixel_flags("offer", "price")
    return rows.select(
        "o_orderkey",
        connection_type("carrier").alias("connection_type"),
        free_sale_flag("offer").alias("free_sale"),
        F.datediff("joined", "left_at").alias("day_difference"),
        same_day_flag("joined", "left_at").alias("optout24"),
        free.alias("free_pixels"),
        paid.alias("paid_pixels"),
        (row_count(rows.where("price = 0").limit(1)).scalar() > 0).cast("int").alias("any_free"),
    )


FLAG_SQL = """SELECT o_orderkey, CASE WHEN carrier = '' THEN 'wifi' ELSE '3g' END AS connection_type,
  CASE WHEN offer IS NULL THEN '1' ELSE '0' END AS free_sale,
  CAST(date_diff('day', CAST(left_at AS DATE), CAST(joined AS DATE)) AS INT) AS day_difference,
  CASE WHEN CAST(left_at AS DATE) = CAST(joined AS DATE) THEN 1 ELSE 0 END AS optout24,
  CASE WHEN offer IS NOT NULL AND price = 0 THEN 1 ELSE 0 END AS free_pixels,
  CASE WHEN offer IS NOT NULL AND price <> 0 THEN 1 ELSE 0 END AS paid_pixels,
  CASE WHEN EXISTS (SELECT 1 FROM src WHERE price = 0) THEN 1 ELSE 0 END AS any_free FROM src"""

SETTINGS = """SELECT CASE WHEN c_custkey % 2 = 0 THEN 'yes' ELSE 'no' END AS enabled, c_mktsegment AS country,
    CASE WHEN c_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS gateway, c_custkey AS first_billing_wait_day,
    c_name AS custom_info_table FROM {customer}"""


def gateway_setting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting days of the first enabled setting, as a scalar beside the matching count."""
    enabled = enabled_settings(derive(spark, sf_dir, SETTINGS), "even", "MACHINERY")
    first = first_scalar(enabled, "first_billing_wait_day", ["custom_info_table"])
    return enabled.agg(F.count("*").alias("settings")).withColumn("wait_day", first.scalar())


REFUND_INPUT = """SELECT CAST(o_orderkey AS STRING) AS "orderNumber", o_totalprice AS "refundAmount",
    'tx' || CAST(o_custkey AS STRING) AS "refundTransactionId", o_orderpriority AS "paymentMethod",
    'reason ' || o_orderstatus AS "refundReason", o_orderstatus <> 'P' AS "emailRefundStatus" FROM {orders}"""


def pending_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Spark quotes names with back ticks.
    refunds = derive(spark, sf_dir, REFUND_INPUT.replace('"', "`"))
    return refunds_plan(refunds, "2020-03-04 05:06:07.000008")


REFUND_SQL = """SELECT "orderNumber" AS "Order Number", '2020-03-04T05:06:07.000008Z' AS "Date Created",
  "refundAmount" AS "Amount", "refundTransactionId" AS "TXN ID", "paymentMethod" AS "Payment Method",
  "refundReason" AS "Reason" FROM refund WHERE NOT "emailRefundStatus" """

SHORT_DAY = """CAST(CAST(substr(CAST(o_orderdate AS STRING), 9, 2) AS INT) AS STRING) || '/' ||
    CAST(CAST(substr(CAST(o_orderdate AS STRING), 6, 2) AS INT) AS STRING) || '/' ||
    substr(CAST(o_orderdate AS STRING), 1, 4)"""
CALENDAR = f"""SELECT {SHORT_DAY} AS date, max(CASE WHEN o_orderkey % 5 = 0 THEN 1.0E0 END) AS flag_a,
    max(CASE WHEN o_orderkey % 7 = 0 THEN 0.0E0 END) AS flag_b, max(CASE WHEN o_orderkey % 11 = 0 THEN 1.0E0 END) AS flag_c
    FROM {{orders}} WHERE o_orderstatus <> 'P' GROUP BY {SHORT_DAY}"""
ITEM_SALES = f"""SELECT CAST(o_custkey AS STRING) AS item, {SHORT_DAY} AS day, o_totalprice AS quantity FROM {{orders}}"""


def forecast_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = derive(spark, sf_dir, ITEM_SALES).toDF("Item Number", "Day", "Sales Qty")
    calendar = derive(spark, sf_dir, CALENDAR).toDF(
        "date", "isKLPublicHoliday", "isSelangorPublicHoliday", "isSchoolHoliday"
    )
    return forecast_plan(sales, calendar)


FORECAST_SQL = """WITH h AS (SELECT CAST(strptime(date, '%d/%m/%Y') AS DATE) AS d,
    CASE WHEN flag_a IS NOT NULL OR flag_b IS NOT NULL OR flag_c IS NOT NULL THEN '1' ELSE '0' END AS f FROM calendar),
  s AS (SELECT item, CAST(strptime(day, '%d/%m/%Y') AS DATE) AS d FROM sales)
SELECT item AS "Item Number", s.d AS "Day", f AS "isHoliday" FROM s JOIN h ON s.d = h.d
WHERE s.d <= (SELECT max(d) - INTERVAL 6 MONTH FROM s) AND h.d <= (SELECT max(d) - INTERVAL 6 MONTH FROM h)"""


def holiday_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = ["flag_a", "flag_b", "flag_c"]
    filled = {f: int_or_zero(f) for f in flags}
    calendar = derive(spark, sf_dir, CALENDAR).withColumn("holiday", any_present_flag(*flags))
    return calendar.withColumns(filled)


def holdout_six_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return hold_out_months(orders, "day", 6)


def limit_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_limit(table(spark, sf_dir, "orders"), ["o_orderkey"], 10_000).select("o_orderkey", "o_totalprice")


def page_slice_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return page_slice(orders, ["o_orderdate", "o_orderkey"], 201, 100)


def pages_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return paged(orders, ["o_orderdate", "o_orderkey"], 100)


def numeric_time_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    recent = orders.where(F.col("o_orderdate") > F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
    return recent.where(F.col("o_totalprice") > 100000).select("o_orderkey", "o_totalprice")


def const_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return with_load_stamp(
        with_constants(orders, {"sales_count": 1, "o_orderstatus": "0", "country": "my"}), "2020-07-09"
    )


QUERIES = {
    "sales_portfolio": sales_portfolio,
    "sales_flags": sales_flags,
    "gateway_setting": gateway_setting,
    "pending_refunds": pending_refunds,
    "forecast_table": forecast_table,
    "holiday_flag": holiday_flag,
    "holdout_six_months": holdout_six_months,
    "limit_ordered": limit_ordered,
    "page_slice": page_slice_query,
    "pages_all": pages_all,
    "numeric_time_filter": numeric_time_filter,
    "const_cols": const_cols,
}
ORACLES = {
    "sales_portfolio": with_inputs(PORTFOLIO_SQL, **PORTFOLIO_INPUTS),
    "sales_flags": with_inputs(FLAG_SQL, src=FLAG_INPUT),
    "gateway_setting": with_inputs(
        """SELECT COUNT(*) AS settings, arg_min(first_billing_wait_day, custom_info_table) AS wait_day
        FROM setting WHERE enabled = 'yes' AND country = 'MACHINERY' AND gateway = 'even'""",
        setting=SETTINGS,
    ),
    "pending_refunds": with_inputs(REFUND_SQL, refund=REFUND_INPUT),
    "forecast_table": with_inputs(FORECAST_SQL, sales=ITEM_SALES, calendar=CALENDAR),
    "holiday_flag": with_inputs(
        """SELECT date, CAST(coalesce(flag_a, 0) AS INT) AS flag_a, CAST(coalesce(flag_b, 0) AS INT) AS flag_b,
        CAST(coalesce(flag_c, 0) AS INT) AS flag_c,
        CASE WHEN coalesce(flag_a, flag_b, flag_c) IS NOT NULL THEN '1' ELSE '0' END AS holiday FROM calendar""",
        calendar=CALENDAR,
    ),
    "holdout_six_months": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
        WHERE CAST(o_orderdate AS DATE) <= (SELECT CAST(max(o_orderdate) AS DATE) - INTERVAL 6 MONTH FROM orders)""",
    "limit_ordered": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10000",
    "page_slice": "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100 OFFSET 200",
    "pages_all": """SELECT o_orderkey, o_orderdate,
        CAST(floor((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) / 100) + 1 AS BIGINT) AS page FROM orders""",
    "numeric_time_filter": """SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00' AND o_totalprice > 100000""",
    "const_cols": """SELECT o_orderkey, '0' AS o_orderstatus, 1 AS sales_count, 'my' AS country,
        '2020' AS update_year, '07' AS update_month FROM orders""",
}
