"""Tickets made of line items and orders: the sales view and the three rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import safe_bigint
from ..operators.lookups import drop_matches
from ..operators.measures import distinct_in_group, net_box_office, ratio, rounded_sum
from ..operators.parts import parts_for
from ..plans import ticket_rollups as rollups
from ..plans.ticket_view import ticket_sales, unrefunded
from .base import decimals_to_double, derive, with_inputs

DAY_TEXT = """CASE WHEN l_linenumber % 2 = 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
    ELSE substr(CAST(o_orderdate AS STRING), 9, 2) || '/' || substr(CAST(o_orderdate AS STRING), 6, 2)
         || '/' || substr(CAST(o_orderdate AS STRING), 1, 4) END"""

AMOUNTS = """CAST(l_extendedprice AS DECIMAL(18,4)) AS {p}_tkt_amt,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS {p}_tkt_gst_amt,
    CAST(l_quantity AS DECIMAL(18,4)) AS {p}_tkt_ent_tax,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4))
        AS {p}_tkt_surc_amt,
    CAST(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4))
        AS {p}_tkt_surc_gst_amt"""

TICKETS = f"""SELECT l_orderkey % 25 AS ttd_loc_id, {DAY_TEXT} AS ttd_bus_date,
    CAST(l_orderkey AS STRING) AS ttd_booking_id, CAST(l_orderkey AS STRING) AS ttd_show_id,
    CAST(l_partkey AS STRING) AS ttd_row_id, CAST(l_suppkey AS STRING) AS ttd_col_id,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'EPAY' WHEN '2' THEN 'KIOSK01' WHEN '3' THEN 'IOS'
        WHEN '4' THEN 'ANDROID' ELSE 'C1' END AS ttd_pos_no,
    CAST(l_partkey AS STRING) AS ttd_film_id, CAST(l_suppkey % 12 AS STRING) AS ttd_hall_id,
    substr(CAST(l_shipdate AS STRING), 1, 10) || ' ' || lpad(CAST(l_partkey % 24 AS STRING), 2, '0')
        || ':15:30.250000' AS ttd_trxn_date,
    CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(l_orderkey * 10 + l_linenumber AS STRING) END AS ttd_ticket_no,
    CAST(l_partkey AS STRING) AS ttd_tkt_type,
    {AMOUNTS.format(p='ttd')},
    CAST(l_quantity AS DECIMAL(18,4)) AS ttd_tkt_bkg_fee_amt,
    CAST(l_tax AS DECIMAL(18,4)) AS ttd_tkt_bkg_fee_gst_amt,
    o_orderpriority AS ttd_pymt_channel_type,
    CAST((l_suppkey % 24) * 100 + l_linenumber AS STRING) AS ttd_show_time, {DAY_TEXT} AS ttd_show_date,
    CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 'APP' ELSE '' END AS ttd_pymt_platform
    FROM {{lineitem}} AS l JOIN {{orders}} AS o ON l_orderkey = o_orderkey"""

REFUNDS = """SELECT CAST(l_orderkey AS STRING) || '.0' AS trd_booking_id, CAST(l_partkey AS STRING) AS trd_row_id,
    CAST(l_suppkey AS STRING) AS trd_col_id FROM {lineitem} WHERE l_returnflag = 'R' AND l_quantity > 25"""
FILMS = "SELECT p_partkey AS film_id, CAST(p_partkey % 100 AS DOUBLE) AS film_film_parent_id FROM {part}"
FILM_PARENTS = """SELECT p_partkey AS flm_parent_id FROM {part} WHERE p_partkey % 3 = 0
    UNION ALL SELECT p_partkey AS flm_parent_id FROM {part} WHERE p_partkey % 6 = 0"""
TICKET_TYPES = "SELECT CAST(p_partkey AS STRING) AS tkt_type_id, p_type AS tkt_type_seat_type FROM {part}"
SHOW_DATE = """CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE
    substr(CAST(o_orderdate AS STRING), 1, 10) || ' 00:00:00.000000' END"""
SCHEDULE_A = f"""SELECT o_orderkey AS showid, CAST(o_orderkey % 25 AS STRING) AS locid, {SHOW_DATE} AS showdate,
    50 + o_orderkey % 200 AS totalseats FROM {{orders}} WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'"""
SCHEDULE_B = f"""SELECT o_orderkey AS showid, o_orderkey % 25 AS locid, {SHOW_DATE} AS showdate,
    50 + o_orderkey % 200 AS totalseats FROM {{orders}} WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
    AND o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"""
SCHEDULE_C = f"""SELECT o_orderkey AS showid, o_orderkey % 25 AS locid, {SHOW_DATE} AS showdate,
    50 + o_orderkey % 200 AS totalseats FROM {{orders}} WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'"""
SCHEDULES = f"""SELECT showid, totalseats FROM ({SCHEDULE_A}) AS a UNION ALL SELECT showid, totalseats FROM ({SCHEDULE_B}) AS b
    UNION ALL SELECT showid, totalseats FROM ({SCHEDULE_C}) AS c"""

VIEW_INPUTS = dict(
    ticket=TICKETS, refund=REFUNDS, film=FILMS, film_parent=FILM_PARENTS, ticket_type=TICKET_TYPES,
    schedule_a=SCHEDULE_A, schedule_b=SCHEDULE_B, schedule_c=SCHEDULE_C,
)


def ticket_sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    def d(text: str) -> DataFrame:
        return derive(spark, sf_dir, text)

    tickets = d(TICKETS)
    view = ticket_sales(
        tickets, d(REFUNDS), d(FILMS), d(FILM_PARENTS), d(TICKET_TYPES),
        [d(SCHEDULE_A), d(SCHEDULE_B), d(SCHEDULE_C)], headings=False, parts=parts_for(tickets),
    )
    return decimals_to_double(view)


def ticket_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view's measures at a coarser grain, where tickets and bookings must be
    counted distinctly."""
    tickets, seats = derive(spark, sf_dir, TICKETS), derive(spark, sf_dir, SCHEDULES)
    joined = tickets.join(seats, safe_bigint("ttd_show_id") == F.col("showid"))
    keys = ["ttd_loc_id", "ttd_pos_no"]
    nbo = rounded_sum(
        net_box_office("ttd_tkt_amt", "ttd_tkt_gst_amt", "ttd_tkt_ent_tax", "ttd_tkt_surc_amt", "ttd_tkt_surc_gst_amt")
    )
    admission = distinct_in_group("ttd_ticket_no", keys)
    return decimals_to_double(
        joined.groupBy(*keys).agg(
            nbo.alias("nbo"),
            admission.alias("admission"),
            distinct_in_group("ttd_booking_id", keys).alias("transactions"),
            ratio(nbo, admission).alias("atp"),
            F.round(ratio(admission, F.sum("totalseats")) * 100, 2).alias("occupancy_rate"),
        )
    )


NBO = "ttd_tkt_amt - ttd_tkt_gst_amt - ttd_tkt_ent_tax + ttd_tkt_surc_amt - ttd_tkt_surc_gst_amt"
DAY = "coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%d/%m/%Y'))"

# Films are joined as a number of copies per film, refunds are looked up per ticket.
TICKET_SALES_SQL = f"""WITH show_days AS (
    SELECT DISTINCT * FROM (SELECT showid, TRY_CAST(locid AS BIGINT) AS locid, showdate, totalseats FROM schedule_a
      UNION ALL SELECT * FROM schedule_b UNION ALL SELECT * FROM schedule_c) WHERE showdate <> ''),
  copies AS (SELECT film_id, greatest(COUNT(flm_parent_id), 1) AS n FROM film
    LEFT JOIN film_parent ON flm_parent_id = CAST(film_film_parent_id AS BIGINT) GROUP BY film_id),
  kept AS (SELECT t.*, coalesce(c.n, 1) AS n, d.showdate, d.totalseats * coalesce(c.n, 1) AS seats, y.tkt_type_seat_type,
      {DAY.format(c='ttd_bus_date')} AS movie_day, try_strptime(ttd_trxn_date, '%Y-%m-%d %H:%M:%S.%f') AS paid_at,
      CAST(ttd_tkt_amt * coalesce(c.n, 1) AS DECIMAL(18,4)) AS amt, CAST(ttd_tkt_gst_amt * coalesce(c.n, 1) AS DECIMAL(18,4)) AS gst,
      CAST(ttd_tkt_ent_tax * coalesce(c.n, 1) AS DECIMAL(18,4)) AS ent,
      CAST(ttd_tkt_bkg_fee_amt * coalesce(c.n, 1) AS DECIMAL(18,4)) AS fee,
      CAST(ttd_tkt_bkg_fee_gst_amt * coalesce(c.n, 1) AS DECIMAL(18,4)) AS fee_gst,
      CAST(ttd_tkt_surc_amt * coalesce(c.n, 1) AS DECIMAL(18,4)) AS surc,
      CAST(ttd_tkt_surc_gst_amt * coalesce(c.n, 1) AS DECIMAL(18,4)) AS surc_gst
    FROM ticket t
    JOIN show_days d ON d.showid = CAST(ttd_show_id AS BIGINT) AND d.locid = ttd_loc_id
      AND CAST(d.showdate AS TIMESTAMP) = {DAY.format(c='ttd_show_date')}
    LEFT JOIN copies c ON c.film_id = CAST(ttd_film_id AS BIGINT)
    LEFT JOIN ticket_type y ON y.tkt_type_id = ttd_tkt_type
    WHERE ttd_booking_id IS NOT NULL AND (ttd_booking_id || '.0', ttd_row_id, ttd_col_id) NOT IN
      (SELECT (trd_booking_id, trd_row_id, trd_col_id) FROM refund)),
  grouped AS (SELECT ttd_loc_id AS location_code, movie_day AS movie_date, CAST(ttd_booking_id AS BIGINT) AS booking_id,
      CAST(ttd_show_id AS BIGINT) AS show_id, ttd_row_id AS seat_row, CAST(ttd_col_id AS BIGINT) AS seat_column,
      ttd_pos_no AS pos_no, CAST(ttd_film_id AS BIGINT) AS film_id, CAST(ttd_hall_id AS BIGINT) AS hall_id,
      paid_at AS transaction_date, CAST(ttd_ticket_no AS BIGINT) AS ticket_no, ttd_tkt_type AS ticket_type,
      ttd_pymt_channel_type AS payment_channel_type, CAST(ttd_show_time AS BIGINT) AS show_time,
      ttd_show_date AS show_date, ttd_row_id || ttd_col_id AS seat_number, tkt_type_seat_type AS seat_type,
      ttd_pymt_platform AS paid_on, showdate, ttd_bus_date,
      SUM(amt) AS a, SUM(gst) AS g, SUM(ent) AS e, SUM(fee) AS f, SUM(fee_gst) AS fg, SUM(surc) AS s, SUM(surc_gst) AS sg,
      COUNT(DISTINCT ttd_ticket_no) AS admission, COUNT(DISTINCT ttd_booking_id) AS transactions, SUM(seats) AS seats
    FROM kept GROUP BY ALL)
SELECT location_code, movie_date, booking_id, show_id, seat_row, seat_column, pos_no, film_id, hall_id, transaction_date,
  ticket_no, ticket_type, CAST(a AS DOUBLE) AS ticket_amount, CAST(g AS DOUBLE) AS ticket_gst_amount,
  CAST(e AS DOUBLE) AS ticket_ent_tax, CAST(f AS DOUBLE) AS booking_fee_amount, CAST(fg AS DOUBLE) AS booking_fee_gst_amount,
  CAST(s AS DOUBLE) AS surcharge_amount, CAST(sg AS DOUBLE) AS surcharge_gst_amount, payment_channel_type, show_time,
  show_date, seat_number, CAST(ROUND(a - g - e + s - sg, 2) AS DOUBLE) AS nbo, CAST(ROUND(a + s, 2) AS DOUBLE) AS gbo,
  admission, CAST(ROUND(a - g - e, 2) AS DOUBLE) AS net_ticket_price, CAST(ROUND(s - sg, 2) AS DOUBLE) AS net_surcharge,
  CAST(ROUND(f - fg, 2) AS DOUBLE) AS net_booking_fee,
  CAST(ROUND(a - g - e + s - sg, 2) AS DOUBLE) / NULLIF(CAST(admission AS DOUBLE), 0) AS atp, transactions,
  ROUND(CAST(admission AS DOUBLE) / CAST(seats AS DOUBLE) * 100, 2) AS occupancy_rate,
  CASE WHEN hour(transaction_date) <> 12 THEN strftime(transaction_date, '%I:00%p') END AS raw_label, seat_type, pos_no AS p,
  paid_on FROM grouped"""
# Midnight is written 00 on this clock, and the channels follow from the sale point.
TICKET_SALES_SQL = f"""SELECT * EXCLUDE (raw_label, p, paid_on),
  CASE WHEN hour(transaction_date) = 0 THEN '00:00AM' ELSE raw_label END AS hourly_sales,
  CASE WHEN paid_on = '' THEN CASE p WHEN 'EPAY' THEN 'ONLINE' WHEN 'KIOSK01' THEN 'KIOSK' ELSE 'POS' END ELSE 'POS' END
    AS platform,
  CASE WHEN paid_on = '' THEN CASE p WHEN 'EPAY' THEN 'ONLINE' WHEN 'KIOSK01' THEN 'KIOSK' WHEN 'C1' THEN 'POS'
    ELSE 'MOBILE' END ELSE 'POS' END AS source FROM ({TICKET_SALES_SQL})"""


def refund_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = unrefunded(derive(spark, sf_dir, TICKETS), derive(spark, sf_dir, REFUNDS))
    return decimals_to_double(
        kept.select("ttd_booking_id", "ttd_row_id", "ttd_col_id", "ttd_ticket_no", "ttd_tkt_amt")
    )


REFUND_ANTI_SQL = """SELECT ttd_booking_id, ttd_row_id, ttd_col_id, ttd_ticket_no,
  CAST(ttd_tkt_amt AS DOUBLE) AS ttd_tkt_amt FROM ticket
WHERE NOT EXISTS (SELECT 1 FROM refund WHERE CAST(trd_booking_id AS DOUBLE) = CAST(ttd_booking_id AS DOUBLE)
  AND trd_row_id = ttd_row_id AND trd_col_id = ttd_col_id)"""

# The rollups' tables.
SOLD = f"""SELECT CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS tic_booking_id,
    CAST(l_suppkey AS STRING) AS tic_col_id, CAST(l_partkey AS STRING) AS tic_row_id,
    CAST(l_suppkey % 12 AS STRING) AS tic_hall_id, CAST(l_orderkey AS STRING) AS tic_show_id,
    CAST((o_orderkey % 24) * 100 + 30 AS STRING) AS tic_show_time, CAST(o_orderkey % 2000 AS STRING) AS tic_film_id,
    CAST(o_orderkey % 25 AS STRING) AS tic_loc_id, substr(CAST(o_orderdate AS STRING), 1, 10) AS tic_show_date,
    {DAY_TEXT} AS tic_bus_date, {AMOUNTS.format(p='tic')}
    FROM {{lineitem}} AS l JOIN {{orders}} AS o ON l_orderkey = o_orderkey"""
SOLD_REFUNDS = """SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS refund_booking_id,
    CAST(l_suppkey AS STRING) AS refund_col_id, CAST(l_partkey AS STRING) AS refund_row_id
    FROM {lineitem} WHERE l_returnflag = 'R' AND l_quantity > 25"""
HALLS = """SELECT CAST(s_suppkey % 12 AS INT) AS hall_hall_id, CAST(s_suppkey % 25 AS STRING) AS hall_loca_id,
    min(CASE WHEN s_nationkey % 5 = 4 THEN NULL ELSE CAST(s_nationkey % 5 AS STRING) END) AS halltype
    FROM {supplier} GROUP BY s_suppkey % 12, s_suppkey % 25"""
HALL_TYPES = "SELECT CAST(r_regionkey AS STRING) AS halltype_id, r_name AS halltype_name FROM {region} WHERE r_regionkey < 3"
TIMETABLE = """SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderkey AS INT) END AS showid,
    CAST(o_orderkey % 25 AS STRING) AS locid,
    CASE WHEN o_orderkey % 103 = 0 THEN '' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) || ' 00:00:00.000000000'
        END AS showdate,
    CAST((o_orderkey % 24) * 100 + 30 AS STRING) AS showtime, CAST(o_orderkey % 2000 AS INT) AS filmid,
    50 + o_orderkey % 200 AS totalseats FROM {orders}"""

ROLLUP_INPUTS = dict(sold=SOLD, refund=SOLD_REFUNDS, hall=HALLS, hall_type=HALL_TYPES, timetable=TIMETABLE)


def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.shown_tickets(*[derive(spark, sf_dir, text) for text in ROLLUP_INPUTS.values()])


def grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.show_grain(shown(spark, sf_dir))


SHOWN_SQL = """WITH shown AS (SELECT
    CAST(CASE WHEN tic_bus_date LIKE '%/%/%' THEN strptime(tic_bus_date, '%d/%m/%Y')
      WHEN tic_bus_date LIKE '%-%-%' THEN strptime(tic_bus_date, '%Y-%m-%d') END AS DATE) AS movie_date,
    tic_loc_id AS location_id, TRY_CAST(tic_film_id AS INT) AS film_id, TRY_CAST(tic_hall_id AS INT) AS hall_id,
    hall_hall_id AS hall_no, halltype_name AS hall_type, TRY_CAST(tic_show_time AS INT) AS show_time,
    showid AS show_id, totalseats,
    tic_tkt_amt - tic_tkt_gst_amt - tic_tkt_ent_tax + tic_tkt_surc_amt - tic_tkt_surc_gst_amt AS net
  FROM sold
  LEFT JOIN hall ON TRY_CAST(tic_hall_id AS INT) = hall_hall_id AND tic_loc_id = hall_loca_id
  LEFT JOIN hall_type ON halltype = halltype_id
  JOIN timetable ON showid = TRY_CAST(tic_show_id AS INT) AND locid = tic_loc_id
    AND CAST(try_strptime(substr(showdate, 1, 26), '%Y-%m-%d %H:%M:%S.%f') AS DATE) = CAST(tic_show_date AS DATE)
    AND TRY_CAST(showtime AS INT) = TRY_CAST(tic_show_time AS INT) AND filmid = TRY_CAST(tic_film_id AS INT)
  WHERE tic_booking_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM refund
    WHERE TRY_CAST(tic_booking_id AS DOUBLE) = TRY_CAST(refund_booking_id AS DOUBLE)
      AND tic_col_id = refund_col_id AND tic_row_id = refund_row_id))
"""
BAND = """CASE WHEN show_time BETWEEN 560 AND 2299 THEN 'Early (before 1pm)'
    WHEN show_time IS NOT NULL THEN 'Midnight (10pm onwards)' END"""


def rollup_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(rollups.rollup_day(grain(spark, sf_dir)))


def rollup_day_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(rollups.rollup_day_hour(grain(spark, sf_dir)))


def rollup_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(rollups.rollup_both(grain(spark, sf_dir)))


def rollup_show(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rollup_show(grain(spark, sf_dir))


def _published(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decimals_to_double(rollups.published(grain(spark, sf_dir))[name])

    query.__doc__ = f"The table {name} with its published headings."
    return query


def rollup_show_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rollup_show_once(shown(spark, sf_dir))


def timetable_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = rollups.with_timetable(derive(spark, sf_dir, SOLD), derive(spark, sf_dir, TIMETABLE))
    return joined.select("tic_booking_id", "tic_row_id", "tic_col_id", "showid", "showdate", "totalseats")


def hall_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = derive(spark, sf_dir, SOLD)
    found = rollups.with_halls(sold, derive(spark, sf_dir, HALLS), derive(spark, sf_dir, HALL_TYPES))
    return found.select("tic_booking_id", "tic_row_id", "tic_col_id", "tic_hall_id", "hall_hall_id", "halltype_name")


def unsold_shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shows of the timetable for which no ticket exists."""
    shows = derive(spark, sf_dir, TIMETABLE).where("showid IS NOT NULL").select("showid", "totalseats")
    sold = derive(spark, sf_dir, SOLD).selectExpr("try_cast(tic_show_id AS INT) AS showid")
    return drop_matches(shows, sold, "showid")


KEYS = "movie_date, location_id, film_id, hall_id, hall_type"
QUERIES = {
    "ticket_sales_view": ticket_sales_view,
    "ticket_measures": ticket_measures,
    "refund_anti": refund_anti,
    "hall_lookup": hall_lookup,
    "timetable_join": timetable_join,
    "unsold_shows": unsold_shows,
    "rollup_day": rollup_day,
    "rollup_day_hour": rollup_day_hour,
    "rollup_show": rollup_show,
    "rollup_show_once": rollup_show_once,
    "rollup_grouping_sets": rollup_grouping_sets,
    "new_tic_tbl_byday": _published("new_tic_tbl_byday"),
    "new_tic_tbl_hourly": _published("new_tic_tbl_hourly"),
    "new_showtime_hourly": _published("new_showtime_hourly"),
}
PUBLISHED = """movie_date AS "movie date", location_id AS "location id", film_id AS tic_film_id, hall_id AS tic_hall_id, hall_type"""
ORACLES = {
    "ticket_sales_view": with_inputs(TICKET_SALES_SQL, **VIEW_INPUTS),
    "ticket_measures": with_inputs(
        f"""SELECT ttd_loc_id, ttd_pos_no, CAST(ROUND(SUM({NBO}), 2) AS DOUBLE) AS nbo,
        COUNT(DISTINCT ttd_ticket_no) AS admission, COUNT(DISTINCT ttd_booking_id) AS transactions,
        CAST(ROUND(SUM({NBO}), 2) AS DOUBLE) / NULLIF(CAST(COUNT(DISTINCT ttd_ticket_no) AS DOUBLE), 0) AS atp,
        ROUND(CAST(COUNT(DISTINCT ttd_ticket_no) AS DOUBLE) / CAST(SUM(totalseats) AS DOUBLE) * 100, 2) AS occupancy_rate
        FROM ticket JOIN schedule ON TRY_CAST(ttd_show_id AS BIGINT) = showid GROUP BY ALL""",
        ticket=TICKETS, schedule=SCHEDULES,
    ),
    "refund_anti": with_inputs(REFUND_ANTI_SQL, ticket=TICKETS, refund=REFUNDS),
    "hall_lookup": with_inputs(
        """SELECT tic_booking_id, tic_row_id, tic_col_id, TRY_CAST(tic_hall_id AS INT) AS tic_hall_id, hall_hall_id,
        halltype_name FROM sold LEFT JOIN hall ON TRY_CAST(tic_hall_id AS INT) = hall_hall_id
        AND tic_loc_id = hall_loca_id LEFT JOIN hall_type ON halltype = halltype_id""",
        sold=SOLD, hall=HALLS, hall_type=HALL_TYPES,
    ),
    "timetable_join": with_inputs(
        """SELECT tic_booking_id, tic_row_id, tic_col_id, showid,
        CAST(try_strptime(substr(showdate, 1, 26), '%Y-%m-%d %H:%M:%S.%f') AS DATE) AS showdate, totalseats
        FROM sold JOIN timetable ON showid = TRY_CAST(tic_show_id AS INT) AND locid = tic_loc_id
        AND CAST(try_strptime(substr(showdate, 1, 26), '%Y-%m-%d %H:%M:%S.%f') AS DATE) = CAST(tic_show_date AS DATE)
        AND TRY_CAST(showtime AS INT) = TRY_CAST(tic_show_time AS INT) AND filmid = TRY_CAST(tic_film_id AS INT)""",
        sold=SOLD, timetable=TIMETABLE,
    ),
    "unsold_shows": with_inputs(
        """SELECT showid, totalseats FROM timetable WHERE showid IS NOT NULL
        AND showid NOT IN (SELECT CAST(tic_show_id AS INT) FROM sold)""",
        sold=SOLD, timetable=TIMETABLE,
    ),
    "rollup_day": with_inputs(
        SHOWN_SQL + f"SELECT {KEYS}, CAST(SUM(net) AS DOUBLE) AS nbo, COUNT(*) AS admission FROM shown GROUP BY {KEYS}",
        **ROLLUP_INPUTS,
    ),
    "rollup_day_hour": with_inputs(
        SHOWN_SQL + f"""SELECT {KEYS}, show_time, CAST(SUM(net) AS DOUBLE) AS nbo, COUNT(*) AS admission
        FROM shown GROUP BY {KEYS}, show_time""",
        **ROLLUP_INPUTS,
    ),
    "rollup_grouping_sets": with_inputs(
        SHOWN_SQL + f"""SELECT {KEYS}, show_time, CAST(GROUPING(show_time) AS INT) AS level,
        CAST(SUM(net) AS DOUBLE) AS nbo, COUNT(*) AS admission
        FROM shown GROUP BY GROUPING SETS (({KEYS}, show_time), ({KEYS}))""",
        **ROLLUP_INPUTS,
    ),
    "rollup_show": with_inputs(
        SHOWN_SQL + f"""SELECT movie_date, film_id, location_id, show_time AS showtime, {BAND} AS showtime_grp, hall_no,
        hall_type, CAST(SUM(totalseats) AS BIGINT) AS total_seats, COUNT(show_id) AS number_of_shows
        FROM shown GROUP BY ALL""",
        **ROLLUP_INPUTS,
    ),
    "new_tic_tbl_byday": with_inputs(
        SHOWN_SQL + f"""SELECT {PUBLISHED}, CAST(SUM(net) AS DOUBLE) AS "NBO", COUNT(*) AS admission FROM shown GROUP BY ALL""",
        **ROLLUP_INPUTS,
    ),
    "new_tic_tbl_hourly": with_inputs(
        SHOWN_SQL + f"""SELECT {PUBLISHED}, show_time AS tic_show_time, CAST(SUM(net) AS DOUBLE) AS "NBO", COUNT(*) AS admission
        FROM shown GROUP BY ALL""",
        **ROLLUP_INPUTS,
    ),
    "new_showtime_hourly": with_inputs(
        SHOWN_SQL + f"""SELECT movie_date AS "movie date", film_id AS "movie id", location_id AS "location id", show_time AS showtime,
        {BAND} AS showtime_grp, hall_no, hall_type, CAST(SUM(totalseats) AS BIGINT) AS "total seats",
        COUNT(show_id) AS "no of show" FROM shown GROUP BY ALL""",
        **ROLLUP_INPUTS,
    ),
    "rollup_show_once": with_inputs(
        SHOWN_SQL + f"""SELECT movie_date, film_id, location_id, show_time AS showtime, {BAND} AS showtime_grp, hall_no,
        hall_type, CAST(SUM(totalseats) AS BIGINT) AS total_seats, COUNT(show_id) AS number_of_shows
        FROM (SELECT DISTINCT movie_date, film_id, location_id, show_time, hall_no, hall_type, show_id, totalseats
          FROM shown) GROUP BY ALL""",
        **ROLLUP_INPUTS,
    ),
}
