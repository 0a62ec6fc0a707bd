"""Whole jobs on small literal tables with their edge rows."""

import datetime as dt
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import parts
from ledgerloom.plans import (
    alarms, catalogue, feeds, film, forecast, images, power, refunds, sales_portfolio, snapshots, telemetry,
    ticket_rollups, ticket_view,
)
from ledgerloom.session import scratch_dir
from ledgerloom.sinks import files as file_sinks
from ledgerloom.sinks import tables as table_sinks
from ledgerloom.sources import feeds as feed_sources
from ledgerloom.sources import files as file_sources
from ledgerloom.sources import tables as table_sources
from ledgerloom.sources.trades import generated_trades

NOW = "2020-03-04 05:06:07.000008"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def ticket(booking="12", row="A", col="1", **other):
    base = dict(
        ttd_loc_id=1, ttd_bus_date="2019-03-05", ttd_booking_id=booking, ttd_show_id="7", ttd_row_id=row, ttd_col_id=col,
        ttd_pos_no="EPAY", ttd_film_id="5", ttd_hall_id="2", ttd_trxn_date="2019-03-04 13:10:00.5", ttd_ticket_no="100",
        ttd_tkt_type="T1", ttd_tkt_amt=10.0, ttd_tkt_gst_amt=1.0, ttd_tkt_ent_tax=0.5, ttd_tkt_bkg_fee_amt=2.0,
        ttd_tkt_bkg_fee_gst_amt=0.25, ttd_tkt_surc_amt=1.5, ttd_tkt_surc_gst_amt=0.5, ttd_pymt_channel_type="card",
        ttd_show_time="1900", ttd_show_date="5/3/2019", ttd_pymt_platform="",
    )
    return {**base, **other}


TICKET_SCHEMA = ", ".join(
    f"{name} {'bigint' if name == 'ttd_loc_id' else 'double' if name.endswith(('_amt', '_tax')) else 'string'}"
    for name in ticket()
)


@pytest.fixture
def view(spark, frame):
    def run(*tickets, headings=False, parents=((3,),)):
        schedule = frame("showid bigint, locid bigint, showdate string, totalseats bigint",
                         (7, 1, "2019-03-05 00:00:00.0", 40), (8, 1, "", 40))
        early = schedule.withColumn("locid", F.col("locid").cast("string"))
        return ticket_view.ticket_sales(
            spark.createDataFrame([tuple(t.values()) for t in tickets], TICKET_SCHEMA),
            frame("trd_booking_id string, trd_row_id string, trd_col_id string", ("12.0", "R", "9"), ("x", "A", "1")),
            frame("film_id bigint, film_film_parent_id double", (5, 3.0)),
            frame("flm_parent_id bigint", *parents),
            frame("tkt_type_id string, tkt_type_seat_type string", ("T1", "sofa")),
            [early, schedule, schedule], headings=headings,
        )

    return run


def test_ticket_view_values(view):
    got = view(ticket()).collect()
    assert len(got) == 1
    row = got[0].asDict()
    assert row["movie_date"] == dt.datetime(2019, 3, 5) and row["transaction_date"] == dt.datetime(2019, 3, 4, 13, 10, 0, 500000)
    assert (row["nbo"], row["gbo"], row["admission"], row["atp"]) == (9.5, 11.5, 1, 9.5)
    assert (row["net_ticket_price"], row["net_surcharge"], row["net_booking_fee"]) == (8.5, 1.0, 1.75)
    assert (row["occupancy_rate"], row["hourly_sales"], row["seat_type"]) == (2.5, "01:00PM", "sofa")
    assert (row["platform"], row["source"], row["seat_number"]) == ("ONLINE", "ONLINE", "A1")


def test_ticket_view_drops_refunds_and_unbooked(view):
    kept = view(
        ticket(), ticket(row="R", col="9"), ticket(booking=None, col="2"), ticket(booking="x", col="3"),
        ticket(ttd_show_date="", col="4"), ticket(ttd_show_id="8", col="5"),
    )
    assert sorted(r["seat_column"] for r in kept.collect()) == [1, 3]


def test_ticket_view_without_ticket_number(view):
    row = view(ticket(ttd_ticket_no=None)).first()
    assert (row["admission"], row["atp"], row["occupancy_rate"]) == (0, None, 0.0)


def test_ticket_view_headings_and_duplicate_parents(view):
    got = view(ticket(), headings=True, parents=((3,), (3,)))
    assert got.columns == list(ticket_view.HEADINGS.values()) and len(got.columns) == 36
    assert got.first()["Ticket Amount"] == 20.0


def test_ticket_view_in_parts_gives_the_same_rows_and_leaves_no_shuffle_files(spark, frame):
    days = ["2019-03-05", "5/3/2019", "2019-03-06"]
    tickets = [
        ticket(booking=str(n % 40), row=f"R{n % 7}", col=str(n % 5), ttd_show_id=None if n % 31 == 0 else str(n % 12),
               ttd_show_date=days[n % 3], ttd_film_id=str(n % 4), ttd_tkt_type=f"T{n % 3}", ttd_ticket_no=str(n % 90))
        for n in range(400)
    ]
    schedule = frame(
        "showid bigint, locid bigint, showdate string, totalseats bigint",
        *[(n, 1, f"2019-03-0{5 + n % 2} 00:00:00.0", 40 + n) for n in range(13)], (3, 1, "2019-03-05 00:00:00.0", 9), (None, 1, "2019-03-05 00:00:00.0", 9),
    )
    tables = (
        spark.createDataFrame([tuple(t.values()) for t in tickets], TICKET_SCHEMA).repartition(6),
        frame("trd_booking_id string, trd_row_id string, trd_col_id string", *[(f"{n}.0", f"R{n % 7}", str(n % 5)) for n in range(0, 40, 3)]),
        frame("film_id bigint, film_film_parent_id double", (1, 3.0), (2, 4.0), (2, 3.0), (3, None)),
        frame("flm_parent_id bigint", (3,), (3,), (None,)),
        frame("tkt_type_id string, tkt_type_seat_type string", ("T1", "sofa"), ("T1", "bed"), ("T2", None)),
        [schedule, schedule.where("showid < 5")],
    )
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        return {name for name in files.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}

    whole = rows(ticket_view.ticket_sales(*tables, headings=False))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffle_files()
        got = ticket_view.ticket_sales(*tables, parts=5)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for _ in range(100):
        if not (left := shuffle_files() - before):
            break
        time.sleep(0.1)
    assert not left
    assert got.columns == list(ticket_view.HEADINGS.values()) and len(whole) > 100 and rows(got) == whole
    assert spark.conf.get(parts.CLEANUP) == "false"


def test_parts_follow_from_the_size_of_the_files(spark, tmp_path):
    spark.range(100_000).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    joined = df.join(df.withColumnRenamed("id", "other"), F.col("id") == F.col("other"))
    assert parts.parts_for(df, size) == 1 and parts.parts_for(df, size - 1) == 2 and parts.parts_for(joined, size) == 2
    assert parts.parts_for(df) == 1 and parts.parts_for(spark.createDataFrame([(1,)], "id int").rdd.toDF()) == 1


def test_portfolio_columns_and_flags(frame):
    customers = frame(
        "rid bigint, subscribe_time string, offer_id bigint, offer_price double, affiliate_id bigint, resub bigint,"
        " unsubscribe_time string, total_billed double",
        (1, "2019-01-01 10:00:00.0", 10, 0.0, 20, 9, "2019-01-01 12:00:00.0", 1.0),
        (2, "2019-01-01 10:00:00.0", 10, 3.0, 20, 9, None, 1.0),
        (3, "2017-12-31 10:00:00.0", 10, 3.0, 20, 9, None, 1.0),
    )
    data = frame(
        "rid bigint, click_time string, flow_type string, remote_ip string, carrier string, ref_table_id bigint",
        (100, "2019-01-01 09:00:00.5", "4", "1.2.3.4", "", 1), (101, None, "4", "1.2", None, 2),
        (102, None, "x", "1", "t", 1), (103, None, "4", "", "t", 3),
    )
    info = frame("charge_price double, info_category string, dn_status bigint", (1.0, "first", 1), (0.0, "first", 1))
    args = (
        customers, data, info, frame("offer_id bigint, name string", (10, "o")),
        frame("aff_id bigint, name string", (20, "a")), frame("flow_id bigint, flow_name string", (4, "f")),
    )
    got = sales_portfolio.sales_portfolio(*args, "gate", "my", "2020-07-09")
    assert len(sales_portfolio.PORTFOLIO) == 52
    picked = got.select(
        "ref_cust_data_table_rid", "click_time", "ip2", "ip3", "connection_type", "optout24", "free_pixels_count",
        "pixels_count", "first_billing_count", "resub", "free_sales_count", "update_year", "update_month", "subscribe_time",
    )
    assert rows(picked) == [
        (100, "2019-01-01 09:00:00.5", "1.2", "1.2.3", "wifi", 1, 1, 0, 1, 0, 0, "2020", "07", "2019-01-01 10:00:00"),
        (101, None, "1.2", None, "3g", 0, 0, 1, 1, 0, 0, "2020", "07", "2019-01-01 10:00:00"),
    ]
    none = sales_portfolio.sales_portfolio(args[0], args[1], info.where("charge_price < 0"), *args[3:], "g", "m", "2020-07-09")
    assert rows(none.select("ref_cust_table_rid", "first_billing_count")) == [(1, 0), (2, 0)]


def test_rollups_count_tickets_or_shows(frame):
    sold = frame(
        "tic_booking_id string, tic_col_id string, tic_row_id string, tic_hall_id string, tic_show_id string,"
        " tic_show_time string, tic_film_id string, tic_loc_id string, tic_show_date string, tic_bus_date string,"
        " tic_tkt_amt double, tic_tkt_gst_amt double, tic_tkt_ent_tax double, tic_tkt_surc_amt double,"
        " tic_tkt_surc_gst_amt double",
        ("1", "1", "A", "2", "7", "1330", "5", "L", "2019-03-05", "5/3/2019", 10.0, 1.0, 0.5, 1.0, 0.5),
        ("2", "2", "A", "2", "7", "1330", "5", "L", "2019-03-05", "2019-03-05", 10.0, 1.0, 0.5, 1.0, 0.5),
        ("3", "3", "A", "9", "7", "1330", "5", "L", "2019-03-05", "2019-03-05", 10.0, None, 0.5, 1.0, 0.5),
        ("4", "4", "A", "2", "7", "1330", "5", "L", "2019-03-05", "2019-03-05", 10.0, 1.0, 0.5, 1.0, 0.5),
        (None, "5", "A", "2", "7", "1330", "5", "L", "2019-03-05", "2019-03-05", 10.0, 1.0, 0.5, 1.0, 0.5),
    )
    refunded = frame("refund_booking_id string, refund_col_id string, refund_row_id string",
                     ("4.0", "4", "A"), (None, "1", "A"), ("", "2", "A"))
    shown = ticket_rollups.shown_tickets(
        sold, refunded, frame("hall_hall_id int, hall_loca_id string, halltype string", (2, "L", "h")),
        frame("halltype_id string, halltype_name string", ("h", "grand")),
        frame("showid int, locid string, showdate string, showtime string, filmid int, totalseats bigint",
              (7, "L", "2019-03-05 00:00:00.000000000", "1330", 5, 40), (None, "L", "", "1330", 5, 40)),
    )
    grain = ticket_rollups.show_grain(shown).cache()
    day = dt.date(2019, 3, 5)
    assert rows(ticket_rollups.rollup_day(grain)) == [(day, "L", 5, 2, "grand", 18.0, 2), (day, "L", 5, 9, None, None, 1)]
    assert len(ticket_rollups.rollup_day_hour(grain).columns) == 8
    show = ticket_rollups.rollup_show(grain).where("hall_no = 2").first()
    assert (show["total_seats"], show["number_of_shows"], show["showtime_grp"]) == (80, 2, "Early (before 1pm)")
    once = ticket_rollups.rollup_show_once(shown, strict_bands=True).where("hall_no = 2").first()
    assert (once["total_seats"], once["number_of_shows"]) == (40, 1)
    assert once["showtime_grp"] == "Afternoon (1pm - 5:59pm)"
    assert ticket_rollups.with_show_hour(grain).first()["hourly_sales"] == "1:00PM"
    both = ticket_rollups.rollup_both(grain)
    assert both.where("level = 1").count() == 2 and both.where("level = 0").count() == 2


def test_forecast_cut_and_flags(frame):
    calendar = frame(
        "date string, isKLPublicHoliday double, isSelangorPublicHoliday double, isSchoolHoliday double",
        ("31/8/2020", None, None, None), ("29/2/2020", 0.0, None, None), ("28/02/2020", None, None, None),
        ("1/3/2020", 1.0, None, None),
    )
    sales = frame("`Item Number` string, Day string, `Sales Qty` double",
                  ("a", "31/8/2020", 1.0), ("b", "29/2/2020", 1.0), ("c", "28/2/2020", 1.0), ("d", "1/3/2020", 1.0))
    assert rows(forecast.forecast_table(sales, calendar)) == [
        ("b", dt.date(2020, 2, 29), "1"), ("c", dt.date(2020, 2, 28), "0"),
    ]


def line(row_no, **fields):
    return (row_no, *[fields.get(name, "") for name in catalogue.COLUMNS])


def test_catalogue_load(frame):
    schema = "row_no bigint, " + ", ".join(f"`{c}` string" for c in catalogue.COLUMNS)
    lines = frame(
        schema,
        line(1, item_name="tea", category_code="12", category="drinks", department="food", sub_department="hot",
             group_code="12345", delivery_price="10", delivery_discount="4", pickup_discount="10%", image="a, b"),
        line(2, item_name="tea", category_code="12", category="drinks", department="food", sub_department="hot",
             group_code="123456", delivery_price="", delivery_discount="0", image="b"),
        line(3, item_name="jam", category_code="0777", category="known", department="food", sub_department="old",
             discount_start="2/3/2020", image="c"),
        line(4, item_name="oil", category_code="555", category="lost", department="other", sub_department="food", image="b"),
        line(5, item_name="oil", category_code="555", category="lost", department="other", sub_department="food", image="b"),
    )
    changes = catalogue.catalogue_load(
        lines, frame("name string, productId string", ("jam", "p1"), ("jam", "p2")),
        frame("categoryId string, code string, parentId string, title string",
              ("c1", "0777", "c2", "known"), ("c2", "01", "-", "top"), ("c3", "0555", "-", "taken")),
        frame("departmentId string, title string, parentId string", ("d1", "old", "d9"), ("d2", "other", "d9"), ("d3", "other", "-")),
        frame("productTaggingId string, title string", ("t1", "c")), NOW,
    )
    products = {r["name"]: r for r in changes["product"].collect()}
    assert set(products) == {"tea", "jam", "oil"} and products["jam"]["productId"] == "p2"
    tea, jam, oil = products["tea"], products["jam"], products["oil"]
    assert (tea["productGroupCode"], tea["price"], tea["discountedPrice"], tea["image"]) == ("123456", 1.0, None, "b")
    assert (jam["divisionCode"], jam["divisionDesc"], jam["itemCategoryCode"]) == ("01", "top", "0777")
    assert jam["discountStartDate"] == "2020-02-03T00:00:00.000000Z"
    # The row that adds a category is its own division; a later one finds the code's first owner.
    assert (oil["divisionCode"], oil["divisionDesc"], oil["itemCategoryCode"]) == ("0555", "taken", "555")
    assert rows(changes["category"].select("code", "title", "parentId")) == [("012", "drinks", "-"), ("0555", "lost", "-")]
    assert rows(changes["department"].select("title", "parentId")) == [("food", "-"), ("hot", "-")]
    assert changes["department"].first()["effectiveEndDate"] == "2020-12-31T23:59:59.999Z"
    new = {r["title"]: r["departmentId"] for r in changes["department"].collect()}
    pairs = {(r[0], r[1]) for r in changes["product_department"].select(
        "productDepartmentDepartmentId", "productDepartmentProductId").collect()}
    assert pairs == {(new["food"], tea["productId"]), (new["hot"], tea["productId"]), (new["food"], "p2")}
    assert rows(changes["tagging"].select("title")) == [("a",), ("b",)]
    assert changes["tagging_mapping"].count() == 4
    assert changes["tagging_mapping"].where("productTaggingMappingProductTaggingId = 't1'").count() == 1


def test_numbered_latin_csv(spark):
    path = scratch_dir(spark, "latin-fixture")
    text = "item_code,item_name\n1,\"a, b\"\n2,\"café\nbar \"\"x\"\"\"\n3,\n"
    (spark.createDataFrame([(bytearray(text.encode("iso-8859-1")),)], "b binary"))
    import os
    os.makedirs(path)
    with open(f"{path}/list.csv", "wb") as out:
        out.write(text.encode("iso-8859-1"))
    schema = catalogue.T.StructType(catalogue.SCHEMA.fields[:2])
    got = file_sources.numbered_csv(spark, path, schema).orderBy("row_no")
    assert [tuple(r)[1:] for r in got.collect()] == [("1", "a, b"), ("2", 'café\nbar "x"'), ("3", "")]


def test_pending_refunds(frame):
    got = refunds.pending_refunds(
        frame("orderNumber string, refundAmount double, refundTransactionId string, paymentMethod string,"
              " refundReason string, emailRefundStatus boolean",
              ("1", 2.5, "t", "card", "late", False), ("2", 2.5, "t", "card", "late", True), ("3", 1.0, "t", "c", "r", None)),
        NOW,
    )
    assert got.columns == ["Order Number", "Date Created", "Amount", "TXN ID", "Payment Method", "Reason"]
    assert rows(got) == [("1", "2020-03-04T05:06:07.000008Z", 2.5, "t", "card", "late")]


def test_image_registration(frame):
    products = frame("productId string, sku string, image string",
                     ("p1", "000001", "old"), ("p2", "000002", "none"), ("p3", "000001", "other"))
    members = frame("archive string, pos bigint, filename string",
                    ("z", 0, "000001_a.jpg"), ("z", 1, "000002_a.jpg"), ("z", 2, "000002_b.jpg"), ("z", 3, "999999_a.jpg"))
    existing = frame("productImageProductId string", ("p1",), ("p1",))
    got = images.register_images(members, products, existing, "now")
    assert rows(got.select("productImageProductId", "sequence", "image", "first")) == [
        ("p1", 2, "product/images/000001_a.jpg", False), ("p2", 0, "product/images/000002_a.jpg", True),
        ("p2", 1, "product/images/000002_b.jpg", False),
    ]
    assert rows(images.with_main_images(products, got)) == [
        ("p1", "000001", "old"), ("p2", "000002", "product/images/000002_a.jpg"), ("p3", "000001", "other"),
    ]


def test_archive_members(spark, tmp_path):
    for name in ("b", "a"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as archive:
            archive.writestr("000001_x.jpg", b"123")
            archive.writestr("000002_y.jpg", b"")
    (tmp_path / "skip.txt").write_text("no archive")
    got = file_sources.archive_members(spark, str(tmp_path))
    assert rows(got.select(F.element_at(F.split("archive", "/"), -1), "pos", "filename", "size")) == [
        ("a.zip", 0, "000001_x.jpg", 3), ("a.zip", 1, "000002_y.jpg", 0),
        ("b.zip", 0, "000001_x.jpg", 3), ("b.zip", 1, "000002_y.jpg", 0),
    ]


def test_rendition_plan(frame):
    plan = images.rendition_plan(
        frame("key string, width int, height int", ("s.png", 50, 50), ("l.jpg", 1600, 900), ("p.jpg", 900, 1600), ("t.jpg", 3000, 10))
    )
    got = {}
    for r in plan.collect():
        got.setdefault(r["key"], set()).add(r["target_key"])
    assert got["s.png"] == {"s_50_50.png"}
    assert got["l.jpg"] == {"l_50_28.jpg", "l_100_56.jpg", "l_200_112.jpg", "l_400_225.jpg", "l_800_450.jpg", "l_1600_900.jpg"}
    assert "p_28_50.jpg" in got["p.jpg"] and len(got["p.jpg"]) == 6
    # 50, 100 and 200 would leave a side of 0.
    assert got["t.jpg"] == {"t_400_1.jpg", "t_800_2.jpg", "t_1600_5.jpg"}


@pytest.mark.parametrize(
    ("start", "expected", "label"),
    [
        (None, ("2020-07-08", "2020-07-08", False), "2020-07-08"),
        ("2020-07-08", ("2020-07-08", "2020-07-08", False), "2020-07-08"),
        ("2020-01-31", ("2020-01-31", "2020-02-29", True), "2020-02-28"),
        ("2019-12-15", ("2019-12-15", "2020-01-15", True), "2020-01-14"),
        ("2020-06-20", ("2020-06-20", "2020-07-08", True), "2020-07-07"),
    ],
)
def test_load_ranges(start, expected, label):
    first, following, backfill = feeds.load_range(start, "2020-07-09")
    assert (str(first), str(following), backfill) == expected
    assert str(feeds.range_end_label(first, following, "2020-07-09")) == label


def test_range_cut(frame):
    records = frame("id int, updated_at string", (1, "2020-01-31T10:00:00Z"), (2, "2020-02-28T23:59:59Z"),
                    (3, "2020-02-29T00:00:00Z"), (4, "2020-07-08T23:00:00Z"), (5, "2020-07-09T00:00:00Z"))
    assert rows(feeds.updated_in_range(records, "2020-01-31", "2020-07-09").select("id")) == [(1,), (2,)]
    assert rows(feeds.updated_in_range(records, None, "2020-07-09").select("id")) == [(4,)]


def test_json_pages_with_differing_keys(spark, tmp_path):
    (tmp_path / "p1.json").write_text('[{"id": 1, "b": "x"}, {"b": "y", "id": 2}]\n[{"id": 3, "c": true}]\n')
    assert rows(feed_sources.json_pages(spark, str(tmp_path)).select("id", "b", "c")) == [
        (1, "x", None), (2, "y", None), (3, None, True),
    ]


def test_named_reading(frame):
    def body(items):
        return ("<soap:Envelope xmlns:soap='u'><soap:Body><GetSlaveResponse><GetSlaveResult><Items>" + items
                + "</Items></GetSlaveResult></GetSlaveResponse></soap:Body></soap:Envelope>")

    hit = "<Item><Name>Total system power</Name><Value>{}</Value><Units>kW</Units></Item>"
    no_units = "<Item><Name>Total system power</Name><Value>9</Value></Item>"
    responses = frame("c int, body string", (901, body(hit.format("1.5") + hit.format("2"))), (902, body("")),
                      (903, body(hit.format(""))), (904, body(no_units)), (905, None))
    assert rows(feed_sources.named_reading(responses, ["c"], "body")) == [
        (901, "1.5"), (902, "0.00"), (903, "0.00"), (904, "0.00"), (905, "0.00"),
    ]


def test_telemetry_keys_and_text(frame):
    assert len(telemetry.PARAMETER_KEYS) == 49
    body = '{"Resources": {"ID": "d1", "Created": "2020-01-31T15:55:07.000Z", "Data": {"energy": {"unit": "kWh", "value": 1.5},' \
           ' "current": {"value": {"B": 3.0}}}, "Response": {"status": "ok"}, "Topic": "t"}}'
    flat = telemetry.flat_messages(frame("body string", (body,)), "body")
    row = flat.withColumn("text", telemetry.delivery_text(flat)).first()
    assert row["ResourcesCreated"] == "2020-02-01T00:00:07" and row["created"] == dt.datetime(2020, 1, 31, 23, 55, 7)
    assert row["ResourcesDatacurrentvalueB"] == 3.0
    assert row["text"].startswith("&DeviceID=d1&DateTimestamp=2020-02-01T00:00:07&ms1=kWh&ms2=1.5&ms3=NULL")
    # The misspelt keys stay absent.
    assert "&ms29=NULL" in row["text"] and row["text"].endswith("&ms47=ok&ms48=NULL&ms49=t")


def test_power_changes(spark):
    readings = spark.sql(
        """SELECT c AS controller, CAST(t AS TIMESTAMP_NTZ) AS ts, r AS reading FROM VALUES
        (901, '2020-01-01 23:41:00', '1.00'), (901, '2020-01-01 23:48:00', '2.00'), (902, '2020-01-01 23:45:00', '5.00'),
        (901, '2020-01-01 23:55:00', '4.50'), (901, '2020-01-02 00:15:00', '9.00'), (999, '2020-01-02 05:00:00', '1')
        AS v(c, t, r)"""
    )
    out = power.power_output(power.power_changes(power.wide_bins(readings))).orderBy("Time")
    assert out.columns[:2] == ["Time", "901 Total system power {kW}"] and len(out.columns) == 13
    got = {r["Time"]: (r[1], r[2], r["year"] + r["month"] + r["day"]) for r in out.collect()}
    assert got == {
        "01/01/2020 23:50:00": (0.0, 0.0, "20200101"),
        # The bin ends on the next day; the folder follows the poll's own day.
        "02/01/2020 00:00:00": (2.5, -5.0, "20200101"),
        "02/01/2020 00:20:00": (0.0, 0.0, "20200102"),
    }


def test_alarms_for_named_functions(spark, frame):
    lines = frame("value string", ("      FunctionName: one\n",), ("Runtime: two",), ("  FunctionName: three",))
    calls = spark.sql("""SELECT f AS FunctionName, CAST('2020-01-01 01:00:00' AS TIMESTAMP_NTZ) AS ts, n AS Invocations
        FROM VALUES ('one', 10), ('two', 50), ('three', 9) AS v(f, n)""")
    assert rows(alarms.invocation_alarms(lines, calls).select("FunctionName", "total")) == [("one", 10)]


def test_retention_at_five_days(spark):
    manifest = spark.sql(
        """SELECT n AS DBSnapshotIdentifier, CAST(t AS TIMESTAMP_NTZ) AS SnapshotCreateTime FROM VALUES
        ('a-reporting', '2020-01-05 00:00:00'), ('b-reporting', '2020-01-05 00:00:01'), ('c-other', '2019-01-01 00:00:00')
        AS v(n, t)"""
    )
    assert rows(snapshots.retention(manifest, "2020-01-10 00:00:00")) == [("a-reporting", 5, "delete"), ("b-reporting", 4, "keep")]


def test_film_schema_and_bucketed_table(spark, frame):
    kinds = [f.dataType.simpleString() for f in film.SCHEMA.fields]
    assert (len(kinds), kinds.count("string"), kinds.count("bigint"), kinds.count("double")) == (47, 36, 5, 6)
    name = "films_" + scratch_dir(spark, "t")[-8:]
    film.save_film_table(frame("film_id bigint, film_title string", (1, "a"), (2, "b")), name, 4)
    joined = spark.table(name).join(spark.table(name).groupBy("film_id").count(), "film_id")
    assert joined.count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_generated_trades_repeat(spark):
    first, second = rows(generated_trades(spark)), rows(generated_trades(spark).repartition(3))
    assert first == second and len(first) == 1001
    row = generated_trades(spark).where("Buy_Broker_Code = '7'").first()
    assert (row["Sell_Broker_Code"], row["Buy_Account_Code"], row["Sell_Account_Code"]) == ("994", "100000007", "100000994")
    assert row["Buy_Trade_Origin"] == row["Sell_Trade_Origin"] and len(row["Price"]) <= 4


def test_gateway_names():
    assert table_sources.split_gateway_key("gate_my") == ("gate", "my")
    assert table_sinks.portfolio_table("gate", "my") == "gateway_cust_portfolio_gate_my"
    assert file_sinks.range_named_path("f", "n", "a", "b").startswith("f/n(a_b)")


def test_discover_table(spark, frame):
    path, name = scratch_dir(spark, "discover"), "found_" + scratch_dir(spark, "t")[-8:]
    frame("a int", (1,)).write.parquet(f"{path}/p=1")
    frame("a int, b string", (2, "x")).write.parquet(f"{path}/p=2")
    assert set(table_sources.discover_table(spark, name, path).columns) == {"a", "b", "p"}
    spark.sql(f"DROP TABLE {name}")
