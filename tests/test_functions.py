"""Column functions on literal values: every branch, NULL and blank."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import casts, dates, labels, texts


def apply(spark, column, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def test_safe_casts(spark):
    assert apply(spark, casts.safe_bigint("v"), ["12", "x", "", None]) == [12, None, None, None]
    assert apply(spark, casts.safe_bigint_via_double("v"), ["12", "12.0", "2.7", "x", None]) == [12, 12, 2, None, None]


def test_number_defaults(spark):
    assert apply(spark, casts.number_or("v"), ["", None, "2.3", "x"]) == [1.0, 1.0, 2.3, None]
    assert apply(spark, casts.percent_or("v"), ["10%", "", "0%"]) == [10.0, 1.0, 0.0]
    assert apply(spark, casts.scaled_price(F.lit(5.0), casts.percent_or("v")), ["10%", "0"]) == [50.0, None]


def test_blank_tests(spark):
    values = ["", None, "a"]
    assert apply(spark, casts.is_blank("v"), values) == [True, True, False]
    assert apply(spark, casts.not_blank("v"), values) == [False, False, True]
    assert apply(spark, F.coalesce(casts.not_null_or_not_empty("v"), F.lit(False)), values) == [True, False, True]


def test_mixed_layouts(spark):
    values = ["2019-03-05", "5/3/2019", "05/03/2019", "2019-3-5", "", None, "2019-13-01", "5-3", "1/2/3/4", "31/2/2020"]
    day = dt.date(2019, 3, 5)
    assert apply(spark, dates.mixed_layout_date("v"), values) == [day, day, day, day] + [None] * 6


def test_timestamp_text(spark):
    values = ["2019-03-05 01:02:03.5", "2019-03-05 01:02:03.123456", "2019-03-05 01:02:03", "", None, "x",
              "2019-03-05 25:00:00.0", "2019-03-05 01:02:03.0000000"]
    got = apply(spark, dates.parse_timestamp("v"), values)
    assert got == [
        dt.datetime(2019, 3, 5, 1, 2, 3, 500000), dt.datetime(2019, 3, 5, 1, 2, 3, 123456),
        dt.datetime(2019, 3, 5, 1, 2, 3), None, None, None, None, None,
    ]
    assert apply(spark, dates.date_of_text("v"), ["2019-03-05 01:02:03.000000000", ""]) == [dt.date(2019, 3, 5), None]


def test_month_first_iso(spark):
    assert apply(spark, dates.month_first_iso("v"), ["2/3/2020", "", None, "13/1/2020"]) == [
        "2020-02-03T00:00:00.000000Z", "", None, None,
    ]


def test_year_end_and_shift(spark):
    times = [dt.datetime(2020, 2, 29, 20, 0)]
    assert apply(spark, dates.year_end_stamp("v"), times, "timestamp_ntz") == ["2020-12-31T23:59:59.999Z"]
    assert apply(spark, dates.shift_hours("v"), times, "timestamp_ntz") == [dt.datetime(2020, 3, 1, 4, 0)]


def test_bin_end(spark):
    times = [
        dt.datetime(2020, 1, 1, 0, 0, 5), dt.datetime(2020, 1, 1, 0, 9, 59, 900000), dt.datetime(2020, 1, 1, 0, 10),
        dt.datetime(2020, 1, 31, 23, 55),
    ]
    assert apply(spark, dates.bin_end("v"), times, "timestamp_ntz") == [
        dt.datetime(2020, 1, 1, 0, 10), dt.datetime(2020, 1, 1, 0, 10), dt.datetime(2020, 1, 1, 0, 20),
        dt.datetime(2020, 2, 1),
    ]
    kept = apply(spark, dates.bin_end("v", keep_seconds=True), times, "timestamp_ntz")
    assert kept[:2] == [dt.datetime(2020, 1, 1, 0, 10, 5), dt.datetime(2020, 1, 1, 0, 10, 59)]


def test_ranges(spark):
    days = [dt.date(2020, 1, 31), dt.date(2020, 6, 20), dt.date(2020, 7, 8)]
    today = F.lit("2020-07-09").cast("date")
    following = dates.next_range_start("v", today)
    assert apply(spark, following, days, "date") == [dt.date(2020, 2, 29), dt.date(2020, 7, 8), dt.date(2020, 7, 8)]
    covered = dates.covered_range_end("v", following, today)
    assert apply(spark, covered, days, "date") == [dt.date(2020, 2, 28), dt.date(2020, 7, 7), dt.date(2020, 7, 8)]
    assert apply(spark, dates.months_before("v", 6), [dt.date(2020, 8, 31)], "date") == [dt.date(2020, 2, 29)]


@pytest.mark.parametrize(
    ("platform", "pos", "expected"),
    [
        ("", "EPAY", ("ONLINE", "ONLINE")), ("", "KIOSK01", ("KIOSK", "KIOSK")), ("", "IOS", ("POS", "MOBILE")),
        ("", "ANDROID", ("POS", "MOBILE")), ("", "C1", ("POS", "POS")), (None, "EPAY", ("POS", "POS")),
        ("APP", "EPAY", ("POS", "POS")), ("", None, ("POS", "POS")),
    ],
)
def test_channels(spark, platform, pos, expected):
    row = spark.createDataFrame([(platform, pos)], "a string, b string")
    assert tuple(row.select(labels.sale_platform("a", "b"), labels.sale_source("a", "b")).first()) == expected


def test_hour_labels(spark):
    hours = [0, 9, 10, 11, 12, 13, 21, 22, 23]
    times = [dt.datetime(2020, 1, 1, h) for h in hours]
    assert apply(spark, labels.hour_label("v"), [*times, None], "timestamp_ntz") == [
        "00:00AM", "09:00AM", "10:00AM", "11:00AM", None, "01:00PM", "09:00PM", "10:00PM", "11:00PM", None,
    ]
    assert apply(spark, labels.show_hour_label("v"), [30, 930, 1000, 1200, 1330, 2300], "int") == [
        "00:00AM", "09:00AM", "010:00AM", "0:00PM", "1:00PM", "11:00PM",
    ]


def test_bands(spark):
    times = [30, 559, 600, 1259, 1300, 1759, 1800, 2159, 2200, 2300, None]
    midnight, early = labels.BAND_MIDNIGHT, labels.BAND_EARLY
    assert apply(spark, labels.showtime_band("v"), times, "int") == [midnight] * 2 + [early] * 7 + [midnight, None]
    assert apply(spark, labels.showtime_band("v", strict=True), times, "int") == (
        [midnight] * 2 + [early] * 2 + [labels.BAND_AFTERNOON] * 2 + [labels.BAND_EVENING] * 2 + [midnight] * 2 + [None]
    )


def test_flags(spark):
    assert apply(spark, labels.connection_type("v"), ["", None, "x"]) == ["wifi", "3g", "3g"]
    assert apply(spark, labels.free_sale_flag("v"), [None, 1], "int") == ["1", "0"]
    free, paid = labels.pixel_flags(F.lit(1), "v")
    assert apply(spark, free, [0.0, 2.0, None], "double") == [1, 0, 0]
    assert apply(spark, paid, [0.0, 2.0, None], "double") == [0, 1, 0]
    assert apply(spark, labels.pixel_flags("v", F.lit(0.0))[0], [None], "int") == [0]
    assert apply(spark, labels.any_present_flag("v", F.lit(None)), [None, 0.0], "double") == ["0", "1"]
    assert apply(spark, labels.reading_or_zero("v"), ["", None, "1.5"]) == ["0.00", "0.00", "1.5"]


def test_same_day_flag(spark):
    pairs = spark.createDataFrame(
        [(dt.datetime(2020, 1, 1, 1), dt.datetime(2020, 1, 1, 23)), (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)),
         (dt.datetime(2020, 1, 1), None)],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in pairs.select(dates.same_day_flag("a", "b")).collect()] == [1, 0, 0]


def test_prefixed_code(spark):
    assert apply(spark, labels.prefixed_code("v", 3), ["1", "123", "1234", None]) == ["01", "0123", "1234", None]


def test_ip_prefix(spark):
    values = ["1.2.3.4", "1.2", "1", "1.", "", None, "1..3.4"]
    assert apply(spark, texts.ip_prefix("v", 2), values) == ["1.2", "1.2", None, None, None, None, None]
    assert apply(spark, texts.ip_prefix("v", 3), values) == ["1.2.3"] + [None] * 6


def test_texts(spark):
    assert apply(spark, texts.seat_number(F.lit("A"), "v"), ["07", "x", None]) == ["A7", None, None]
    assert apply(spark, texts.key_base("v"), ["a.b.c", "a"]) == ["a", "a"]
    assert apply(spark, texts.key_extension("v"), ["a.b.c", "a"]) == ["b", None]
    assert apply(spark, texts.numbered_parameters(["v", None]), ["x", None]) == ["&ms1=x&ms2=NULL", "&ms1=NULL&ms2=NULL"]
    assert apply(spark, texts.strip_label("v", "FunctionName: "), ["   FunctionName: my fn \n"]) == ["myfn"]


def test_stable_id_is_repeatable(spark):
    first, second = apply(spark, texts.stable_id("tag", "v"), ["a", "a"])
    assert first == second
    assert apply(spark, texts.stable_id("product", "v"), ["a"]) != [first]


def test_hashed_fraction_range(spark):
    values = apply(spark, texts.hashed_fraction("v", "s"), list(range(500)), "int")
    assert all(0 <= v < 1 for v in values) and 0.4 < sum(values) / 500 < 0.6
