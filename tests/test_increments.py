"""Incremental loads: what is remembered, and what failing runs leave behind."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans.feeds import export_report, next_report_range, report_range, updated_in_range
from ledgerloom.plans.increments import catch_up, land_next, next_load
from ledgerloom.session import scratch_dir
from ledgerloom.sinks.ledger import Ledger, Load
from ledgerloom.sources.feeds import REPORT_PAGE


@pytest.fixture
def place(spark):
    path = scratch_dir(spark, "increments")
    return Ledger(spark, f"{path}/ledger"), f"{path}/landed"


@pytest.fixture
def feed(spark):
    """A record a day from 1 January to 31 March 2024, at noon."""
    days = spark.range(91).select(F.col("id"), F.expr("timestamp_ntz'2024-01-01 12:00:00' + make_dt_interval(cast(id AS int))").alias("updated_at"))
    return days


def landed(ledger, feed):
    return sorted((r.id, str(r.first), str(r.label)) for r in ledger.read(feed.schema).collect())


def test_ranges_follow_one_another_until_yesterday(place, feed):
    ledger, folder = place
    loads = catch_up(feed, ledger, "tickets", folder, "2024-03-20", start="2024-01-05")
    assert [(x.first, x.until, x.label) for x in loads] == [
        ("2024-01-05", "2024-02-05", "2024-02-04"),
        ("2024-02-05", "2024-03-05", "2024-03-04"),
        # Clamped to yesterday: the name states the day before.
        ("2024-03-05", "2024-03-19", "2024-03-18"),
        ("2024-03-19", "2024-03-20", "2024-03-19"),
    ]
    assert [i for i, _, _ in landed(ledger, feed)] == list(range(4, 79))
    assert land_next(feed, ledger, "tickets", folder, "2024-03-20") is None
    assert ledger.high_water("tickets") == "2024-03-20"
    nxt = land_next(feed, ledger, "tickets", folder, "2024-03-21")
    assert (nxt.first, nxt.until) == ("2024-03-20", "2024-03-21")
    assert [i for i, _, _ in landed(ledger, feed)] == list(range(4, 80))


def test_without_start_and_entries_it_is_yesterday(place, feed):
    ledger, folder = place
    assert [(x.first, x.until) for x in catch_up(feed, ledger, "a/b c", folder, "2024-02-10")] == [("2024-02-09", "2024-02-10")]
    assert landed(ledger, feed) == [(39, "2024-02-09", "2024-02-09")]


def test_a_failure_between_write_and_entry_leaves_each_record_once(place, feed):
    ledger, folder = place
    seen = []

    def fail_second(load):
        seen.append(load)
        if len(seen) == 2:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        catch_up(feed, ledger, "t", folder, "2024-03-20", start="2024-01-05", before_entry=fail_second)
    assert ledger.high_water("t") == "2024-02-05"
    catch_up(feed, ledger, "t", folder, "2024-03-20", start="2024-01-05", before_entry=fail_second)
    rows = landed(ledger, feed)
    assert [i for i, _, _ in rows] == list(range(4, 79))
    assert {(f, e) for _, f, e in rows} == {(x.first, x.label) for x in seen}
    # The range that failed was landed twice and entered once.
    assert len(seen) == 5 and ledger.entries().count() == 4


def test_of_two_runs_of_one_range_one_is_entered(spark, place, feed):
    ledger, folder = place
    one, two = (next_load(ledger, "t", folder, "2024-02-10", "2024-01-20") for _ in range(2))
    assert one.folder != two.folder
    for load in (one, two):
        feed.limit(1).write.parquet(load.folder)
    assert ledger.enter(one) and not ledger.enter(two)
    assert [r.folder for r in ledger.entries().collect()] == [one.folder]
    assert ledger.read(feed.schema).count() == 1


def test_feeds_have_marks_of_their_own_and_odd_names(place, feed):
    ledger, folder = place
    assert ledger.high_water("a") is None
    assert ledger.read(feed.schema).columns == [*feed.columns, "feed", "first", "label"]
    ledger.enter(Load("a/b c", "2024-01-01", "2024-02-01", "2024-01-31", f"{folder}/x"))
    ledger.enter(Load("a", "2024-01-01", "2024-01-03", "2024-01-02", f"{folder}/y"))
    assert (ledger.high_water("a/b c"), ledger.high_water("a"), ledger.high_water("b")) == ("2024-02-01", "2024-01-03", None)
    assert ledger.entries("a").first().first == dt.date(2024, 1, 1)


def test_the_range_reaches_the_scan(spark, place, feed):
    path = scratch_dir(spark, "feed")
    feed.write.parquet(path)
    plan = updated_in_range(spark.read.parquet(path), "2024-01-05", "2024-03-20")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(updated_at,2024" in plan.split("PushedFilters")[1]


def test_report_names_and_the_next_range():
    assert report_range("2024-01-01", "2024-02-01", "2024-03-01") == "2024-01-01_2024-02-01"
    assert report_range(None, "", "2024-03-01") == "2024-02-29"
    assert [str(d) for d in next_report_range("2023-11-30", "2024-06-01")] == ["2023-12-30", "2024-01-30"]
    assert [str(d) for d in next_report_range("2023-12-31", "2024-06-01")] == ["2024-01-31", "2024-02-29"]
    # Neither is later than the day before yesterday.
    assert [str(d) for d in next_report_range("2024-01-10", "2024-02-25")] == ["2024-02-10", "2024-02-23"]
    assert [str(d) for d in next_report_range("2024-02-10", "2024-02-25")] == ["2024-02-23", "2024-02-23"]


def test_a_report_without_rows_is_not_written(spark):
    folder = scratch_dir(spark, "reports")
    pages = spark.createDataFrame([(0, [("ga:date",)], None), (1, [("ga:date",)], [])], REPORT_PAGE)
    assert export_report(pages, folder, "2024-03-01") is None
