"""What the physical plans must and must not hold."""

import pytest

from __spark_entry__ import queries
from ledgerloom.operators.paging import ordered_limit
from ledgerloom.sources.tables import where_equal

SF_DIR = "/root/testdata/sf0.001"
PURE = [
    "ticket_sales_view", "sales_portfolio", "rollup_day", "rollup_show", "forecast_table", "catalogue_products",
    "catalogue_product_departments", "catalogue_tag_mappings", "upsert_latest", "dedupe_first", "bin_delta",
    "power_by_bin", "alarm_daily", "xml_readings", "flatten_json", "mixed_dates", "month_chunks",
]


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for operator in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text, operator


def test_refunds_are_an_anti_join(spark):
    assert "LeftAnti" in plan(spark, "refund_anti")


def test_view_groups_by_hash(spark):
    text = plan(spark, "ticket_sales_view")
    assert "SortAggregate" not in text and "Expand" not in text


def test_view_groups_where_the_schedule_join_left_the_tickets(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, "ticket_sales_view")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and not [line for line in shuffles if "ttd_ticket_no" in line]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "numeric_time_filter")
    assert "GreaterThan(o_totalprice,100000.0)" in text and "GreaterThan(o_orderdate" in text
    assert "o_orderpriority" not in text
    scan = where_equal(queries()["scan_param"](spark, SF_DIR), kind="click")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,click)" in scan and "props" not in scan


def test_dated_folders_are_pruned(spark):
    days = queries()["partitioned_sink"](spark, SF_DIR).where("day >= '10'")
    scans = [line for line in days._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [isnotnull(day" in line for line in scans)


def test_pages_are_numbered_without_a_single_task(spark):
    """The page query may gather one row per slice, never the rows themselves."""
    text = plan(spark, "pages_all")
    for line in text.splitlines():
        if "SinglePartition" in line:
            below = text[text.index(line):].split("Scan", 1)[0]
            assert "partial_count(1)" in below  # one row per slice


def test_first_rows_are_a_filter_that_reaches_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_orderkey", "o_totalprice")
    text = ordered_limit(orders, ["o_orderkey"], 700)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "TakeOrdered" not in text and "LessThanOrEqual(o_orderkey" in text


def test_bucketed_films_join_without_a_shuffle(spark):
    from ledgerloom.plans.film import save_film_table
    from ledgerloom.session import scratch_dir

    name = "films_" + scratch_dir(spark, "t")[-8:]
    save_film_table(spark.range(100).withColumnRenamed("id", "film_id"), name, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        films = spark.table(name)
        text = films.join(films.select("film_id"), "film_id")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {name}")


def test_changes_of_one_site_are_not_gathered_in_one_task(spark):
    assert "SinglePartition" not in plan(spark, "power_by_bin")
