"""Operators: hot groups, repeatability and set properties."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import lookups, measures, paging, projection, series, sets, slices, upsert


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds two thirds of the rows, NULL keys another part; values have gaps."""
    rng = random.Random(7)
    data = []
    for i in range(4000):
        key = "hot" if i % 3 else rng.choice(["a", "b", "c", None, str(i)])
        data.append((key, rng.randrange(50), i, None if rng.random() < 0.7 else float(i)))
    return spark.createDataFrame(data, "k string, t int, id int, v double").repartition(8).cache()


@pytest.fixture
def many_slices(spark):
    """Small data would be merged into one slice."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.usefixtures("many_slices")
def test_positions_equal_a_window(skewed):
    w = Window.partitionBy("k").orderBy("t", "id")
    expected = skewed.select("id", F.row_number().over(w).cast("bigint"))
    assert rows(slices.running_position(skewed, ["k"], ["t", "id"]).select("id", "position")) == rows(expected)


@pytest.mark.usefixtures("many_slices")
def test_whole_frame_positions(skewed):
    expected = skewed.select("id", F.row_number().over(Window.orderBy("t", "id")).cast("bigint"))
    assert rows(slices.running_position(skewed, [], ["t", "id"]).select("id", "position")) == rows(expected)


@pytest.mark.usefixtures("many_slices")
def test_carry_forward_equals_a_window(skewed):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = skewed.select("id", F.last("v", ignorenulls=True).over(w))
    assert rows(slices.carry_forward(skewed, ["k"], ["t", "id"], ["v"]).select("id", "v")) == rows(expected)


@pytest.mark.usefixtures("many_slices")
def test_a_hot_key_spans_slices(skewed):
    sliced = slices.sliced(skewed, ["k"], ["t", "id"])
    assert sliced.where("k = 'hot'").select("_slice").distinct().count() > 1


@pytest.mark.usefixtures("many_slices")
def test_empty_frames(skewed):
    empty = skewed.where("id < 0")
    assert slices.running_position(empty, ["k"], ["t", "id"]).count() == 0
    assert slices.carry_forward(empty, ["k"], ["t", "id"], ["v"]).count() == 0


def test_first_per_key_limits_before_the_shuffle(skewed):
    first = lookups.first_per_key(skewed, ["k"], ["t", "id"])
    plan = first._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert first.count() == skewed.select("k").distinct().count()


def test_anti_and_semi_make_the_whole(skewed):
    other = skewed.where("t > 30").select("k")
    kept, dropped = lookups.keep_matches(skewed, other, "k"), lookups.drop_matches(skewed, other, "k")
    assert rows(kept.unionByName(dropped).select("id")) == rows(skewed.select("id"))


def rows_in_order(df, order):
    return [r.id for r in df.orderBy(*order).collect()]


def test_a_page_is_the_top_of_the_order_without_the_pages_before(skewed):
    page = paging.page_slice(skewed, ["t", "id"], 101, 50)
    assert rows(page.select("id")) == rows(skewed.orderBy("t", "id").offset(100).limit(50).select("id"))
    plan = page._jdf.queryExecution().executedPlan().toString()
    # The fixture's own exchange is the only one.
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan and "Sort" not in plan and "TakeOrdered" not in plan


@pytest.mark.parametrize("border", [100_000, 20])
def test_first_rows_and_pages_of_any_size(spark, monkeypatch, border):
    """Nulls come first, and a border range that is too large is counted by ranges again."""
    monkeypatch.setattr(paging, "BORDER_ROWS", border)
    df = spark.range(2000).selectExpr(
        "CASE WHEN id % 7 > 0 THEN CAST(id % 5 AS STRING) END AS s", "CASE WHEN id % 3 > 0 THEN CAST(id % 4 AS DOUBLE) END AS x",
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS t", "id",
    )
    order = ["s", "x", "t"]
    want = rows_in_order(df, order)
    for n in (0, 1, 137, 1999, 2000, 5000):
        assert {r.id for r in paging.ordered_limit(df, order, n).collect()} == set(want[:n])
    for start, size in ((1, 10), (0, 3), (286, 1), (701, 350), (1990, 100), (2001, 5), (5, 0)):
        assert {r.id for r in paging.page_slice(df, order, start, size).collect()} == set(want[max(start, 1) - 1 : max(start + size - 1, 0)])


def test_pages_of_ties_and_of_nothing(spark):
    ties = spark.range(50).selectExpr("CAST('NaN' AS DOUBLE) AS x", "id")
    assert paging.ordered_limit(ties, ["x"], 3).count() == 50
    assert paging.ordered_limit(ties.where("id < 0"), ["x"], 3).count() == 0
    assert paging.page_slice(ties.where("id < 0"), ["x"], 1, 3).count() == 0


@pytest.mark.usefixtures("many_slices")
def test_every_row_is_on_one_page(skewed):
    sizes = paging.paged(skewed, ["t", "id"], 300).groupBy("page").count()
    assert sorted(map(tuple, sizes.collect())) == [(p, 300) for p in range(1, 14)] + [(14, 100)]


def test_upsert_twice_is_upsert_once(frame):
    current = frame("k int, v string", (1, "a"), (2, "b"))
    changes = frame("k int, v string, n int", (2, "c", 1), (2, "d", 2), (3, "e", 1))
    once = upsert.upsert(current, changes, ["k"], [F.col("n").desc()])
    assert rows(once) == [(1, "a"), (2, "d"), (3, "e")]
    assert rows(upsert.upsert(once, changes, ["k"], [F.col("n").desc()])) == rows(once)


def test_update_column_can_set_null(frame):
    current = frame("k int, v string", (1, "a"), (2, "b"))
    assert rows(upsert.update_column(current, frame("k int, v string", (2, None)), ["k"], "v")) == [(1, "a"), (2, None)]


def test_union_distinct_is_order_free(skewed):
    a, b = skewed.where("t < 30").select("k", "t"), skewed.where("t > 10").select("k", "t")
    assert rows(sets.union_distinct(a, b)) == rows(sets.union_distinct(b, a))


def test_append_all_aligns_by_name(frame):
    got = sets.append_all([frame("a int, b int", (1, 2)), frame("b int, c int", (3, 4))])
    assert rows(got) == [(1, 2, None), (None, 3, 4)]


def test_with_parent(frame):
    tree = frame("id string, up string, c string, t string",
                 ("1", "-", "r", "root"), ("2", "1", "k", "kid"), ("3", "9", "o", "orphan"))
    got = lookups.with_parent(tree, "id", "up", "c", "t").select("id", "root_code", "root_title")
    assert rows(got) == [("1", "r", "root"), ("2", "r", "root"), ("3", "o", "orphan")]


def test_last_value_per_key(frame):
    titles = frame("name string, id string, n int", ("a", "x", 1), ("a", "y", 2), ("b", "z", 1))
    assert rows(lookups.last_value_per_key(titles, "name", "id", "n")) == [("a", "y"), ("b", "z")]


def test_apply_mapping_skips_absent_sources(frame):
    got = projection.apply_mapping(
        frame("a string, b int", ("x", 1)),
        [("b", "int", "c", "string"), ("a", "string", "d", "bigint"), ("z", "int", "z", "int")],
    )
    assert got.dtypes == [("c", "string"), ("d", "bigint")] and rows(got) == [("1", None)]


def test_flatten_keeps_lists(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1), 'd', array(1, 2)) AS a, 3 AS e")
    got = projection.flatten(df)
    assert got.columns == ["abc", "ad", "e"] and got.first()["ad"] == [1, 2]


def test_flatten_variant_opens_whatever_depth(spark):
    deep = "".join(f'{{"k{i % 3}": ' for i in range(25)) + "7" + "}" * 25
    df = spark.createDataFrame([
        (1, '{"a": {"b": {"c": 1}}, "l": [1, {"x": 2}], "n": null, "e": {}}'), (2, deep), (3, "5"), (4, "[1,2]"), (5, None),
    ], "id int, body string").select("id", F.parse_json("body").alias("v"))
    got = sorted((r["id"], r["path"], r["value"]) for r in projection.flatten_variant(df, ["id"], "v").collect() if r["id"] < 5)
    assert got == sorted([
        (1, "abc", "1"), (1, "l", '[1,{"x":2}]'), (1, "n", None), (2, "".join(f"k{i % 3}" for i in range(25)), "7"), (3, "", "5"), (4, "", "[1,2]"),
    ], key=str)
    assert projection.flatten_variant(df.limit(0), ["id"], "v").count() == 0


def test_change_is_zero_across_a_gap(spark):
    bins = spark.sql(
        """SELECT 'd' AS d, CAST(b AS TIMESTAMP_NTZ) AS bin, v FROM VALUES ('2020-01-01 23:50:00', 1.0D),
        ('2020-01-02 00:00:00', 3.5D), ('2020-01-02 00:20:00', 9.0D) AS t(b, v)"""
    )
    got = series.change_since_previous_bin(bins, ["d"], ["v"]).orderBy("bin")
    assert [r["v_change"] for r in got.collect()] == [0.0, 2.5, 0.0]


def test_distinct_in_group(skewed):
    for name in ("v", "k"):
        quick = skewed.groupBy("k", "t").agg(measures.distinct_in_group(name, ["k", "t"]).alias("n"))
        plain = skewed.groupBy("k", "t").agg(F.count_distinct(name).alias("n"))
        assert rows(quick) == rows(plain)


def test_alarm_limit_is_inclusive(spark):
    calls = spark.sql(
        """SELECT f, CAST('2020-01-01 10:00:00' AS TIMESTAMP_NTZ) AS ts, n
        FROM VALUES ('nine', 9), ('ten', 4), ('ten', 6), ('more', 11) AS t(f, n)"""
    )
    assert sorted(r["f"] for r in measures.daily_alarms(calls, "f", "ts", "n").collect()) == ["more", "ten"]


def test_places_and_fills_over_batches_and_odd_keys(spark):
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for key in ("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 4 END", "CASE WHEN id % 2 = 0 THEN double('NaN') ELSE id % 3 END",
                    "named_struct('a', id % 3)", "string(id % 5)", "date_add(date'2020-01-01', int(id % 2))"):
            df = spark.range(200).selectExpr(
                f"{key} AS k", "id AS o", "CASE WHEN id % 6 = 5 THEN array(id) END AS v", "CASE WHEN id % 11 = 3 THEN string(id) END AS w")
            w = Window.partitionBy("k").orderBy("o")
            want = df.withColumn("position", F.row_number().over(w).cast("long"))
            assert repr(rows(slices.running_position(df, ["k"], ["o"]))) == repr(rows(want))
            want = df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in ("v", "w")})
            assert repr(rows(slices.carry_forward(df, ["k"], ["o"], ["v", "w"]))) == repr(rows(want))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
