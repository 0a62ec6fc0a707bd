"""Streams in several micro-batches against their batch form."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgerloom.operators.slices import carry_forward
from ledgerloom.queries.series import SPARSE
from ledgerloom.session import scratch_dir
from ledgerloom.streaming import carrying
from ledgerloom.streaming.closing import land_and_close, with_closings
from ledgerloom.streaming.runs import file_stream, finish, in_cycles, rocksdb_state, to_table
from ledgerloom.streaming.telemetry import alarm_stream, bin_changes, carried, closed_bins

START = dt.datetime(2020, 1, 1, 23, 30)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def landed(spark):
    """Writes each list of rows as a file of its own, in order."""

    def write(schema, *files):
        path = scratch_dir(spark, "landed")
        for data in files:
            spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
        return path

    return write


@pytest.fixture
def run(spark):
    def to_frame(stream):
        path = scratch_dir(spark, "stream")
        finish(to_table(stream, f"{path}/t", f"{path}/c"))
        return spark.read.schema(stream.schema).parquet(f"{path}/t")

    return to_frame


def minutes(n):
    return START + dt.timedelta(minutes=n)


def test_late_messages_of_a_closed_bin_are_dropped(spark, landed, run):
    path = landed("d string, ts timestamp, v double",
                  [("a", minutes(1), 1.0), ("a", minutes(45), 2.0)],
                  [("a", minutes(80), 3.0)],
                  [("a", minutes(2), 100.0), ("a", minutes(120), 4.0)])
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
    bins = run(closed_bins(stream, ["d"], "ts", {"v": F.sum("v")}))
    assert rows(bins.select(F.col("bin").cast("timestamp_ntz"), "v")) == [
        (minutes(10), 1.0), (minutes(50), 2.0), (minutes(90), 3.0),
    ]


def closed(spark, messages, ts, made, width=dt.timedelta(minutes=10), path=None):
    path = path or scratch_dir(spark, "closed")
    known = with_closings(messages, ts, f"{path}/closings")
    land_and_close(made(known), known, ts, f"{path}/closings", f"{path}/t", f"{path}/c", width)
    return spark.read.schema(made(known).schema).parquet(f"{path}/t")


def binned(messages):
    return closed_bins(messages, ["d"], "ts", {"v": F.sum("v"), "n": F.count("*")}).withColumn("bin", F.col("bin").cast("timestamp_ntz"))


def test_the_last_bins_are_closed_once_and_newer_ones_go_on(spark, landed):
    schema = "d string, ts timestamp, v double"
    path, work = landed(schema, [("a", minutes(1), 1.0), (None, minutes(2), 2.0)], [("a", minutes(45), 3.0), ("a", minutes(44), 4.0)]), scratch_dir(spark, "w")
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
    first = [("a", minutes(10), 1.0, 1), (None, minutes(10), 2.0, 1), ("a", minutes(50), 7.0, 2)]
    for _ in range(2):
        assert rows(closed(spark, stream, "ts", binned, path=work).select("d", "bin", "v", "n")) == sorted(first, key=repr)
    # A message for a bin that was closed is late; a bin after it is not.
    late = [("a", minutes(46), 9.0), ("b", minutes(71), 5.0)]
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(path)
    got = rows(closed(spark, stream, "ts", binned, path=work).select("d", "bin", "v", "n"))
    assert got == sorted([*first, ("b", minutes(80), 5.0, 1)], key=repr)


def test_a_closing_row_is_in_no_bin_even_when_it_is_closed_itself(spark, landed):
    path, work = landed("ts timestamp, v double", [(minutes(1), 1.0)]), scratch_dir(spark, "w")
    stream = file_stream(spark, path, spark.read.parquet(path).schema)

    def made(messages):
        return closed_bins(messages, [], "ts", {"n": F.count("*")}).withColumn("bin", F.col("bin").cast("timestamp_ntz"))

    closed(spark, stream, "ts", made, path=work)
    spark.createDataFrame([(minutes(600), 2.0)], "ts timestamp, v double").coalesce(1).write.mode("append").parquet(path)
    assert rows(closed(spark, stream, "ts", made, path=work)) == [(minutes(10), 1), (minutes(610), 1)]


def test_nothing_arrived_and_nothing_is_closed(spark, landed):
    path = landed("d string, ts timestamp, v double", [])
    stream = file_stream(spark, path, spark.read.parquet(path).schema)
    assert closed(spark, stream, "ts", binned).count() == 0


def test_bin_changes_meet_their_neighbour_in_either_order(spark, landed):
    path = landed("d int, bin timestamp_ntz, value double",
                  [(1, minutes(20), 3.5), (2, minutes(20), 7.0), (None, minutes(20), 1.0), (3, minutes(20), None)],
                  # These come after the bin that ends ten minutes later.
                  [(1, minutes(10), 1.0), (None, minutes(10), 0.5), (3, minutes(10), 1.0)],
                  [(1, minutes(30), 3.0), (2, minutes(40), 9.0)])
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
    got = closed(spark, stream.withColumn("bin", F.col("bin").cast("timestamp")), "bin", lambda b: bin_changes(b, ["d"], ["value"]))
    assert rows(got.withColumn("bin", F.col("bin").cast("timestamp_ntz"))) == sorted([
        (1, minutes(10), 1.0, 0.0), (1, minutes(20), 3.5, 2.5), (1, minutes(30), 3.0, -0.5), (None, minutes(10), 0.5, 0.0),
        (None, minutes(20), 1.0, 0.5), (2, minutes(20), 7.0, 0.0), (2, minutes(40), 9.0, 0.0), (3, minutes(10), 1.0, 0.0),
        (3, minutes(20), None, None),
    ], key=repr)


def test_the_join_state_is_freed_behind_the_watermark(spark, landed):
    days = [[(d, minutes(10 * (6 * k + i)), 1.0) for d in range(5) for i in range(6)] for k in range(6)]
    path, work = landed("d int, bin timestamp, value double", *days), scratch_dir(spark, "w")
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
    query = to_table(bin_changes(stream, ["d"], ["value"]), f"{work}/t", f"{work}/c")
    finish(query)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # Two sides of at most an hour and the delay for five devices, not of all six hours.
    assert max(held) <= 2 * 5 * 9 and held[-1] <= 2 * 5 * 3


def test_carried_in_batches_equals_one_pass(spark, landed):
    data = [
        [("a", minutes(1), 1, 5.0, 2**60 + 1), ("a", minutes(2), 2, None, None), ("b", minutes(3), 3, None, None)],
        [("a", minutes(4), 4, None, None), ("b", minutes(5), 5, 6.0, 7), (None, minutes(5), 9, 1.0, None)],
        [("a", minutes(6), 6, 7.0, None), ("b", minutes(7), 7, None, None), ("c", minutes(8), 8, None, 1), (None, minutes(9), 10, None, None)],
    ]
    schema = "d string, ts timestamp_ntz, id int, v double, w long"
    path, work = landed(schema, *data), scratch_dir(spark, "carry")
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
    want = rows(carry_forward(spark.read.parquet(path), ["d"], ["ts", "id"], ["v", "w"]))
    with rocksdb_state(spark):
        for again in range(2):
            query = to_table(carried(stream, "d", ["ts", "id"], ["v", "w"]), f"{work}/t", f"{work}/c")
            finish(query)
            assert rows(spark.read.schema(schema).parquet(f"{work}/t")) == want
            if not again:
                # One row of values per device, and a batch updates those of its own devices.
                states = [p["stateOperators"][0] for p in query.recentProgress]
                assert states[-1]["numRowsTotal"] == 4 and [s["numRowsUpdated"] for s in states] == [2, 3, 4]
                assert "RocksDB" in query.lastProgress.json or "rocksdb" in query.lastProgress.json
    assert "changelog" in "".join(f for _, _, names in os.walk(f"{work}/c/state") for f in names)


CARRIED = "d string, ts timestamp_ntz, id int, v double, w long"


def test_carrying_in_batches_equals_one_pass(spark, landed, monkeypatch):
    monkeypatch.setattr(carrying, "WHOLE_EVERY", 2)
    data = [
        [("a", minutes(1), 1, 5.0, 2**60 + 1), ("a", minutes(2), 2, None, None), ("b", minutes(3), 3, None, None), ("z", minutes(3), 4, 8.0, 3)],
        [("a", minutes(4), 4, None, None), ("b", minutes(5), 5, 6.0, 7), (None, minutes(5), 9, 1.0, None)],
        [("a", minutes(6), 6, 7.0, None), ("a", None, 7, None, None), ("b", minutes(7), 7, None, None), ("c", minutes(8), 8, None, 1)],
        [(None, minutes(9), 10, None, None), ("a", minutes(9), 11, None, None)],
        [("c", minutes(10), 12, None, None), ("a", minutes(10), 13, None, 4)],
        [("z", minutes(20), 14, None, None), ("a", minutes(11), 15, None, None), ("c", minutes(11), 16, None, None)],
    ]
    path, work = landed(CARRIED, *data[:4]), scratch_dir(spark, "carry")
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)

    def run():
        finish(carrying.carry_in_batches(stream, f"{work}/t", f"{work}/c", "d", ["ts", "id"], ["v", "w"]))
        return rows(carrying.read_carried(spark, f"{work}/t", stream.schema))

    # A message without a time is the first of its own batch, not of all.
    def want(n):
        whole = [[(*r, k) for r in part] for k, part in enumerate(data[:n])]
        frame = spark.createDataFrame(sum(whole, []), f"{CARRIED}, k int")
        return rows(carry_forward(frame, ["d"], ["k", "ts", "id"], ["v", "w"]).drop("k"))

    assert run() == want(4) and run() == want(4)
    for part in data[4:]:
        spark.createDataFrame(part, CARRIED).coalesce(1).write.mode("append").parquet(path)
    assert run() == want(6) and ("z", minutes(20), 14, 8.0, 3) in run()
    # The newest whole state and what follows; a batch in between holds its own devices only.
    assert sorted(os.listdir(f"{work}/c/held")) == ["4", "5"] and not os.path.exists(f"{work}/c/slices")
    held = {n: {r["d"] for r in spark.read.parquet(f"{work}/c/held/{n}").collect()} for n in (4, 5)}
    assert held == {4: {"a", "b", "c", "z", None}, 5: {"a", "c", "z"}}


def test_a_batch_that_runs_again_replaces_its_own(spark, landed):
    data = [[("a", minutes(1), 1, 5.0, 1)], [("a", minutes(2), 2, None, 2), ("a", minutes(3), 3, 6.0, None)]]
    path, work = landed(CARRIED, *data), scratch_dir(spark, "again")
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
    want = [("a", minutes(1), 1, 5.0, 1), ("a", minutes(2), 2, 5.0, 2), ("a", minutes(3), 3, 6.0, 2)]
    for _ in range(2):
        finish(carrying.carry_in_batches(stream, f"{work}/t", f"{work}/c", "d", ["ts", "id"], ["v", "w"]))
        assert rows(carrying.read_carried(spark, f"{work}/t", stream.schema)) == want
        # As if the run had ended before the batch was committed.
        os.remove(f"{work}/c/commits/1")
        os.remove(f"{work}/c/commits/.1.crc")


def test_nothing_arrived_and_nothing_is_carried(spark, landed):
    path, work = landed(CARRIED, []), scratch_dir(spark, "none")
    stream = file_stream(spark, path, spark.read.parquet(path).schema, name_filter="none.parquet")
    finish(carrying.carry_in_batches(stream, f"{work}/t", f"{work}/c", "d", ["ts", "id"], ["v"]))
    assert rows(carrying.read_carried(spark, f"{work}/t", stream.schema)) == []


def test_a_device_with_much_of_a_batch_is_not_one_task(spark, tmp_path):
    events = spark.range(6000).selectExpr(
        "id AS event_id", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "1 + id % 40 AS user_id",
        "CASE WHEN id % 4 = 0 THEN 'click' ELSE 'purchase' END AS event_type", "CAST(id AS DOUBLE) AS value", "CAST(id AS STRING) AS props",
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/made")
    file = next(f for f in os.listdir(f"{tmp_path}/made") if f.endswith(".parquet"))
    os.makedirs(f"{tmp_path}/in")
    os.link(f"{tmp_path}/made/{file}", f"{tmp_path}/in/events.parquet")
    # Small partitions stay apart, and a file is read by a task of its own: the files show how rows were dealt.
    apart = {"spark.sql.files.openCostInBytes": "256m", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in apart.items():
        spark.conf.set(name, value)
    try:
        got = queries()["stream_carry"](spark, f"{tmp_path}/in")
    finally:
        for name in apart:
            spark.conf.unset(name)
    hot = got.where("device = 0").groupBy(F.input_file_name()).count().toPandas()["count"]
    assert hot.sum() == 2000 and hot.max() < 1200
    want = carry_forward(spark.sql(SPARSE, events=events), ["device"], ["ts", "event_id"], ["value", "detail"])
    assert rows(got) == rows(want)


def test_cycles_write_a_file_each_and_stop_in_order(spark, landed):
    path, work = landed("id int, day string", [(1, "x"), (2, "x")], [(3, "x"), (4, "y")]), scratch_dir(spark, "cycles")
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
    done = in_cycles(stream, f"{work}/out", f"{work}/c", "200 milliseconds", lambda c: len(c) == 2, ["day"])
    assert [(p["batchId"], p["numInputRows"]) for p in done] == [(0, 2), (1, 2)]
    spark.createDataFrame([(5, "y")], "id int, day string").coalesce(1).write.mode("append").parquet(path)
    more = in_cycles(stream, f"{work}/out", f"{work}/c", "200 milliseconds", lambda c: True, ["day"])
    assert [p["numInputRows"] for p in more] == [1]
    files = sorted(os.path.relpath(d, f"{work}/out") for d, _, names in os.walk(f"{work}/out") for f in names if f.endswith(".parquet"))
    assert files == ["cycle=0/day=x", "cycle=1/day=x", "cycle=1/day=y", f"cycle={more[0]['batchId']}/day=y"]
    assert not spark.streams.active


def test_alarms_of_closed_days(spark, landed, run):
    day = dt.datetime(2020, 1, 1)
    path = landed("f string, ts timestamp, n bigint",
                  [("nine", day, 9), ("ten", day, 4)],
                  [("ten", day + dt.timedelta(hours=5), 6), ("ten", day + dt.timedelta(days=1), 50)],
                  [("end", day + dt.timedelta(days=1, hours=1), 1)])
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
    assert rows(run(alarm_stream(stream, "f", "ts", F.col("n")))) == [("ten", day.date(), 10)]
    whole = closed(spark, stream, "ts", lambda c: alarm_stream(c, "f", "ts", F.col("n")), dt.timedelta(days=1))
    assert rows(whole) == [("ten", day.date(), 10), ("ten", day.date() + dt.timedelta(days=1), 50)]
