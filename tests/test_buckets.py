"""Puts into bucketed tables: what is rewritten, and what a rerun gives."""

import os

from pyspark.sql import functions as F

from ledgerloom.session import scratch_dir
from ledgerloom.sinks.buckets import BUCKET, bucket_of, put_buckets, read_buckets, write_buckets

SCHEMA = "id long, name string, v double"


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_put_rewrites_touched_buckets_only(spark):
    path = scratch_dir(spark, "buckets")
    table = spark.range(500).select("id", F.lit("old").alias("name"), F.lit(0.5).alias("v"))
    write_buckets(table, path, ["id"], 16)
    before = files(path)
    changes = spark.createDataFrame([(7, "new", 1.0, 1), (7, "newer", 2.0, 2), (None, "no key", 4.0, 1), (9000, "added", 3.0, 1)], f"{SCHEMA}, at int")
    touched = {r[0] for r in changes.select(bucket_of(["id"], 16)).distinct().collect()}
    assert 0 < len(touched) < 4
    for _ in range(2):
        put_buckets(spark, path, changes.where("id IS NOT NULL"), table.schema, ["id"], [F.desc("at")], 16)
        rows = {r.id: (r.name, r.v) for r in read_buckets(spark, path, table.schema).collect()}
        assert len(rows) == 501 and rows[7] == ("newer", 2.0) and rows[9000] == ("added", 3.0) and rows[8] == ("old", 0.5)
        kept = before & files(path)
        assert {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in before - kept} <= touched
        assert len(kept) > 0


def test_only_touched_buckets_are_read(spark):
    path = scratch_dir(spark, "buckets")
    table = spark.range(100).select("id", F.lit("old").alias("name"), F.lit(0.5).alias("v"))
    write_buckets(table, path, ["id"], 8)
    plan = read_buckets(spark, path, table.schema).where(F.col(BUCKET).isin([3]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [(_bucket" in plan or f"{BUCKET}#" in plan.split("PartitionFilters")[1]


def test_an_empty_change_leaves_the_table(spark):
    path = scratch_dir(spark, "buckets")
    table = spark.range(10).select("id", F.lit("old").alias("name"), F.lit(0.5).alias("v"))
    write_buckets(table, path, ["id"], 4)
    put_buckets(spark, path, table.limit(0), table.schema, ["id"], ["id"], 4)
    assert read_buckets(spark, path, table.schema).count() == 10
