"""Lookups, parents, first and last per key, put by key, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.texts import stable_id
from ..operators.lookups import (
    drop_matches, first_per_key, keep_matches, last_value_per_key, with_parent,
)
from ..operators.sets import append_all, union_distinct
from ..operators.upsert import update_column, upsert
from ..sources.tables import create_view
from .base import derive, table, with_inputs


def view_over_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    view = joined.groupBy("c_mktsegment").agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("highest"))
    return create_view(view, "segment_orders")


def kv_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One join in place of one index query per row."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


PART_TITLES = "SELECT p_partkey, p_name || ' ' || CAST(p_partkey % 500 AS STRING) AS title FROM {part}"
SOLD_TITLES = """SELECT p_name || ' ' || CAST(p_partkey % 500 AS STRING) AS title
    FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE l_returnflag = 'R' AND l_quantity > 49"""


def new_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_matches(derive(spark, sf_dir, PART_TITLES), derive(spark, sf_dir, SOLD_TITLES), "title")


def known_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_matches(derive(spark, sf_dir, PART_TITLES), derive(spark, sf_dir, SOLD_TITLES), "title")


CATEGORIES = """SELECT CAST(p_partkey AS STRING) AS id, 'c' || CAST(p_partkey AS STRING) AS code,
    CASE WHEN p_partkey % 10 = 0 THEN '-' WHEN p_partkey % 10 = 9 THEN 'gone'
        ELSE CAST(p_partkey - p_partkey % 10 AS STRING) END AS parent, p_name AS title FROM {part}"""


def parent_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_parent(derive(spark, sf_dir, CATEGORIES), "id", "parent", "code", "title")
    return found.select("id", "root_code", "root_title")


PRODUCTS = """SELECT p_partkey AS id, p_name AS name, p_brand AS department,
    p_brand || ' ' || p_type AS sub_department FROM {part}"""
DEPARTMENTS = """SELECT 'd' || CAST(min(p_partkey) AS STRING) AS id, p_brand AS title,
    CASE WHEN p_brand LIKE '%7' THEN 'other' ELSE '-' END AS parent FROM {part} GROUP BY p_brand, p_size % 2
    UNION ALL SELECT 's' || CAST(min(p_partkey) AS STRING) AS id, p_brand || ' ' || p_type AS title, 'x' AS parent
    FROM {part} WHERE p_size % 4 > 0 GROUP BY p_brand, p_type"""


def root_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root department of every product whose sub-department exists, and the id that
    its name was given last."""
    products, departments = derive(spark, sf_dir, PRODUCTS), derive(spark, sf_dir, DEPARTMENTS)
    known = keep_matches(products, departments.select(F.col("title").alias("sub_department")), "sub_department")
    roots = first_per_key(departments.where("parent = '-'"), ["title"], ["id"])
    ids = last_value_per_key(
        products.select("name", "id", F.col("id").alias("scan_order")), "name", "id", "scan_order"
    ).select(F.col("name").alias("known_name"), F.col("id").alias("last_id"))
    return (
        known.join(roots.select("title", F.col("id").alias("department_id")), F.col("department") == F.col("title"))
        .join(ids, F.col("name") == F.col("known_name"), "left")
        .select("id", "department_id", "last_id")
    )


CHANGED = """SELECT c_custkey, c_name || ' new' AS c_name, c_acctbal + 1 AS c_acctbal, 1 AS version
    FROM {customer} WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT c_custkey + 1000000 AS c_custkey, 'added' AS c_name, c_acctbal, 1 AS version
    FROM {customer} WHERE c_nationkey = 3
    UNION ALL SELECT c_custkey, c_name || ' newer' AS c_name, c_acctbal + 2 AS c_acctbal, 2 AS version
    FROM {customer} WHERE c_nationkey = 5"""


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return upsert(current, derive(spark, sf_dir, CHANGED), ["c_custkey"], [F.col("version").desc()])


BALANCES = "SELECT c_custkey, 0.5E0 AS c_acctbal FROM {customer} WHERE c_acctbal < 0 OR c_nationkey = 5"


def update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return update_column(current, derive(spark, sf_dir, BALANCES), ["c_custkey"], "c_acctbal")


def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First document of every text. The hash of the whole text is the key, so the
    texts themselves are neither sorted nor shuffled."""
    documents = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("digest"), "doc_id", "source")
    return first_per_key(documents, ["digest"], ["doc_id"]).select("doc_id", "source")


def lookup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "value", "event_id")
    return last_value_per_key(events, "user_id", "value", "event_id")


def union_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("year"), "o_orderpriority"
    )
    early = orders.where("year <= 1997").withColumn("custkey", F.col("custkey").cast("string"))
    aligned = early.withColumn("custkey", F.col("custkey").try_cast("bigint"))
    return union_distinct(aligned, orders.where("year BETWEEN 1997 AND 1999"), orders.where("year >= 1999"))


def append_differing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"))
    return append_all([customers, suppliers])


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", stable_id("product", "p_name").alias("id"))


QUERIES = {
    "view_over_parquet": view_over_parquet,
    "kv_lookup": kv_lookup,
    "new_titles": new_titles,
    "known_titles": known_titles,
    "parent_category": parent_category,
    "root_department": root_department,
    "upsert_latest": upsert_latest,
    "update_by_key": update_by_key,
    "dedupe_first": dedupe_first,
    "lookup_last": lookup_last,
    "union_years": union_years,
    "append_differing": append_differing,
    "stable_ids": stable_ids,
}
ORACLES = {
    "view_over_parquet": """SELECT c_mktsegment, COUNT(*) AS orders, MAX(o_totalprice) AS highest
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    "kv_lookup": "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "new_titles": with_inputs(
        "SELECT p_partkey, title FROM p WHERE title NOT IN (SELECT title FROM s)", p=PART_TITLES, s=SOLD_TITLES
    ),
    "known_titles": with_inputs(
        "SELECT p_partkey, title FROM p WHERE title IN (SELECT title FROM s)", p=PART_TITLES, s=SOLD_TITLES
    ),
    "parent_category": with_inputs(
        """SELECT c.id, CASE WHEN c.parent <> '-' THEN coalesce(p.code, c.code) ELSE c.code END AS root_code,
        CASE WHEN c.parent <> '-' THEN coalesce(p.title, c.title) ELSE c.title END AS root_title
        FROM cat c LEFT JOIN cat p ON c.parent = p.id""",
        cat=CATEGORIES,
    ),
    "root_department": with_inputs(
        """SELECT p.id, (SELECT min(d.id) FROM dep d WHERE d.title = p.department AND d.parent = '-') AS department_id,
        (SELECT max(q.id) FROM prod q WHERE q.name = p.name) AS last_id FROM prod p
        WHERE EXISTS (SELECT 1 FROM dep d WHERE d.title = p.sub_department)
        AND EXISTS (SELECT 1 FROM dep d WHERE d.title = p.department AND d.parent = '-')""",
        prod=PRODUCTS, dep=DEPARTMENTS,
    ),
    "upsert_latest": with_inputs(
        """SELECT c_custkey, c_name, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey
          ORDER BY version DESC) AS rn FROM (SELECT c_custkey, c_name, c_acctbal, 0 AS version FROM customer
          UNION ALL SELECT c_custkey, c_name, c_acctbal, version FROM ch)) WHERE rn = 1""",
        ch=CHANGED,
    ),
    "update_by_key": """SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 OR c_nationkey = 5 THEN CAST(0.5 AS DOUBLE)
        ELSE c_acctbal END AS c_acctbal FROM customer""",
    "dedupe_first": """SELECT doc_id, source FROM documents d
        WHERE doc_id = (SELECT min(doc_id) FROM documents e WHERE e.text = d.text)""",
    "lookup_last": "SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id",
    "union_years": """SELECT DISTINCT o_custkey AS custkey, CAST(year(o_orderdate) AS INT) AS year, o_orderpriority
        FROM orders""",
    "append_differing": """SELECT c_custkey AS key, c_name AS name, CAST(NULL AS DOUBLE) AS balance FROM customer
        UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
    "stable_ids": "SELECT p_partkey, sha256('product' || chr(31) || p_name) AS id FROM part",
}
