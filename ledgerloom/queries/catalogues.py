"""Product list and archive members made of parts and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.upsert import upsert
from ..plans.catalogue import SCHEMA, catalogue_load
from ..plans.images import register_images, with_main_images
from ..session import scratch_dir
from ..sinks.buckets import BUCKET, put_buckets, read_buckets, write_buckets
from ..sources.files import numbered_csv
from .base import derive, with_inputs

NOW = "2020-03-04 05:06:07.000008"
STAMP = "2020-03-04T05:06:07.000008Z"
YEAR_END = "2020-12-31T23:59:59.999Z"

# Names repeat, a third of the parts is of one department, tags are the words of the name.
ROWS = """SELECT p_partkey AS row_no, lpad(CAST(p_partkey AS STRING), 6, '0') AS item_code,
    p_name || ' ' || CAST(p_partkey % 700 AS STRING) AS item_name,
    CAST(p_size * CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 100 END AS STRING) AS category_code,
    p_type || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ' ' || CAST(p_partkey % 40 AS STRING) END AS category,
    CAST(p_partkey * 11 AS STRING) AS group_code, 'group' AS "group",
    CAST(p_size AS STRING) AS dimension, 'cold' AS temperature, p_name AS title, 'about ' || p_name AS description,
    CASE WHEN p_partkey % 3 = 0 THEN 'main' ELSE p_brand END AS department,
    p_brand || ' ' || p_type AS sub_department, 'kg' AS unit,
    CASE WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(p_retailprice AS STRING) END AS pickup_price,
    CAST(p_retailprice AS STRING) AS delivery_price, '' AS unused, '1/15/2020' AS publish_start, '' AS publish_end,
    CASE p_partkey % 3 WHEN 0 THEN '10%' WHEN 1 THEN '' ELSE '0%' END AS pickup_discount,
    CASE p_partkey % 3 WHEN 0 THEN '2.5' WHEN 1 THEN '' ELSE '0' END AS delivery_discount,
    '2/3/2020' AS discount_start, '' AS discount_end, '7' AS max_pickup_quantity, '' AS max_delivery_quantity,
    '30' AS preparation_time, replace(p_name, ' ', ', ') AS image FROM {part}"""
PRODUCTS = """SELECT 'p' || lpad(CAST(p_partkey AS STRING), 9, '0') AS "productId",
    p_name || ' ' || CAST(p_partkey % 700 AS STRING) AS name FROM {part} WHERE p_type = 'PROMO'"""
CATEGORIES = """SELECT 'k' || lpad(CAST(min(p_partkey) AS STRING), 9, '0') AS "categoryId",
    '0' || CAST(p_size AS STRING) AS code, p_type AS title,
    CASE WHEN p_size < 10 THEN '-' ELSE 'k' || lpad(CAST(min(p_partkey) % 50 AS STRING), 9, '0') END AS "parentId"
    FROM {part} WHERE p_type <> 'STANDARD' GROUP BY p_size, p_type"""
DEPARTMENTS = """SELECT 'd' || lpad(CAST(min(p_partkey) AS STRING), 9, '0') AS "departmentId", p_brand AS title,
    CASE WHEN p_brand LIKE '%7' THEN 'other' ELSE '-' END AS "parentId" FROM {part} WHERE p_brand > 'Brand#2'
    GROUP BY p_brand, p_size % 2
    UNION ALL SELECT 's' || lpad(CAST(min(p_partkey) AS STRING), 9, '0'), p_brand || ' ' || p_type, 'x'
    FROM {part} WHERE p_type <> 'PROMO' GROUP BY p_brand, p_type"""
TAGS = """SELECT 't' || lpad(CAST(min(p_partkey) AS STRING), 9, '0') AS "productTaggingId", split_part(p_name, ' ', 1) AS title
    FROM {part} WHERE p_size > 25 GROUP BY split_part(p_name, ' ', 1), p_type"""
INPUTS = dict(lines=ROWS, products=PRODUCTS, categories=CATEGORIES, departments=DEPARTMENTS, tags=TAGS)


def _load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = [derive(spark, sf_dir, text.replace('"', "`")) for text in INPUTS.values()]
    return catalogue_load(*frames, now=NOW)


def catalogue_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir)["product"]


def catalogue_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir)["category"]


def catalogue_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir)["department"]


def catalogue_product_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir)["product_department"]


def catalogue_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir)["tagging"]


def catalogue_tag_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir)["tagging_mapping"]


def catalogue_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product table after its changes were put in."""
    current = derive(spark, sf_dir, PRODUCTS.replace('"', "`"))
    return upsert(current, _load(spark, sf_dir)["product"], ["productId"], ["name"])


# Fixed by the load: every column of the six tables, as (key, {column: type of the others}).
TEXT, REAL, WHOLE, FLAG = "'old'", "CAST(0.5 AS DOUBLE)", "CAST(7 AS INT)", "true"
STAMPS = {"createdAt": TEXT, "updatedAt": TEXT}
EFFECT = {**STAMPS, "effectiveStartDate": TEXT, "effectiveEndDate": TEXT, "isDisabled": FLAG, "modifiedBy": TEXT, "__typename": TEXT}
PRODUCT_TEXTS = [
    "divisionCode", "divisionDesc", "itemCategoryCode", "itemCategoryDesc", "__typename", "productGroupCode", "productGroupDesc",
    "title", "description", "uom", "sku", "categories", "image", "departmentLevel1", "departmentLevel2", "updatedAt",
    "discountStartDate", "pickupDiscountStartDate", "itemPublishStartDate", "itemPublishEndDate", "createdAt",
]
PRODUCT_REALS = [
    "dimension", "temperature", "price", "pickupPrice", "discount", "discountedPrice", "pickupDiscount", "pickupDiscountedPrice",
    "ecommerceMaximumQuantity", "pickupMaximumQuantity", "minFoodPreparationDuration",
]
LINKS = """SELECT 'l' || lpad(CAST(p_partkey AS STRING), 9, '0') AS "{id}", p_brand AS "{one}", p_type AS "{two}"
    FROM {{part}} WHERE p_size < 5"""
STORED = {
    "product": ("productId", PRODUCTS, {
        **dict.fromkeys(PRODUCT_TEXTS, TEXT), **dict.fromkeys(PRODUCT_REALS, REAL), "minDeliveryDuration": WHOLE, "isDisabled": FLAG,
    }),
    "category": ("categoryId", CATEGORIES, {**STAMPS, "__typename": TEXT}),
    "department": ("departmentId", DEPARTMENTS, EFFECT),
    "product_department": ("productDepartmentId", LINKS.format(
        id="productDepartmentId", one="productDepartmentDepartmentId", two="productDepartmentProductId"), {**STAMPS, "__typename": TEXT}),
    "tagging": ("productTaggingId", TAGS, {**EFFECT, "image": TEXT, "createdBy": TEXT, "created": TEXT, "modified": TEXT}),
    "tagging_mapping": ("productTaggingMappingId", LINKS.format(
        id="productTaggingMappingId", one="productTaggingMappingProductId", two="productTaggingMappingProductTaggingId"), STAMPS),
}
# The list as a file has it: quotes, a comma, a letter of Latin-1 and a line end inside a field.
FILE_ROWS = ROWS.replace("'about ' || p_name AS description", """'"' || p_name || '", é' || chr(10) || 'more' AS description""")
BUCKETS = 16


def stored_sql(name: str) -> str:
    """A table before the load: the rows that the load looks up, every other column filled."""
    _, known, others = STORED[name]
    return "SELECT t.*, " + ", ".join(f'{value} AS "{column}"' for column, value in others.items()) + f" FROM ({known}) t"


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list, written as Latin-1 CSV files in its order and numbered as it is read."""
    path = scratch_dir(spark, "product-list")
    rows = derive(spark, sf_dir, FILE_ROWS.replace('"group"', "`group`"))
    ordered = rows.repartitionByRange(6, "row_no").sortWithinPartitions("row_no").drop("row_no")
    ordered.write.options(header=True, quote='"', escape='"', encoding="iso-8859-1").csv(path)
    return numbered_csv(spark, path, SCHEMA)


def _put(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        key, _, _ = STORED[name]
        frames = [derive(spark, sf_dir, text.replace('"', "`")) for text in list(INPUTS.values())[1:]]
        changes = catalogue_load(_listed(spark, sf_dir), *frames, now=NOW)[name]
        current = derive(spark, sf_dir, stored_sql(name).replace('"', "`")).select(*changes.columns)
        path = scratch_dir(spark, name)
        write_buckets(current, path, [key], BUCKETS)
        put_buckets(spark, path, changes, current.schema, [key], [key], BUCKETS)
        return read_buckets(spark, path, current.schema).drop(BUCKET)

    query.__doc__ = f"The whole {name} table after a load from CSV files, its touched buckets rewritten."
    return query


MEMBERS = """SELECT 'a' || lpad(CAST(CAST(floor(o_orderkey / 100) AS BIGINT) AS STRING), 9, '0') AS archive,
    o_orderkey % 100 AS pos, CASE WHEN o_orderkey % 3 = 0 THEN '000007' WHEN o_custkey % 9 = 0 THEN 'xxxxxx'
    ELSE lpad(CAST(o_custkey AS STRING), 6, '0') END || '_' || CAST(o_orderkey AS STRING) || '.jpg' AS filename
    FROM {orders}"""
IMAGE_PRODUCTS = """SELECT 'p' || CAST(p_partkey AS STRING) AS "productId", lpad(CAST(p_partkey AS STRING), 6, '0') AS sku,
    'none' AS image FROM {part}
    UNION ALL SELECT 'q' || CAST(p_partkey AS STRING), lpad(CAST(p_partkey AS STRING), 6, '0'), 'none' FROM {part}
    WHERE p_size = 1"""
EXISTING_IMAGES = """SELECT 'p' || CAST(l_partkey AS STRING) AS "productImageProductId" FROM {lineitem}
    WHERE l_returnflag = 'R'"""
IMAGE_INPUTS = dict(members=MEMBERS, products=IMAGE_PRODUCTS, existing=EXISTING_IMAGES)


def image_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [derive(spark, sf_dir, text.replace('"', "`")) for text in IMAGE_INPUTS.values()]
    return register_images(*frames, now=STAMP)


def main_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = derive(spark, sf_dir, IMAGE_PRODUCTS.replace('"', "`"))
    return with_main_images(products, image_registration(spark, sf_dir))


def _id(kind: str, *parts: str) -> str:
    return "sha256(" + " || chr(31) || ".join([f"'{kind}'", *parts]) + ")"


PAD = "CASE WHEN length(category_code) <= 3 THEN '0' || category_code ELSE category_code END"
IDENTIFIED = f"""ids AS (SELECT l.*, coalesce(k.id, {_id('product', 'l.item_name')}) AS pid FROM lines l
    LEFT JOIN (SELECT name, max("productId") AS id FROM products GROUP BY name) k ON k.name = l.item_name)"""
ADDED = f"""added AS (SELECT {_id('category', 'category')} AS "categoryId", {PAD} AS code, '-' AS "parentId",
    category AS title, row_no AS first_row FROM lines l WHERE category NOT IN (SELECT title FROM categories)
    AND row_no = (SELECT min(row_no) FROM lines m WHERE m.category = l.category))"""
DIVISIONS = """known AS (SELECT "categoryId", code, "parentId", title, -1 AS first_row FROM categories
    UNION ALL SELECT * FROM added),
  by_code AS (SELECT * FROM known QUALIFY row_number() OVER (PARTITION BY code ORDER BY first_row, "categoryId") = 1),
  rooted AS (SELECT b.code, b.first_row, CASE WHEN b."parentId" <> '-' THEN coalesce(p.code, b.code) ELSE b.code END
      AS root_code, CASE WHEN b."parentId" <> '-' THEN coalesce(p.title, b.title) ELSE b.title END AS root_title
    FROM by_code b LEFT JOIN known p ON p."categoryId" = b."parentId")"""


def _price(price: str, discount: str) -> str:
    amount = f"CASE WHEN {price} = '' THEN 1.0 ELSE CAST({price} AS DOUBLE) END"
    return f"({amount}) * 100 / nullif({_number(discount)}, 0)"


def _number(c: str) -> str:
    return f"(CASE WHEN {c} = '' THEN 1.0 ELSE CAST(replace({c}, '%', '') AS DOUBLE) END)"


PRODUCT_SQL = f"""WITH {IDENTIFIED}, {ADDED}, {DIVISIONS},
  last AS (SELECT ids.*, a.first_row IS NOT NULL AS adds FROM ids LEFT JOIN added a ON a.title = category
    AND a.first_row = row_no QUALIFY row_number() OVER (PARTITION BY pid ORDER BY row_no DESC) = 1)
SELECT 0 AS "minDeliveryDuration", coalesce(r.root_code, {PAD}) AS "divisionCode",
  coalesce(r.root_title, category) AS "divisionDesc", pid AS "productId",
  CASE WHEN adds THEN {PAD} ELSE category_code END AS "itemCategoryCode", category AS "itemCategoryDesc",
  item_name AS name, 'Product' AS __typename,
  CASE WHEN length(group_code) <= 5 THEN '0' || group_code ELSE group_code END AS "productGroupCode",
  "group" AS "productGroupDesc", title, description, unit AS uom, item_code AS sku, category AS categories, image,
  department AS "departmentLevel1", sub_department AS "departmentLevel2", TRY_CAST(dimension AS DOUBLE) AS dimension,
  TRY_CAST(temperature AS DOUBLE) AS temperature, {_number('delivery_price')} AS price,
  {_number('pickup_price')} AS "pickupPrice", {_number('delivery_discount')} AS discount,
  {_price('delivery_price', 'delivery_discount')} AS "discountedPrice", {_number('pickup_discount')} AS "pickupDiscount",
  {_price('pickup_price', 'pickup_discount')} AS "pickupDiscountedPrice",
  TRY_CAST(max_delivery_quantity AS DOUBLE) AS "ecommerceMaximumQuantity",
  TRY_CAST(max_pickup_quantity AS DOUBLE) AS "pickupMaximumQuantity",
  TRY_CAST(preparation_time AS DOUBLE) AS "minFoodPreparationDuration", '{STAMP}' AS "updatedAt",
  '2020-02-03T00:00:00.000000Z' AS "discountStartDate", '2020-02-03T00:00:00.000000Z' AS "pickupDiscountStartDate",
  '2020-01-15T00:00:00.000000Z' AS "itemPublishStartDate", '' AS "itemPublishEndDate", '{STAMP}' AS "createdAt",
  false AS "isDisabled"
FROM last LEFT JOIN rooted r ON r.code = {PAD} AND r.first_row < row_no AND NOT adds"""
NEW_DEPARTMENTS = f"""fresh AS (SELECT {_id('department', 'title')} AS id, title, pid FROM (
      SELECT row_no, 0 AS level, department AS title, pid FROM ids
      UNION ALL SELECT row_no, 1, sub_department, pid FROM ids)
    WHERE title NOT IN (SELECT title FROM departments)
    QUALIFY row_number() OVER (PARTITION BY title ORDER BY row_no, level) = 1)"""
TAGGED = f"""pairs AS (SELECT DISTINCT pid, unnest(string_split(image, ', ')) AS title FROM ids),
  tagged AS (SELECT pid, p.title, t.id IS NULL AS is_new, coalesce(t.id, {_id('tag', 'p.title')}) AS tid FROM pairs p
    LEFT JOIN (SELECT title, min("productTaggingId") AS id FROM tags GROUP BY title) t ON t.title = p.title)"""
EFFECTIVE = f"""'{STAMP}' AS "createdAt", '{STAMP}' AS "updatedAt", '{STAMP}' AS "effectiveStartDate",
  '{YEAR_END}' AS "effectiveEndDate", false AS "isDisabled", 'robot' AS "modifiedBy" """
IMAGE_SQL = f"""WITH sku AS (SELECT sku, min("productId") AS pid FROM products GROUP BY sku),
  n AS (SELECT "productImageProductId" AS pid, COUNT(*) AS c FROM existing GROUP BY ALL),
  img AS (SELECT {_id('image', 's.pid', 'archive', 'CAST(pos AS VARCHAR)')} AS "productImageId",
    s.pid AS "productImageProductId",
    coalesce(c, 0) + row_number() OVER (PARTITION BY s.pid ORDER BY archive, pos) - 1 AS sequence,
    'product/images/' || filename AS image, '{STAMP}' AS "createdAt", '{STAMP}' AS "updatedAt",
    c IS NULL AND row_number() OVER (PARTITION BY s.pid ORDER BY archive, pos) = 1 AS first
    FROM members m JOIN sku s ON s.sku = substr(filename, 1, 6) LEFT JOIN n ON n.pid = s.pid)
"""

QUERIES = {
    "catalogue_products": catalogue_products,
    "catalogue_categories": catalogue_categories,
    "catalogue_departments": catalogue_departments,
    "catalogue_product_departments": catalogue_product_departments,
    "catalogue_tags": catalogue_tags,
    "catalogue_tag_mappings": catalogue_tag_mappings,
    "catalogue_upsert": catalogue_upsert,
    "image_registration": image_registration,
    "main_images": main_images,
}
BODIES = {
    "product": PRODUCT_SQL,
    "category": f"""WITH {ADDED} SELECT "categoryId", code, "parentId", title, '{STAMP}' AS "createdAt", '{STAMP}' AS "updatedAt",
        'Category' AS __typename FROM added""",
    "department": f"""WITH {IDENTIFIED}, {NEW_DEPARTMENTS} SELECT id AS "departmentId", title, {EFFECTIVE}, '-' AS "parentId",
        'Department' AS __typename FROM fresh""",
    "product_department": f"""WITH {IDENTIFIED}, {NEW_DEPARTMENTS}, roots AS (SELECT title, min("departmentId") AS id FROM departments
            WHERE "parentId" = '-' GROUP BY title UNION ALL SELECT title, id FROM fresh),
          pairs AS (SELECT r.id AS did, pid FROM ids JOIN roots r ON r.title = department
            WHERE sub_department IN (SELECT title FROM departments) UNION SELECT id, pid FROM fresh)
        SELECT {_id('product_department', 'pid', 'did')} AS "productDepartmentId",
          did AS "productDepartmentDepartmentId", pid AS "productDepartmentProductId", '{STAMP}' AS "createdAt",
          '{STAMP}' AS "updatedAt", 'ProductDepartment' AS __typename FROM pairs""",
    "tagging": f"""WITH {IDENTIFIED}, {TAGGED} SELECT DISTINCT tid AS "productTaggingId", title, {EFFECTIVE}, '' AS image,
        'robot' AS "createdBy", '{STAMP}' AS created, '{STAMP}' AS modified, 'ProductTagging' AS __typename
        FROM tagged WHERE is_new""",
    "tagging_mapping": f"""WITH {IDENTIFIED}, {TAGGED} SELECT {_id('tag_mapping', 'pid', 'tid')} AS "productTaggingMappingId",
        pid AS "productTaggingMappingProductId", tid AS "productTaggingMappingProductTaggingId", '{STAMP}' AS "createdAt",
        '{STAMP}' AS "updatedAt" FROM tagged""",
}
TABLES = {
    "product": "products", "category": "categories", "department": "departments", "product_department": "product_departments",
    "tagging": "tags", "tagging_mapping": "tag_mappings",
}
QUERIES |= {f"catalogue_put_{TABLES[name]}": _put(name) for name in STORED}


def _put_sql(name: str) -> str:
    key, _, _ = STORED[name]
    return with_inputs(
        f"""WITH changes AS ({BODIES[name]}) SELECT * FROM changes
        UNION ALL BY NAME SELECT * FROM held WHERE "{key}" NOT IN (SELECT "{key}" FROM changes)""",
        **{**INPUTS, "lines": FILE_ROWS}, held=stored_sql(name),
    )


ORACLES = {
    **{f"catalogue_{TABLES[name]}": with_inputs(body, **INPUTS) for name, body in BODIES.items()},
    **{f"catalogue_put_{TABLES[name]}": _put_sql(name) for name in BODIES},
    "catalogue_upsert": with_inputs(
        f"""WITH {IDENTIFIED} SELECT "productId", name FROM products WHERE "productId" NOT IN (SELECT pid FROM ids)
        UNION ALL SELECT DISTINCT pid, item_name FROM ids""",
        **INPUTS,
    ),
    "image_registration": with_inputs(IMAGE_SQL + "SELECT * FROM img", **IMAGE_INPUTS),
    "main_images": with_inputs(
        IMAGE_SQL + """SELECT p."productId", p.sku, coalesce(i.image, p.image) AS image FROM products p
        LEFT JOIN img i ON i.first AND i."productImageProductId" = p."productId" """,
        **IMAGE_INPUTS,
    ),
}
