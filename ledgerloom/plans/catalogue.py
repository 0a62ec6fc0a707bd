"""Catalogue load: one product list gives rows for six tables.

Ids are hashes of the keys they stand for. So no table has to be written before the
next one can refer to it, and a rerun writes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import number_or, percent_or, scaled_price
from ..functions.dates import iso_stamp, month_first_iso, year_end_stamp
from ..functions.labels import prefixed_code
from ..functions.texts import stable_id
from ..operators.lookups import drop_matches, first_per_key, keep_matches, last_value_per_key, with_parent

# The list's columns by position, and marks in the stored rows.
COLUMNS = [
    "item_code", "item_name", "category_code", "category", "group_code", "group", "dimension",
    "temperature", "title", "description", "department", "sub_department", "unit", "pickup_price",
    "delivery_price", "unused", "publish_start", "publish_end", "pickup_discount",
    "delivery_discount", "discount_start", "discount_end", "max_pickup_quantity",
    "max_delivery_quantity", "preparation_time", "image",
]
SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in COLUMNS])
ROOT = "-"
EDITOR = "robot"
SHORT_GROUP_CODE = 5
SHORT_CATEGORY_CODE = 3


def with_product_ids(rows: DataFrame, products: DataFrame, scan_order: str = "productId") -> DataFrame:
    """Adds `productId`: the id of the product of that name, the last one where names
    repeat, or a new one."""
    known = last_value_per_key(
        products.select("name", "productId", F.col(scan_order).alias("_order")), "name", "productId", "_order"
    )
    return rows.join(
        known.select(F.col("name").alias("item_name"), F.col("productId").alias("_known")),
        "item_name", "left",
    ).withColumn("productId", F.coalesce("_known", stable_id("product", "item_name"))).drop("_known")


def new_categories(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """(categoryId, code, parentId, title, first_row) of titles that the table lacks."""
    fresh = drop_matches(rows, categories.select(F.col("title").alias("category")), "category")
    first = first_per_key(fresh.select("category", "category_code", "row_no"), ["category"], ["row_no"])
    return first.select(
        stable_id("category", "category").alias("categoryId"),
        prefixed_code("category_code", SHORT_CATEGORY_CODE).alias("code"),
        F.lit(ROOT).alias("parentId"),
        F.col("category").alias("title"),
        F.col("row_no").alias("first_row"),
    )


def with_divisions(rows: DataFrame, categories: DataFrame, added: DataFrame) -> DataFrame:
    """Adds `division_code`, `division` and `adds_category`.

    The first row of a new category is its own division. Any other row looks its
    code up and takes the parent's code and title where the category has a parent.
    """
    known = categories.select("categoryId", "code", "parentId", "title", F.lit(-1).cast("long").alias("first_row"))
    rooted = with_parent(known.unionByName(added), "categoryId", "parentId", "code", "title", ROOT)
    by_code = first_per_key(rooted, ["code"], ["first_row", "categoryId"]).select(
        F.col("code").alias("_code"), F.col("first_row").alias("_since"), "root_code", "root_title"
    )
    adding = added.select(F.col("title").alias("category"), F.col("first_row").alias("_first"))
    code = prefixed_code("category_code", SHORT_CATEGORY_CODE)
    available = (F.col("_code") == code) & (F.col("_since") < F.col("row_no"))
    adds = F.coalesce(F.col("_first") == F.col("row_no"), F.lit(False))
    return (
        rows.join(adding, "category", "left")
        .withColumn("adds_category", adds)
        .join(by_code, available & ~F.col("adds_category"), "left")
        .withColumns(
            {
                "division_code": F.coalesce("root_code", code),
                "division": F.coalesce("root_title", "category"),
            }
        )
        .drop("_first", "_code", "_since", "root_code", "root_title")
    )


def product_rows(rows: DataFrame, categories: DataFrame, added: DataFrame, now: str) -> DataFrame:
    """One product row per product id. The first row of a name creates the product and
    later ones overwrite it, so the last row's values stay."""
    last = first_per_key(with_divisions(rows, categories, added), ["productId"], [F.col("row_no").desc()])
    stamp = iso_stamp(F.lit(now).cast("timestamp_ntz"))
    delivery, pickup = number_or("delivery_price"), number_or("pickup_price")
    delivery_off, pickup_off = number_or("delivery_discount"), percent_or("pickup_discount")
    raw_code = F.col("category_code")
    start = month_first_iso("discount_start")
    return last.select(
        F.lit(0).alias("minDeliveryDuration"),
        F.col("division_code").alias("divisionCode"),
        F.col("division").alias("divisionDesc"),
        "productId",
        F.when(F.col("adds_category"), prefixed_code(raw_code, SHORT_CATEGORY_CODE))
        .otherwise(raw_code).alias("itemCategoryCode"),
        F.col("category").alias("itemCategoryDesc"),
        F.col("item_name").alias("name"),
        F.lit("Product").alias("__typename"),
        prefixed_code("group_code", SHORT_GROUP_CODE).alias("productGroupCode"),
        F.col("group").alias("productGroupDesc"),
        "title",
        "description",
        F.col("unit").alias("uom"),
        F.col("item_code").alias("sku"),
        F.col("category").alias("categories"),
        "image",
        F.col("department").alias("departmentLevel1"),
        F.col("sub_department").alias("departmentLevel2"),
        F.col("dimension").try_cast("double").alias("dimension"),
        F.col("temperature").try_cast("double").alias("temperature"),
        delivery.alias("price"),
        pickup.alias("pickupPrice"),
        delivery_off.alias("discount"),
        scaled_price(delivery, delivery_off).alias("discountedPrice"),
        pickup_off.alias("pickupDiscount"),
        scaled_price(pickup, pickup_off).alias("pickupDiscountedPrice"),
        F.col("max_delivery_quantity").try_cast("double").alias("ecommerceMaximumQuantity"),
        F.col("max_pickup_quantity").try_cast("double").alias("pickupMaximumQuantity"),
        F.col("preparation_time").try_cast("double").alias("minFoodPreparationDuration"),
        stamp.alias("updatedAt"),
        start.alias("discountStartDate"),
        start.alias("pickupDiscountStartDate"),
        month_first_iso("publish_start").alias("itemPublishStartDate"),
        month_first_iso("publish_end").alias("itemPublishEndDate"),
        stamp.alias("createdAt"),
        F.lit(False).alias("isDisabled"),
    )


def new_departments(rows: DataFrame, departments: DataFrame) -> DataFrame:
    """(departmentId, title, productId) of titles that the table lacks, with the
    product of the first row that names them. Sub-departments count as roots too."""
    named = rows.select(
        "row_no", "productId", F.posexplode(F.array("department", "sub_department")).alias("level", "title")
    )
    fresh = drop_matches(named, departments.select("title"), "title")
    return first_per_key(fresh, ["title"], ["row_no", "level"]).select(
        stable_id("department", "title").alias("departmentId"), "title", "productId"
    )


def product_departments(rows: DataFrame, departments: DataFrame, added: DataFrame) -> DataFrame:
    """(departmentId, productId) pairs, each once.

    A row whose sub-department was known before joins the root department of its
    department title; a new department joins the product that brought it.
    """
    roots = first_per_key(
        departments.where(F.col("parentId") == ROOT).select("title", "departmentId"), ["title"], ["departmentId"]
    ).unionByName(added.select("title", "departmentId"))
    grouped = keep_matches(rows, departments.select(F.col("title").alias("sub_department")), "sub_department")
    joined = grouped.join(roots.withColumnRenamed("title", "department"), "department").select(
        "departmentId", "productId"
    )
    return joined.unionByName(added.select("departmentId", "productId")).distinct()


def product_tags(rows: DataFrame, taggings: DataFrame, tag_column: str = "image") -> DataFrame:
    """(productId, title, productTaggingId, is_new), every pair of product and tag once."""
    tags = rows.select("productId", F.explode(F.split(tag_column, ", ")).alias("title")).distinct()
    known = first_per_key(taggings.select("title", "productTaggingId"), ["title"], ["productTaggingId"])
    return tags.join(
        known.withColumnRenamed("productTaggingId", "_known"), "title", "left"
    ).select(
        "productId",
        "title",
        F.coalesce("_known", stable_id("tag", "title")).alias("productTaggingId"),
        F.col("_known").isNull().alias("is_new"),
    )


def catalogue_load(
    rows: DataFrame, products: DataFrame, categories: DataFrame, departments: DataFrame,
    taggings: DataFrame, now: str, tag_column: str = "image", editor: str = EDITOR,
) -> dict[str, DataFrame]:
    """Changes for the six tables, to be put in by key.

    `rows` holds `row_no` and the list's columns. Tags are read from the image
    column unless another is named. `editor` signs new departments and tags.
    """
    stamp = iso_stamp(F.lit(now).cast("timestamp_ntz"))
    year_end = year_end_stamp(F.lit(now).cast("timestamp_ntz"))
    identified = with_product_ids(rows, products)
    added = new_categories(identified, categories)
    fresh_departments = new_departments(identified, departments)
    tags = product_tags(identified, taggings, tag_column)
    times = {"createdAt": stamp, "updatedAt": stamp}
    effective = {"effectiveStartDate": stamp, "effectiveEndDate": year_end, "isDisabled": F.lit(False),
                 "modifiedBy": F.lit(editor)}
    return {
        "product": product_rows(identified, categories, added, now),
        "category": added.drop("first_row").withColumns({**times, "__typename": F.lit("Category")}),
        "department": fresh_departments.drop("productId").withColumns(
            {**times, **effective, "parentId": F.lit(ROOT), "__typename": F.lit("Department")}
        ),
        "product_department": product_departments(identified, departments, fresh_departments).select(
            stable_id("product_department", "productId", "departmentId").alias("productDepartmentId"),
            F.col("departmentId").alias("productDepartmentDepartmentId"),
            F.col("productId").alias("productDepartmentProductId"),
            stamp.alias("createdAt"), stamp.alias("updatedAt"),
            F.lit("ProductDepartment").alias("__typename"),
        ),
        "tagging": tags.where("is_new").select("productTaggingId", "title").distinct().withColumns(
            {**times, **effective, "image": F.lit(""), "createdBy": F.lit(editor), "created": stamp,
             "modified": stamp, "__typename": F.lit("ProductTagging")}
        ),
        "tagging_mapping": tags.select(
            stable_id("tag_mapping", "productId", "productTaggingId").alias("productTaggingMappingId"),
            F.col("productId").alias("productTaggingMappingProductId"),
            F.col("productTaggingId").alias("productTaggingMappingProductTaggingId"),
            stamp.alias("createdAt"), stamp.alias("updatedAt"),
        ),
    }
