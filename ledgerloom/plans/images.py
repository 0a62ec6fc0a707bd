"""Product images: registration of archive members, and planned renditions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.texts import key_base, key_extension, rendition_name, stable_id
from ..operators.lookups import first_per_key
from ..operators.measures import children_per_key
from ..operators.slices import running_position
from ..operators.upsert import update_column

# Fixed values.
SKU_LENGTH = 6
IMAGE_FOLDER = "product/images/"
SIZES = [50, 100, 200, 400, 800, 1600]


def register_images(
    members: DataFrame, products: DataFrame, existing: DataFrame, now: str
) -> DataFrame:
    """One image row for every archive member whose name starts with a product's sku.

    Numbers continue after the product's existing images, in archive order. `first`
    marks the image that becomes the product's own, which had none.
    """
    by_sku = first_per_key(products.select("sku", "productId"), ["sku"], ["productId"])
    counted = children_per_key(existing, "productImageProductId", "existing")
    matched = (
        members.withColumn("sku", F.substring("filename", 1, SKU_LENGTH))
        .join(by_sku, "sku")
        .select("productId", "archive", "pos", "filename")
    )
    numbered = running_position(matched, ["productId"], ["archive", "pos"], "position")
    before = F.coalesce("existing", F.lit(0))
    image = F.concat(F.lit(IMAGE_FOLDER), F.col("filename"))
    return numbered.join(
        counted, F.col("productId") == F.col("productImageProductId"), "left"
    ).select(
        stable_id("image", "productId", "archive", F.col("pos").cast("string")).alias("productImageId"),
        F.col("productId").alias("productImageProductId"),
        (before + F.col("position") - 1).alias("sequence"),
        image.alias("image"),
        F.lit(now).alias("createdAt"),
        F.lit(now).alias("updatedAt"),
        ((before == 0) & (F.col("position") == 1)).alias("first"),
    )


def with_main_images(products: DataFrame, registered: DataFrame) -> DataFrame:
    """Products whose image is set to the first one registered, where they had none."""
    firsts = registered.where("first").select(
        F.col("productImageProductId").alias("productId"), "image"
    )
    return update_column(products, firsts, ["productId"], "image")


def rendition_plan(images: DataFrame, key: str = "key", width: str = "width", height: str = "height") -> DataFrame:
    """(key, size, target_width, target_height, target_key) for every smaller size.

    The longer side takes the size, the other is scaled and cut to a whole number;
    a side of 0 drops the rendition.
    """
    w, h, size = F.col(width), F.col(height), F.col("size")
    sized = images.withColumn("size", F.explode(F.array(*[F.lit(s) for s in SIZES])))
    fitting = sized.where(size <= F.greatest(w, h))
    planned = fitting.withColumns(
        {
            "target_width": F.when(w >= h, size).otherwise((size / h * w).cast("int")),
            "target_height": F.when(w > h, (size / w * h).cast("int")).otherwise(size),
        }
    ).where((F.col("target_width") != 0) & (F.col("target_height") != 0))
    name = rendition_name(key_base(key), "target_width", "target_height", key_extension(key))
    return planned.select(key, "size", "target_width", "target_height", name.alias("target_key"))
