"""Column lists and types of every stage, from raw feed to dimension."""

from pyspark.sql import types as T

# Headers of the raw sheet, in order, with the column name used here.
HEADERS = {
    "SKU": "sku",
    "Product Name": "product_name",
    "Image URL": "image_url",
    "Product URL": "product_url",
    "Current Price": "current_price",
    "Old Price": "old_price",
    "Discount %": "discount",
    "Rating": "rating",
    "Reviews Count": "reviews_count",
}

FEED_COLUMNS = list(HEADERS.values())

# Raw text is never type-inferred: types would then depend on the data.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FEED_COLUMNS])

PRICE = T.DecimalType(18, 2)
PERCENT = T.DecimalType(8, 2)
RATING = T.DecimalType(4, 2)

# The attributes whose change opens a new version, in fingerprint order.
TRACKED = [
    "product_name",
    "image_url",
    "product_url",
    "current_price",
    "old_price",
    "discount_percent",
    "rating",
    "reviews_count",
]

STAGING_SCHEMA = T.StructType(
    [
        T.StructField("stage_id", T.LongType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("product_url", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("old_price", T.DoubleType()),
        T.StructField("discount", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("reviews_count", T.StringType()),
        T.StructField("load_batch_id", T.StringType()),
    ]
)

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("stage_id", T.LongType()),
        T.StructField("sku", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("product_url", T.StringType()),
        T.StructField("current_price", PRICE),
        T.StructField("old_price", PRICE),
        T.StructField("discount_percent", PERCENT),
        T.StructField("rating", RATING),
        T.StructField("reviews_count", T.IntegerType()),
        T.StructField("row_hash", T.StringType()),
    ]
)

DIMENSION_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        *SOURCE_SCHEMA.fields[:-1],
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("st_date", T.TimestampNTZType()),
        T.StructField("end_date", T.TimestampNTZType()),
        T.StructField("iscurrent", T.IntegerType()),
        T.StructField("row_hash", T.StringType()),
    ]
)

# The two tables of a version store: versions as they were opened, and finished loads.
VERSIONS = T.StructType(
    [*DIMENSION_SCHEMA, T.StructField("load_id", T.StringType()), T.StructField("bucket", T.IntegerType())]
)
LOADS = T.StructType(
    [
        T.StructField("load_no", T.LongType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("change_time", T.TimestampNTZType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("last_product_id", T.LongType()),
        T.StructField("last_stage_id", T.LongType()),
    ]
)

# The columns of an export, in order.
EXPORT_COLUMNS = [
    "product_id",
    "sku",
    "product_name",
    "image_url",
    "product_url",
    "current_price",
    "old_price",
    "discount_percent",
    "rating",
    "reviews_count",
    "st_date",
    "end_date",
    "iscurrent",
]
