"""Explicit schemas. Nothing in the package infers a type from data."""

from pyspark.sql import types as T

# The sixteen listing columns, in the order the column check demands.
LISTING = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("host_id", T.LongType()),
        T.StructField("host_name", T.StringType()),
        T.StructField("neighbourhood_group", T.StringType()),
        T.StructField("neighbourhood", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("room_type", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("minimum_nights", T.IntegerType()),
        T.StructField("number_of_reviews", T.IntegerType()),
        T.StructField("last_review", T.DateType()),
        T.StructField("reviews_per_month", T.DoubleType()),
        T.StructField("calculated_host_listings_count", T.IntegerType()),
        T.StructField("availability_365", T.IntegerType()),
    ]
)

# Known districts, coordinate box, accepted row counts, drift limit.
KNOWN_GROUPS = ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island")
LONGITUDE_BOX = (-74.25, -73.50)
LATITUDE_BOX = (40.5, 41.2)
ROW_COUNT_BOUNDS = (15_000, 1_000_000)
KL_LIMIT = 0.2
PRICE_BOUNDS = (10.0, 350.0)

# What the model uses.
LABEL = "price"
KEY = "id"
ORDINAL = "room_type"
CATEGORY = "neighbourhood_group"
ZERO_FILLED = (
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "calculated_host_listings_count",
    "availability_365",
    "longitude",
    "latitude",
)
DATE = "last_review"
TEXT = "name"
FEATURES = (ORDINAL, CATEGORY, *ZERO_FILLED, DATE, TEXT)

# Run records. `stages` is a map, which inference would turn into one field per stage.
ARTIFACT = "struct<path: string, sha256: string>"
STAGE = (
    f"struct<status: string, inputs: map<string, {ARTIFACT}>, "
    f"outputs: map<string, {ARTIFACT}>, details: string>"
)
MANIFEST = (
    "schema_version int, run_id string, status string, config string, "
    "code struct<commit: string, dirty: boolean>, created_at string, "
    f"stages map<string, {STAGE}>"
)
SPLIT = (
    "schema_version int, split_id string, source_run_id string, "
    f"source {ARTIFACT}, "
    "parameters struct<test_size: double, random_seed: bigint, stratify_by: string>, "
    f"trainval {ARTIFACT}, test {ARTIFACT}"
)
COMPARISON = (
    "run_id string, model_path string, split_id string, split_path string, "
    "parameters string, mae double, r2 double"
)
TEST_CASE = (
    "_name string, _classname string, failure string, error string, skipped string"
)

# Stage names in order, and the six checks a report must hold.
STAGES = (
    "download",
    "basic_cleaning",
    "data_check",
    "data_split",
    "train_random_forest",
    "test_regression_model",
)
TRAINING_STAGES = STAGES[:5]
CHECKS = (
    "test_column_names",
    "test_neighborhood_names",
    "test_proper_boundaries",
    "test_similar_neigh_distrib",
    "test_row_count",
    "test_price_range",
)
