"""The given tables, and the listing table derived from them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans.lookups import join_lookup, stored_lookup
from tallyhouse.schemas import LISTING

SEED = 42
TEST_SIZE = 0.2
VAL_SIZE = 0.2

# The market segments of the customers, the five strata of the listings.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the shape of listings, with gaps in category, date and line attributes.

    Line attributes are summed up per order before the orders join.
    """
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_size", "p_retailprice"
    )
    lines = join_lookup(
        table(spark, folder, "lineitem").select(
            "l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_discount"
        ),
        stored_lookup(part.hint("shuffle_hash")),
        ["l_partkey"],
        "inner",
        spread_by=["l_orderkey"],
    )
    # Dealt out by order first: few lines of an order meet before, so sums made there would save nothing.
    per_order = lines.repartition("l_orderkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("p_name").alias("name"),
        F.min("p_retailprice").alias("latitude"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
        F.count(F.lit(1)).cast("int").alias("minimum_nights"),
        F.sum("l_quantity").cast("int").alias("number_of_reviews"),
        F.max("l_discount").alias("reviews_per_month"),
        F.max("p_size").alias("calculated_host_listings_count"),
    )
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("neighbourhood")
    )
    customer = join_lookup(
        table(spark, folder, "customer"),
        stored_lookup(nation),
        ["c_nationkey"],
        "left",
        spread_by=["c_custkey"],
    ).withColumnRenamed("c_custkey", "o_custkey")
    orders = join_lookup(
        table(spark, folder, "orders").join(per_order, "o_orderkey", "left"),
        stored_lookup(customer),
        ["o_custkey"],
        "left",
        spread_by=["o_orderkey"],
    )
    named = orders.select(
        F.col("o_orderkey").alias("id"),
        "name",
        F.col("o_custkey").alias("host_id"),
        F.col("c_name").alias("host_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("neighbourhood_group"),
        "neighbourhood",
        "latitude",
        F.col("c_acctbal").alias("longitude"),
        F.col("o_orderstatus").alias("room_type"),
        "price",
        "minimum_nights",
        "number_of_reviews",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("last_review"),
        "reviews_per_month",
        "calculated_host_listings_count",
        F.dayofyear(F.col("o_orderdate").cast("date")).alias("availability_365"),
    )
    return named.select(*LISTING.names)


# The same table in SQL, to put in front of a query.
LISTING_SQL = """
lines AS (
  SELECT l_orderkey, min(p_name) AS name, min(p_retailprice) AS latitude,
         sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price,
         count(*)::INTEGER AS minimum_nights, sum(l_quantity)::INTEGER AS number_of_reviews,
         max(l_discount) AS reviews_per_month, max(p_size) AS calculated_host_listings_count
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey
),
listing AS (
  SELECT o_orderkey AS id, lines.name, o_custkey AS host_id, c_name AS host_name,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS neighbourhood_group,
         n_name AS neighbourhood, latitude, c_acctbal AS longitude,
         o_orderstatus AS room_type, price, minimum_nights, number_of_reviews,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS last_review,
         reviews_per_month, calculated_host_listings_count,
         dayofyear(o_orderdate)::INTEGER AS availability_365
  FROM orders
  LEFT JOIN lines ON o_orderkey = l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
)
"""
