"""Cleaning, checks and profiles on the given tables."""

from pyspark.sql import functions as F

from tallyhouse.operators import checks, clean
from tallyhouse.plans.shared import new_folder
from tallyhouse.schemas import LISTING
from tallyhouse.workload.registry import query
from tallyhouse.workload.tables import LISTING_SQL, SEGMENTS, listings, table

BOX = {"p_size": (5, 45), "p_retailprice": (910.0, 990.0)}
LISTING_BOX = {"longitude": (-500.0, 9500.0), "latitude": (905.0, 995.0)}


@query(
    "clean_price_range",
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 50000 AND o_totalprice <= 350000
    """,
)
def clean_price_range(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return clean.price_range(orders, "o_totalprice", 50_000, 350_000)


@query(
    "clean_dates",
    """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
    FROM orders
    """,
)
def clean_dates(spark, folder):
    """Dates written in nine ways; those of pending orders are none at all."""
    d = F.col("o_orderdate")
    written = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("pending "), "o_orderpriority"))
    forms = (
        "MM/dd/yyyy", "M/d/yyyy", "yyyy-M-d", "yyyyMMdd", "d MMM yyyy", "MMMM d, yyyy", "dd.MM.yyyy",
        "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd",
    )
    for i, form in enumerate(forms):
        written = written.when(F.col("o_orderkey") % len(forms) == i, F.date_format(d, form))
    orders = table(spark, folder, "orders").select("o_orderkey", written.alias("day"))
    return clean.clean_dates(orders, ["day"]).withColumn("day", F.col("day").cast("string"))


@query(
    "clean_bounding_box",
    """
    SELECT p_partkey, p_size, p_retailprice FROM part
    WHERE p_size BETWEEN 5 AND 45 AND p_retailprice BETWEEN 910 AND 990
    """,
)
def clean_bounding_box(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    return clean.bounding_box(
        part, "p_size", "p_retailprice", BOX["p_size"], BOX["p_retailprice"]
    )


@query(
    "clean_listings",
    f"""
    WITH {LISTING_SQL}
    SELECT id, name, host_id, host_name, neighbourhood_group, neighbourhood, latitude, longitude,
           room_type, price, minimum_nights, number_of_reviews,
           strftime(last_review, '%Y-%m-%d') AS last_review, reviews_per_month,
           calculated_host_listings_count, availability_365
    FROM listing
    WHERE price BETWEEN 10000 AND 500000
      AND longitude BETWEEN -500 AND 9500 AND latitude BETWEEN 905 AND 995
    """,
)
def clean_listings(spark, folder):
    cleaned = clean.clean_listings(
        listings(spark, folder),
        10_000,
        500_000,
        longitude_box=LISTING_BOX["longitude"],
        latitude_box=LISTING_BOX["latitude"],
    )
    return cleaned.withColumn("last_review", F.col("last_review").cast("string"))


@query(
    "label_split",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate::DATE AS o_orderdate, o_orderpriority,
           o_totalprice AS label
    FROM orders
    """,
)
def label_split(spark, folder):
    """Features and label, told apart and shown side by side."""
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    features, label = clean.split_label(orders, "o_totalprice")
    (name,) = label.columns
    return orders.select(*features.columns, F.col(name).alias("label"))


@query(
    "feature_projection",
    """
    SELECT l_orderkey, l_extendedprice, l_quantity, l_discount, l_returnflag FROM lineitem
    """,
)
def feature_projection(spark, folder):
    return clean.keep_features(
        table(spark, folder, "lineitem"),
        ["l_quantity", "l_discount", "l_returnflag"],
        extra=["l_orderkey", "l_extendedprice"],
    )


@query(
    "check_schema",
    """
    SELECT position, name AS expected, name AS actual, TRUE AS passed, present FROM (
      SELECT 1::BIGINT AS position, 'o_orderkey' AS name, count(o_orderkey) AS present FROM orders
      UNION ALL SELECT 2, 'o_custkey', count(o_custkey) FROM orders
      UNION ALL SELECT 3, 'o_orderstatus', count(o_orderstatus) FROM orders
      UNION ALL SELECT 4, 'o_totalprice', count(o_totalprice) FROM orders
      UNION ALL SELECT 5, 'o_orderdate', count(o_orderdate) FROM orders
      UNION ALL SELECT 6, 'o_orderpriority', count(o_orderpriority) FROM orders
    )
    """,
)
def check_schema(spark, folder):
    expected = [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
    ]
    return checks.check_schema(table(spark, folder, "orders"), expected)


# A balance below zero hides the segment: the category column with gaps.
def gapped_customers(spark, folder):
    return table(spark, folder, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    )


@query(
    "check_domain",
    """
    WITH c AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS s FROM customer),
    k AS (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) AS s)
    SELECT count(*) FILTER (WHERE s IS NULL OR s NOT IN (SELECT s FROM k)) AS unknown_rows,
           count(DISTINCT s) FILTER (WHERE s IN (SELECT s FROM k)) AS known_found,
           5::BIGINT AS known_total,
           count(*) FILTER (WHERE s IS NULL OR s NOT IN (SELECT s FROM k)) = 0
             AND count(DISTINCT s) FILTER (WHERE s IN (SELECT s FROM k)) = 5 AS passed
    FROM c
    """,
)
def check_domain(spark, folder):
    return checks.check_domain(gapped_customers(spark, folder), "c_mktsegment", SEGMENTS)


@query(
    "check_bounds",
    """
    SELECT count(*) FILTER (WHERE NOT coalesce(p_size BETWEEN 5 AND 45
             AND p_retailprice BETWEEN 910 AND 990, FALSE)) AS violations,
           count(*) FILTER (WHERE NOT coalesce(p_size BETWEEN 5 AND 45
             AND p_retailprice BETWEEN 910 AND 990, FALSE)) = 0 AS passed
    FROM part
    """,
)
def check_bounds(spark, folder):
    return checks.check_bounds(table(spark, folder, "part"), BOX)


@query(
    "check_row_count",
    """
    SELECT count(*) AS n_rows, count(*) >= 15000 AND count(*) <= 1000000 AS passed FROM lineitem
    """,
)
def check_row_count(spark, folder):
    return checks.check_row_count(table(spark, folder, "lineitem"), 15_000, 1_000_000)


@query(
    "check_value_range",
    f"""
    WITH {LISTING_SQL}
    SELECT count(*) FILTER (WHERE price IS NULL OR price < 1000 OR price > 900000) AS violations,
           count(*) FILTER (WHERE price IS NULL OR price < 1000 OR price > 900000) = 0 AS passed
    FROM listing
    """,
)
def check_value_range(spark, folder):
    price = F.col("price").between(1_000, 900_000)
    return checks.check_condition(listings(spark, folder), price)


@query(
    "drift_kl",
    """
    WITH c AS (SELECT c_mktsegment AS s, count(*)::DOUBLE AS n FROM customer
               WHERE c_acctbal >= 2000 GROUP BY 1),
    b AS (SELECT c_mktsegment AS s, count(*)::DOUBLE AS n FROM customer
          WHERE c_acctbal < 2000 GROUP BY 1),
    p AS (SELECT s, n / (SELECT sum(n) FROM c) AS p FROM c),
    q AS (SELECT s, n / (SELECT sum(n) FROM b) AS q FROM b)
    SELECT round(sum(p * log2(p / q)), 9) AS kl, count(*) AS categories,
           sum(p * log2(p / q)) < 0.2 AS passed
    FROM p FULL JOIN q USING (s)
    """,
)
def drift_kl(spark, folder):
    customer = table(spark, folder, "customer")
    return checks.drift_kl(
        customer.where("c_acctbal >= 2000"), customer.where("c_acctbal < 2000"), "c_mktsegment"
    ).withColumn("kl", F.round("kl", 9))


@query(
    "check_suite",
    f"""
    WITH {LISTING_SQL},
    cur AS (SELECT * FROM listing WHERE host_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 2000)),
    bas AS (SELECT * FROM listing WHERE host_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 2000)),
    p AS (SELECT neighbourhood_group AS s, count(*)::DOUBLE AS n FROM cur
          WHERE neighbourhood_group IS NOT NULL GROUP BY 1),
    q AS (SELECT neighbourhood_group AS s, count(*)::DOUBLE AS n FROM bas
          WHERE neighbourhood_group IS NOT NULL GROUP BY 1),
    kl AS (SELECT sum(p.n / (SELECT sum(n) FROM p)
                      * log2((p.n / (SELECT sum(n) FROM p)) / (q.n / (SELECT sum(n) FROM q)))) AS v
           FROM p JOIN q USING (s)),
    unknown AS (SELECT count(*) AS v FROM cur WHERE neighbourhood_group IS NULL
                OR neighbourhood_group NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')),
    outside AS (SELECT count(*) AS v FROM cur WHERE NOT coalesce(
                longitude BETWEEN -500 AND 9500 AND latitude BETWEEN 905 AND 995, FALSE)),
    priced AS (SELECT count(*) AS v FROM cur WHERE NOT coalesce(price BETWEEN 1000 AND 900000, FALSE))
    SELECT 'column_names' AS "check", 1.0::DOUBLE AS observed, '16 names in order' AS "limit", TRUE AS passed
    UNION ALL SELECT 'known_categories', v, '0 unknown, 5 known',
              v = 0 AND (SELECT count(*) FROM p) = 5 FROM unknown
    UNION ALL SELECT 'inside_box', v, '0', v = 0 FROM outside
    UNION ALL SELECT 'similar_shares', round(v, 9), '< 0.2', v < 0.2 FROM kl
    UNION ALL SELECT 'row_count', count(*), '500 to 10000000', count(*) BETWEEN 500 AND 10000000 FROM cur
    UNION ALL SELECT 'price_range', v, '0', v = 0 FROM priced
    """,
)
def check_suite(spark, folder):
    """Listings of hosts with a high balance against those of the others."""
    all_listings = listings(spark, folder)
    limits = checks.SuiteLimits(
        columns=LISTING.names,
        category="neighbourhood_group",
        known=SEGMENTS,
        box=LISTING_BOX,
        price="price",
        price_bounds=(1_000.0, 900_000.0),
        row_bounds=(500, 10_000_000),
    )
    report = checks.check_suite(
        all_listings.where("longitude >= 2000"), all_listings.where("longitude < 2000"), limits
    )
    return report.withColumn("observed", F.round("observed", 9))


@query(
    "value_counts",
    """
    SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal >= 0 GROUP BY 1 ORDER BY 1
    """,
)
def value_counts(spark, folder):
    return checks.value_counts(gapped_customers(spark, folder), "c_mktsegment")


@query(
    "profile_columns",
    """
    SELECT 'o_orderkey' AS "column", count(*) AS n_rows, count(*) - count(o_orderkey) AS missing,
           count(DISTINCT o_orderkey) AS distinct_values, min(o_orderkey)::VARCHAR AS lowest,
           max(o_orderkey)::VARCHAR AS highest, round(avg(o_orderkey), 4) AS mean,
           round(stddev(o_orderkey), 4) AS deviation FROM orders
    UNION ALL
    SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), count(DISTINCT o_orderstatus),
           min(o_orderstatus), max(o_orderstatus), NULL, NULL FROM orders
    UNION ALL
    SELECT 'o_totalprice', count(*), count(*) - count(o_totalprice), count(DISTINCT o_totalprice),
           min(o_totalprice)::VARCHAR, max(o_totalprice)::VARCHAR, round(avg(o_totalprice), 4),
           round(stddev(o_totalprice), 4) FROM orders
    UNION ALL
    SELECT 'day', count(*), count(*) FILTER (WHERE o_orderstatus = 'P'),
           count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END),
           min(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END)::VARCHAR,
           max(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END)::VARCHAR, NULL, NULL FROM orders
    """,
)
def profile_columns(spark, folder):
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    orders = table(spark, folder, "orders").withColumn("day", day)
    profile = checks.profile_columns(
        orders, ["o_orderkey", "o_orderstatus", "o_totalprice", "day"], distinct="exact"
    )
    return profile.withColumns({c: F.round(c, 4) for c in ("mean", "deviation")})


@query(
    "price_histogram",
    """
    SELECT floor((l_extendedprice - 0.0) / 5000.0)::BIGINT AS bin, count(*) AS n,
           floor((l_extendedprice - 0.0) / 5000.0)::BIGINT * 5000.0::DOUBLE AS bin_low
    FROM lineitem GROUP BY 1
    """,
)
def price_histogram(spark, folder):
    return checks.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 0.0, 5_000.0)


QUANTILES_SQL = """
    SELECT f AS fraction, price AS value
    FROM (SELECT price, row_number() OVER (ORDER BY price) AS place, count(*) OVER () AS n
          FROM (SELECT o_totalprice / 64 AS price FROM orders))
    JOIN (SELECT unnest([0.0, 0.25, 0.5, 0.75, 0.99, 1.0]::DOUBLE[]) AS f)
      ON place = greatest(1, ceil(f * n))
    """
FRACTIONS = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


@query("price_quantiles", QUANTILES_SQL)
def price_quantiles(spark, folder):
    """Prices in a coarser unit, which have up to eight decimals."""
    orders = table(spark, folder, "orders").select((F.col("o_totalprice") / 64).alias("price"))
    return checks.quantiles(orders, "price", FRACTIONS)


def price_profiles(spark, folder):
    """Prices, and stored profiles of them by day, added in two batches."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"), (F.col("o_totalprice") / 64).alias("price")
    )
    path = new_folder(spark, "profiles")
    cut = F.lit("1996-01-01").cast("date")
    for batch in (orders.where(F.col("day") < cut), orders.where(F.coalesce(F.col("day") >= cut, F.lit(True)))):
        checks.profile_by(batch, "day", "price").write.mode("append").parquet(path)
    return orders, spark.read.parquet(path)


@query("profile_quantiles", QUANTILES_SQL)
def profile_quantiles(spark, folder):
    """Exact quantiles with the stored profiles in the place of a sketch of the data."""
    orders, profiles = price_profiles(spark, folder)
    return checks.quantiles(orders, "price", FRACTIONS, profiles)


@query(
    "profile_by_month",
    """
    SELECT month(o_orderdate)::INTEGER AS month, count(*) AS n, count(*) - count(o_totalprice) AS missing,
           min(o_totalprice / 64) AS lowest, max(o_totalprice / 64) AS highest
    FROM orders GROUP BY 1
    """,
)
def profile_by_month(spark, folder):
    """Profiles of days merged by month of the year, without reading the data again."""
    _, profiles = price_profiles(spark, folder)
    months = profiles.withColumn("month", F.month("part"))
    return checks.merge_profiles(months, ["month"]).drop("ranks", "values")
