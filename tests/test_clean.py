"""Filters, dates and projections at their edges."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import clean


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


def test_price_bounds_are_inclusive_and_nulls_go(spark):
    df = spark.createDataFrame(
        [(1, 10.0), (2, 350.0), (3, 9.99), (4, 350.01), (5, None)], "i int, price double"
    )
    assert column(clean.price_range(df, "price", 10, 350), "i") == [1, 2]
    with pytest.raises(ValueError):
        clean.price_range(df, "price", 10, 10)


def test_dates_in_several_formats(spark):
    texts = ["2019-07-08", "07/08/2019", "08.07.2019", " 2019/07/08 ", "2019-07-08 12:30:00",
             "2019-07-08T01:02:03", "2019-07-08T01:02:03.456Z", "2019-07-08 1:02 +01:00", "7/8/2019", "2019-7-8",
             "20190708", "8 Jul 2019", "8 July 2019", "Jul 8, 2019", "July 8 2019", "7/8/2019 12:30",
             "2019-13-45", "soon", "8 Foo 2019", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, d string")
    day = datetime.date(2019, 7, 8)
    assert column(clean.clean_dates(df, ["d"]), "d") == [day] * 16 + [None] * 5
    assert [tuple(r) for r in clean.lost_dates(df, ["d"]).collect()] == [("d", 19, 3)]


def test_formats_with_names_are_tried_as_they_are(spark):
    texts = ["8 Jul 2019", "08 Jul 2019", "2019-07-08", "July"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, d string")
    day = datetime.date(2019, 7, 8)
    got = clean.clean_dates(df, ["d"], ["d MMM yyyy", "yyyy-MM-dd"])
    assert column(got, "d") == [day, day, day, None]


def test_timestamps_lose_the_time(spark):
    df = spark.sql("select 1 as i, timestamp_ntz'2020-02-03 04:05:06' as d")
    assert column(clean.clean_dates(df, ["d"]), "d") == [datetime.date(2020, 2, 3)]


def test_box_borders_are_inside_and_missing_coordinates_outside(spark):
    df = spark.createDataFrame(
        [(1, -74.25, 40.5), (2, -73.5, 41.2), (3, -73.49, 41.0), (4, None, 41.0), (5, -74.0, None)],
        "i int, longitude double, latitude double",
    )
    assert column(clean.bounding_box(df, "longitude", "latitude"), "i") == [1, 2]


def test_cleaning_keeps_columns_and_order(spark):
    df = spark.createDataFrame(
        [(1, -74.0, 41.0, 100.0, "2019-01-02"), (2, -74.0, 41.0, 5.0, "2019-01-02")],
        "i int, longitude double, latitude double, price double, last_review string",
    )
    cleaned = clean.clean_listings(df, 10, 350)
    assert cleaned.columns == df.columns
    assert column(cleaned, "i") == [1]


def test_filters_reach_the_scan(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    kept = clean.price_range(orders, "o_totalprice", 50_000.0, 350_000.0).select("o_orderkey")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_totalprice,50000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_label_and_features(spark):
    df = spark.range(3).select(F.col("id").alias("i"), F.lit(1.0).alias("price"), F.lit("x").alias("n"))
    features, label = clean.split_label(df, "price")
    assert features.columns == ["i", "n"] and label.columns == ["price"]
    assert clean.keep_features(df, ["n"], extra=["i"]).columns == ["i", "n"]
