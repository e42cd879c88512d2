"""Lookups and exact ranks: every path gives the same rows as the plain form."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import ranks
from tallyhouse.plans.lookups import Lookup, derived_lookup, hot_keys, join_lookup, stored_lookup
from tallyhouse.plans.ranks import cut_points


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows have key 0; keys 90..99 have no partner."""
    return spark.range(20_000).select(
        F.col("id"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 100).cast("int").alias("k"),
    )


@pytest.fixture(scope="module")
def partners(spark):
    return spark.range(90).select(
        F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v")
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, partners, how):
    plain = skewed.join(partners, ["k"], how)
    salted = join_lookup(skewed, Lookup(partners, False), ["k"], how, ["id"], salts=8, share=0.1)
    assert "_salt" not in salted.columns
    assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()


def test_hot_keys_are_found_and_only_those(spark, skewed):
    zero = spark.range(1).select(F.xxhash64(F.lit(0))).first()[0]
    assert hot_keys(skewed, ["k"], 0.1) == [zero]
    assert hot_keys(skewed, ["id"], 0.1) == []
    assert hot_keys(skewed.where("id < 0"), ["k"], 0.1) == []


def test_derived_lookup_checks_its_size(partners):
    assert derived_lookup(partners, 90).fits
    large = derived_lookup(partners, 89)
    assert not large.fits and large.table.count() == 90


def test_lookups_are_bounded_in_bytes(spark):
    """A few rows with long texts, arrays or bytes do not fit; nulls and empty tables do."""
    long = spark.range(20).select("id", F.repeat(F.lit("ä"), 1000).alias("t"))
    assert stored_lookup(long, max_bytes=40_000 + 320).fits
    assert not stored_lookup(long, max_bytes=40_000 + 319).fits
    large = derived_lookup(long, max_bytes=30_000)
    assert not large.fits and large.rows is None and large.table.count() == 20
    nested = long.select("id", F.array("t", "t").alias("a"), F.struct("t").alias("s"), F.lit(None).alias("n"))
    assert not stored_lookup(nested, max_bytes=40_000).fits
    assert stored_lookup(nested.limit(0), 0, 0).fits
    assert not stored_lookup(long, max_rows=19).fits
    odd = spark.createDataFrame([(1, None, b"abc")], "`a.b` int, `c``d` string, e binary")
    assert stored_lookup(odd, max_bytes=27).fits and not stored_lookup(odd, max_bytes=26).fits


@pytest.mark.parametrize("n_bytes", [10**9, 0])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_beyond_the_bytes_give_the_same(skewed, partners, how, n_bytes):
    plain = skewed.join(partners, ["k"], how)
    lookup = stored_lookup(partners, max_bytes=n_bytes)
    assert lookup.fits == (n_bytes > 0)
    found = join_lookup(skewed, lookup, ["k"], how, ["id"], share=0.1)
    assert plain.exceptAll(found).isEmpty() and found.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("sortable_rows, max_lookup_rows", [(10**6, 10**5), (5, 10**5), (1, 1)])
def test_cut_points_equal_sorted_positions(spark, sortable_rows, max_lookup_rows):
    rows = spark.range(3_000).select(
        F.when(F.col("id") < 2_000, "big").otherwise("small").alias("g"),
        F.md5(F.col("id").cast("string")).alias("o"),
    )
    wanted = spark.createDataFrame(
        [("big", "a", 1), ("big", "b", 777), ("big", "c", 2000), ("small", "a", 500)],
        "g string, label string, rank bigint",
    )
    got = cut_points(
        rows, wanted, ["g"], "o", 32, digits=1,
        sortable_rows=sortable_rows, max_lookup_rows=max_lookup_rows,
    ).collect()
    by_group = {}
    for r in rows.collect():
        by_group.setdefault(r["g"], []).append(r["o"])
    expected = {
        (w["g"], w["label"]): sorted(by_group[w["g"]])[w["rank"] - 1] for w in wanted.collect()
    }
    assert {(r["g"], r["label"]): r["cut"] for r in got} == expected
    assert not any(r["tied"] for r in got)


@pytest.mark.parametrize("sortable_rows", [10**6, 10])
def test_cut_points_report_ties(spark, sortable_rows):
    rows = spark.range(100).select(F.lit("g").alias("g"), F.md5(F.lit("same")).alias("o"))
    wanted = spark.createDataFrame(
        [("g", "in", 40), ("g", "last", 100)], "g string, label string, rank bigint"
    )
    got = cut_points(rows, wanted, ["g"], "o", 32, sortable_rows=sortable_rows).collect()
    assert {r["label"]: r["tied"] for r in got} == {"in": True, "last": False}


@pytest.mark.parametrize("bucket_rows", [1_000_000, 3])
def test_places_follow_the_order(spark, bucket_rows):
    rows = spark.range(500).withColumn("h", F.md5(F.col("id").cast("string")))
    placed = ranks.with_places(rows, "h", 32, "place", bucket_rows)
    assert placed.columns == ["id", "h", "place"]
    found = [r["h"] for r in placed.orderBy("place").collect()]
    assert found == sorted(found)
    assert sorted(r["place"] for r in placed.collect()) == list(range(1, 501))
    assert ranks.with_places(rows.limit(0), "h", 32, "place").count() == 0
