"""Exact, reproducible splits."""

import hashlib
import json
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.ledger import common_rows, multiset_difference
from tallyhouse.operators.split import (
    allocate,
    fit_split,
    require_unique,
    split_identity,
    split_two,
)
from tallyhouse.plans.lookups import derived_lookup


@pytest.fixture(scope="module")
def parcels(spark):
    """63 rows in three groups of 9, 18 and 36."""
    size = F.col("id") % 7
    return spark.range(1000, 1063).select(
        "id",
        F.when(size == 0, "large").when(size < 3, "medium").otherwise("small").alias("group"),
        F.sqrt("id").alias("value"),
    )


def ids(df):
    return {r["id"] for r in df.select("id").collect()}


@pytest.mark.parametrize("stratify_by", [None, "none", "group"])
def test_disjoint_covering_exact_and_repeatable(parcels, stratify_by):
    rest, test = split_two(parcels, "id", 1 / 3, 7, stratify_by)
    assert test.count() == 21
    assert common_rows(rest, test).isEmpty()
    assert multiset_difference(rest.unionByName(test), parcels).isEmpty()
    assert ids(split_two(parcels, "id", 1 / 3, 7, stratify_by)[1]) == ids(test)
    assert ids(split_two(parcels, "id", 1 / 3, 8, stratify_by)[1]) != ids(test)
    if stratify_by == "group":
        assert Counter(r["group"] for r in test.collect()) == {"large": 3, "medium": 6, "small": 12}


def test_membership_does_not_depend_on_partitioning(spark, medium):
    orders = spark.read.parquet(f"{medium}/orders.parquet").select("o_orderkey", "o_orderpriority")
    seen = set()
    for n in (1, 4, 17):
        _, test = split_two(orders.repartition(n), "o_orderkey", 0.2, 42, "o_orderpriority")
        keys = sorted(r[0] for r in test.select("o_orderkey").collect())
        assert len(keys) == math.ceil(0.2 * orders.count())
        seen.add(tuple(keys))
    assert len(seen) == 1


def test_all_paths_give_the_same_split(spark, medium):
    """Bounds set to one row force the paths meant for very many strata and rows."""
    df = spark.read.parquet(f"{medium}/orders.parquet").select("o_orderkey", "o_custkey")
    df = df.where("o_custkey is not null")
    few = df.groupBy("o_custkey").count().where("count < 4").select("o_custkey")
    df = df.join(few, "o_custkey", "left_anti")

    def three_ways(**bounds):
        fitted = fit_split(df, "o_orderkey", 0.3, 7, "o_custkey", val_size=0.4, **bounds)
        return fitted.apply(df)

    plain, wide = three_ways(), three_ways(max_lookup_rows=1, sortable_rows=1)
    assert multiset_difference(plain, wide).isEmpty()
    assert {r[0] for r in plain.select("split").distinct().collect()} == {
        "train", "validation", "test",
    }


def test_three_way_equals_the_split_run_twice(spark, medium):
    orders = spark.read.parquet(f"{medium}/orders.parquet")
    keys = ("o_orderkey", "o_orderpriority")
    fitted = fit_split(orders, "o_orderkey", 0.2, 42, "o_orderpriority", val_size=0.2)
    once = fitted.apply(orders.select(*keys))
    rest, test = split_two(orders.select(*keys), "o_orderkey", 0.2, 42, "o_orderpriority")
    train, validation = split_two(rest, "o_orderkey", 0.2, 42, "o_orderpriority")
    parts = {"test": test, "validation": validation, "train": train}
    for name, part in parts.items():
        assert multiset_difference(once.where(F.col("split") == name).select(*keys), part).isEmpty()


def quotas_of(table, take, **bounds):
    shared = allocate(derived_lookup(table, **bounds), take, 1, 10**5)
    return {r["stratum"]: r["quota"] for r in shared.table.collect()}


@pytest.mark.parametrize("take", [1, 5, 206, 1027])
def test_shares_are_exact(spark, take):
    sizes = {"a": 10, "b": 11, "c": 3, "d": 3, "e": 1000}
    table = spark.createDataFrame(list(sizes.items()), "stratum string, n bigint")
    quotas = quotas_of(table, take)
    assert sum(quotas.values()) == take
    total = sum(sizes.values())
    for stratum, quota in quotas.items():
        assert 0 <= quota - take * sizes[stratum] // total <= 1
    assert quotas_of(table, take, max_rows=1) == quotas


def test_share_arithmetic_does_not_overflow(spark):
    table = spark.createDataFrame(
        [("a", 3 * 10**12), ("b", 7 * 10**12 + 1)], "stratum string, n bigint"
    )
    quotas = quotas_of(table, 2 * 10**12, max_rows=1)
    assert sum(quotas.values()) == 2 * 10**12
    assert quotas == quotas_of(table, 2 * 10**12)


@pytest.mark.parametrize("size", [0, 1, -0.1, 1.5])
def test_fraction_must_lie_inside(parcels, size):
    with pytest.raises(ValueError):
        fit_split(parcels, "id", size, 42)


def test_bad_strata_are_refused(spark, parcels):
    with pytest.raises(ValueError, match="nulls"):
        fit_split(parcels.withColumn("group", F.expr("nullif(group, 'small')")), "id", 0.25, 42, "group")
    lone = parcels.withColumn("group", F.when(F.col("id") == 1003, "x").otherwise(F.col("group")))
    with pytest.raises(ValueError, match="single"):
        fit_split(lone, "id", 0.25, 42, "group")
    with pytest.raises(ValueError, match="strata"):
        fit_split(parcels, "id", 0.02, 42, "group")
    with pytest.raises(ValueError, match="empty"):
        fit_split(parcels.limit(1), "id", 0.5, 42)


@pytest.mark.parametrize("max_lookup_rows", [100, 1])
def test_null_keys_are_refused(parcels, max_lookup_rows):
    gaps = parcels.withColumn("id", F.expr("nullif(id, 1007)"))
    with pytest.raises(ValueError, match="needs a key"):
        fit_split(gaps, "id", 0.25, 42, "group", max_lookup_rows=max_lookup_rows)


def test_repeated_keys_on_a_cut_are_refused(spark, parcels):
    same = parcels.withColumn("id", F.lit(1))
    with pytest.raises(ValueError, match="not unique"):
        fit_split(same, "id", 0.25, 42)
    with pytest.raises(ValueError, match="repeated"):
        require_unique(same, "id")
    require_unique(parcels, "id")


def test_identity_is_the_hash_of_canonical_json(spark):
    digest = "ab" * 32
    identity = {
        "source_sha256": digest,
        "parameters": {"test_size": 0.2, "random_seed": 42, "stratify_by": "group"},
    }
    text = json.dumps(identity, sort_keys=True, separators=(",", ":"))
    got = spark.range(1).select(split_identity(F.lit(digest), 0.2, 42, "group")).first()[0]
    assert got == hashlib.sha256(text.encode()).hexdigest()
