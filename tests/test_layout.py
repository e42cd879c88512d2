"""Tables stored by key: same rows, no exchange below their joins, also from a new session."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import ledger
from tallyhouse.operators.ledger import multiset_difference
from tallyhouse.sources import layout, tables


def same(a, b):
    return multiset_difference(a, b).isEmpty() and multiset_difference(b, a).isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled_joins(spark):
    """No side is broadcast, as with large tables."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def digests(spark):
    recorded = spark.range(5000).select(
        F.concat(F.lit("file/"), "id").alias("path"), F.md5(F.col("id").cast("string")).alias("sha256")
    )
    actual = recorded.where("path not like '%7'").withColumn(
        "sha256", F.when(F.col("path").endswith("3"), "other").otherwise(F.col("sha256"))
    )
    return recorded, actual


@pytest.mark.parametrize("n, wanted", [(0, 8), (8_000_000, 8), (8_000_001, 16), (10**9, 1024), (10**13, 1 << 16)])
def test_bucket_counts(n, wanted):
    assert layout.bucket_count(n) == wanted


def test_reconciliation_without_exchange(spark, tmp_path, digests, shuffled_joins):
    recorded, actual = digests
    plain = ledger.verify_digests(recorded, actual, ["path"])
    assert "Exchange" in plan_of(plain)
    left = layout.store_by_key(recorded, f"{tmp_path}/recorded", ["path"])
    right = layout.store_by_key(actual, f"{tmp_path}/actual", ["path"], like=f"{tmp_path}/recorded")
    found = ledger.verify_digests(left, right, ["path"])
    assert "Exchange" not in plan_of(found) and same(found, plain)
    differing = ledger.disagreements(left, right, ["path"], ["sha256"])
    assert "Exchange" not in plan_of(differing) and differing.count() == 1000
    per_key = left.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    assert "Exchange" not in plan_of(per_key)


def test_rows_that_come_later_keep_the_layout(spark, tmp_path, digests, shuffled_joins):
    recorded, actual = digests
    left = layout.store_by_key(recorded, f"{tmp_path}/recorded", ["path"])
    layout.store_by_key(actual.where("path < 'file/3'"), f"{tmp_path}/actual", ["path"], like=f"{tmp_path}/recorded")
    # Columns go by name, whatever their order.
    right = layout.append_by_key(actual.where("path >= 'file/3'").select("sha256", "path"), f"{tmp_path}/actual")
    found = ledger.verify_digests(left, right, ["path"])
    assert "Exchange" not in plan_of(found)
    assert same(found, ledger.verify_digests(recorded, actual, ["path"]))
    with pytest.raises(ValueError, match="columns and types"):
        layout.append_by_key(actual.withColumn("more", F.lit(1)), f"{tmp_path}/actual")


def test_opened_by_path_alone(spark, tmp_path, digests, shuffled_joins):
    layout.store_by_key(digests[0], f"{tmp_path}/a", ["path"])
    layout.forget(spark, f"{tmp_path}/a")
    again = layout.open_by_key(spark, f"{tmp_path}/a")
    assert same(again, digests[0])
    assert "Exchange" not in plan_of(again.join(again.alias("b").select("path"), "path"))


def test_odd_tables(spark, tmp_path):
    odd = spark.createDataFrame(
        [(1, None, "x"), (None, "k", "y"), (1, None, "x"), (2, "it's", None)], "`a b` int, `k``k` string, `it's` string"
    )
    rows = sorted(odd.collect(), key=str)
    assert sorted(layout.store_by_key(odd, f"{tmp_path}/o'dd", ["a b", "k`k"], buckets=4).collect(), key=str) == rows
    layout.forget(spark, f"{tmp_path}/o'dd")
    assert sorted(layout.open_by_key(spark, f"{tmp_path}/o'dd").collect(), key=str) == rows
    empty = layout.store_by_key(odd.limit(0), f"{tmp_path}/empty", ["a b"])
    assert empty.count() == 0 and empty.columns == odd.columns


def test_refusals(spark, tmp_path, digests):
    with pytest.raises(FileNotFoundError):
        layout.open_by_key(spark, f"{tmp_path}/nothing")
    with pytest.raises(ValueError, match="must name columns"):
        layout.store_by_key(digests[0], f"{tmp_path}/a", ["other"])
    layout.store_by_key(digests[0], f"{tmp_path}/a", ["path"])
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists|NON_EMPTY|not empty|non-empty"):
        layout.store_by_key(digests[0], f"{tmp_path}/a", ["path"])
    layout.forget(spark, f"{tmp_path}/a")
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists|NON_EMPTY|not empty|non-empty"):
        layout.store_by_key(digests[0], f"{tmp_path}/a", ["path"])
    with pytest.raises(ValueError, match="same types"):
        layout.store_by_key(spark.range(3), f"{tmp_path}/b", ["id"], like=f"{tmp_path}/a")


def test_baseline_by_key(spark, small, tmp_path, shuffled_joins):
    part = spark.read.parquet(f"{small}/part.parquet")
    tables.create_baseline(part, "runs/1/clean", "run-1", f"{tmp_path}/base", key=["p_partkey"])
    loaded = tables.load_baseline(spark, f"{tmp_path}/base")
    assert same(loaded, part)
    now = layout.store_by_key(part.where("p_size > 9"), f"{tmp_path}/now", ["p_partkey"], like=f"{tmp_path}/base/reference")
    gone = ledger.disagreements(loaded, now, ["p_partkey"], ["p_name"])
    assert "Exchange" not in plan_of(gone) and gone.count() == part.where("p_size <= 9").count()
    layout.append_by_key(part.limit(1), f"{tmp_path}/base/reference")
    with pytest.raises(ValueError, match="changed"):
        tables.load_baseline(spark, f"{tmp_path}/base")
