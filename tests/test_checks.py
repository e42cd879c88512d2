"""Checks: a null is a violation, borders belong to the range, reports outlive failures."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import checks
from tallyhouse.schemas import KNOWN_GROUPS, LATITUDE_BOX, LISTING, LONGITUDE_BOX

BOX = {"longitude": LONGITUDE_BOX, "latitude": LATITUDE_BOX}


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_schema_check_sees_order_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, 2)], "a int, c int, b int")
    got = rows_of(checks.check_schema(df, ["a", "b"]))
    assert got == [(1, "a", "a", True, 1), (2, "b", "c", False, 0), (3, None, "b", False, 1)]


@pytest.mark.parametrize(
    "values, unknown, found, passed",
    [
        (["a", "b", "a"], 0, 2, True),
        (["a", "b", None], 1, 2, False),
        (["a", "b", "x"], 1, 2, False),
        (["a"], 0, 1, False),
        ([], 0, 0, False),
    ],
)
def test_domain_check_goes_both_ways(spark, values, unknown, found, passed):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert rows_of(checks.check_domain(df, "v", ["a", "b"])) == [(unknown, found, 2, passed)]


def test_null_coordinates_violate_the_box(spark):
    points = [(-74.25, 40.5), (-73.5, 41.2), (None, 41.0), (-74.0, None), (0.0, 41.0)]
    df = spark.createDataFrame(points, "longitude double, latitude double")
    assert rows_of(checks.check_bounds(df, BOX)) == [(3, False)]


def test_row_count_bounds_are_inclusive(spark):
    df = spark.range(10)
    for low, high, passed in ((10, 20, True), (1, 10, True), (11, 20, False), (1, 9, False)):
        assert rows_of(checks.check_row_count(df, low, high)) == [(10, passed)]


def counts(spark, table):
    rows = [(k,) for k, n in table.items() for _ in range(n)]
    return spark.createDataFrame(rows, "g string")


def test_divergence_equals_the_definition(spark):
    now, then = {"a": 5, "b": 3, "c": 2}, {"a": 2, "b": 2, "c": 4}
    expected = sum(
        now[k] / 10 * math.log2((now[k] / 10) / (then[k] / 8)) for k in now
    )
    kl, n, passed = rows_of(checks.drift_kl(counts(spark, now), counts(spark, then), "g"))[0]
    assert math.isclose(kl, expected, rel_tol=1e-12) and n == 3 and not passed
    assert rows_of(checks.drift_kl(counts(spark, now), counts(spark, now), "g")) == [(0.0, 3, True)]


def test_divergence_with_one_sided_categories(spark):
    both, more = {"a": 5, "b": 5}, {"a": 5, "b": 5, "c": 10}
    kl, _, _ = rows_of(checks.drift_kl(counts(spark, both), counts(spark, more), "g"))[0]
    assert math.isclose(kl, 1.0)
    kl, _, passed = rows_of(checks.drift_kl(counts(spark, more), counts(spark, both), "g"))[0]
    assert kl == math.inf and not passed


def test_divergence_ignores_nulls_and_fails_on_nothing(spark):
    some = counts(spark, {"a": 1, "b": 1})
    gaps = some.unionByName(spark.createDataFrame([(None,)], "g string"))
    assert rows_of(checks.drift_kl(gaps, some, "g")) == [(0.0, 2, True)]
    assert rows_of(checks.drift_kl(some.limit(0), some, "g")) == [(None, 2, False)]


def test_divergence_limit_is_strict(spark):
    now, then = counts(spark, {"a": 1}), counts(spark, {"a": 1, "b": 1})
    assert rows_of(checks.drift_kl(now, then, "g", 1.0)) == [(1.0, 2, False)]


def listing_rows(spark, n, **changed):
    group = F.element_at(F.array(*map(F.lit, KNOWN_GROUPS)), (F.col("id") % 5 + 1).cast("int"))
    values = {
        "neighbourhood_group": group,
        "longitude": F.lit(-74.0),
        "latitude": F.lit(41.0),
        "price": F.lit(100.0),
        **{name: F.expr(text) for name, text in changed.items()},
    }
    df = spark.range(n)
    return df.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LISTING]
    )


def suite_limits(**changed):
    values = {
        "columns": LISTING.names,
        "category": "neighbourhood_group",
        "known": KNOWN_GROUPS,
        "box": BOX,
        "price": "price",
        "price_bounds": (10.0, 350.0),
        "row_bounds": (50, 1000),
        **changed,
    }
    return checks.SuiteLimits(**values)


def test_suite_passes_sound_listings(spark):
    report = checks.check_suite(listing_rows(spark, 100), listing_rows(spark, 50), suite_limits())
    assert [(r["check"], r["passed"]) for r in report.collect()] == [
        (c, True)
        for c in ("column_names", "known_categories", "inside_box", "similar_shares", "row_count",
                  "price_range")
    ]


@pytest.mark.parametrize(
    "check, changed, limits",
    [
        ("known_categories", {"neighbourhood_group": "'Bronx'"}, {"kl_limit": 100.0}),
        ("inside_box", {"latitude": "if(id > 0, 41.0, null)"}, {}),
        ("row_count", {}, {"row_bounds": (101, 102)}),
        ("price_range", {"price": "if(id > 0, 100.0, null)"}, {}),
        ("column_names", {}, {"columns": LISTING.names[::-1]}),
        ("similar_shares", {}, {"kl_limit": 0.0}),
    ],
)
def test_suite_finds_each_problem_alone(spark, check, changed, limits):
    report = checks.check_suite(
        listing_rows(spark, 100, **changed), listing_rows(spark, 50), suite_limits(**limits)
    )
    assert [r["check"] for r in report.collect() if not r["passed"]] == [check]


def test_suite_of_an_empty_table_fails_quietly(spark):
    full = listing_rows(spark, 50)
    report = checks.check_suite(full.limit(0), full, suite_limits())
    failed = {r["check"] for r in report.collect() if not r["passed"]}
    assert failed == {"known_categories", "similar_shares", "row_count"}


@pytest.mark.parametrize(
    "changed",
    [
        {"kl_limit": -0.1},
        {"kl_limit": math.nan},
        {"price_bounds": (5.0, 5.0)},
        {"price_bounds": (5.0, math.inf)},
    ],
)
def test_bad_limits_are_refused(changed):
    with pytest.raises(ValueError):
        suite_limits(**changed)


def test_a_table_is_not_its_own_baseline(spark):
    df = listing_rows(spark, 50)
    with pytest.raises(ValueError):
        checks.check_suite(df, df, suite_limits())


def test_report_is_kept_when_a_check_fails(spark, tmp_path):
    current = listing_rows(spark, 100, price="1.0")
    report = checks.check_suite(current, listing_rows(spark, 50), suite_limits())
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    with pytest.raises(ValueError, match="price_range"):
        checks.enforce(report, path)
    kept = spark.read.json(path).where("check = 'price_range'").first()
    assert kept["observed"] == 100 and not kept["passed"]
    sound = checks.check_suite(listing_rows(spark, 99), listing_rows(spark, 50), suite_limits())
    assert checks.enforce(sound, path + "-sound").count() == 6


def test_value_counts_skip_missing(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "g string")
    assert rows_of(checks.value_counts(df, "g")) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("distinct", ["approx", "exact"])
def test_profile(spark, distinct):
    df = spark.createDataFrame([(1.0, "x"), (3.0, None), (3.0, "y")], "n double, t string")
    got = {r["column"]: r for r in checks.profile_columns(df, ["n", "t"], distinct).collect()}
    assert (got["n"]["n_rows"], got["n"]["missing"], got["n"]["distinct_values"]) == (3, 0, 2)
    assert (got["t"]["missing"], got["t"]["lowest"], got["t"]["mean"]) == (1, "x", None)
    assert math.isclose(got["n"]["mean"], 7 / 3)


def test_histogram_bins_start_at_low(spark):
    df = spark.createDataFrame([(0.0,), (9.99,), (10.0,), (None,), (-0.1,)], "v double")
    got = sorted(rows_of(checks.histogram(df, "v", 0.0, 10.0)))
    assert got == [(-1, 1, -10.0), (0, 2, 0.0), (1, 1, 10.0)]


def test_quantiles_are_exact(spark):
    values = [-5.25, 0.0, 0.0, 1.5, 2.0, 1000.01, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["fraction"]: r["value"] for r in checks.quantiles(df, "v", [0, 0.5, 0.51, 1]).collect()}
    assert got == {0.0: -5.25, 0.5: 0.0, 0.51: 1.5, 1.0: 1000.01}
    same = spark.createDataFrame([(3.0,)] * 5, "v double")
    assert rows_of(checks.quantiles(same, "v", [0.5])) == [(0.5, 3.0)]
    assert rows_of(checks.quantiles(same.limit(0), "v", [0.5])) == []


def test_quantiles_are_not_rounded_and_do_not_overflow(spark, monkeypatch):
    small = spark.createDataFrame([(0.001,), (0.002,), (0.004,), (math.nan,)], "v double")
    assert rows_of(checks.quantiles(small, "v", [0.5, 1])) == [(0.5, 0.002), (1.0, 0.004)]
    wide = spark.createDataFrame([(-1e300,), (1e18,), (5e-324,)], "v double")
    assert rows_of(checks.quantiles(wide, "v", [0, 0.5, 1])) == [(0.0, -1e300), (0.5, 5e-324), (1.0, 1e18)]
    monkeypatch.setattr(checks, "SMALL_RANGE", 10)
    monkeypatch.setattr(checks, "ACCURACY", 50)
    many = spark.range(20_000).selectExpr("if(id % 3 = 0, 7.5, pow(id * 7919 % 20000, 1.5)) as v").cache()
    values = sorted(r[0] for r in many.collect())
    places = [0.0, 0.1, 0.33, 0.5, 0.777, 0.9999, 1.0]
    expected = [(f, values[max(1, math.ceil(f * len(values))) - 1]) for f in places]
    assert rows_of(checks.quantiles(many, "v", places)) == expected


@pytest.mark.parametrize("small_range", [10_000, 50])
def test_quantiles_from_stored_profiles(spark, monkeypatch, small_range):
    monkeypatch.setattr(checks, "SMALL_RANGE", small_range)
    rows = spark.range(30_000).selectExpr(
        "cast(id % 7 as int) as day", "if(id % 50 = 0, null, pow(id * 7919 % 30000, 1.3)) as v"
    ).cache()
    values = sorted(r[0] for r in rows.collect() if r[0] is not None and r[1] is not None for r in [(r[1],)])
    profiles = checks.profile_by(rows, "day", "v")
    assert profiles.count() == 7
    places = [0.0, 0.2, 0.5, 0.9, 1.0]
    expected = [(f, values[max(1, math.ceil(f * len(values))) - 1]) for f in places]
    assert rows_of(checks.quantiles(rows, "v", places, profiles)) == expected
    figures = checks.profile_figures(checks.merge_profiles(profiles), [0.5]).first()
    assert (figures["n"], figures["missing"]) == (30_000, 600)
    assert abs(figures["distinct_values"] / len(set(values)) - 1) < 0.05
    assert abs(figures["quantiles"][0] / values[len(values) // 2] - 1) < 0.02
    none = checks.profile_by(rows.limit(0), "day", "v")
    assert rows_of(checks.quantiles(rows.limit(0), "v", [0.5], none)) == []


def test_all_fractions_share_three_scans(spark, monkeypatch):
    seen = []
    real = checks._sketched
    monkeypatch.setattr(checks, "_sketched", lambda *a: seen.append(1) or real(*a))
    rows = spark.range(200_000).selectExpr("pow(id * 7919 % 200000, 1.1) as v")
    checks.quantiles(rows, "v", [0.1, 0.5, 0.9, 0.99]).collect()
    # The first scan's sketch was enough: one scan of counts and one of values followed.
    assert not seen


def test_two_reads_of_one_table_are_no_baseline(spark, small):
    path = f"{small}/customer.parquet"
    limits = checks.SuiteLimits([], "c_mktsegment", [], {}, "c_acctbal", (0.0, 1.0))
    with pytest.raises(ValueError, match="differ"):
        checks.check_suite(spark.read.parquet(path), spark.read.parquet(path), limits)
