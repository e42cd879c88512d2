"""Feature steps: fitted state, unseen values, gaps, and equal results of both paths."""

import math
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from tallyhouse.functions.text import ENGLISH_STOP_WORDS, tokens, without_stop_words
from tallyhouse.operators import features
from tallyhouse.operators.ledger import multiset_difference


def test_codes_follow_sorted_order_on_both_paths(spark):
    df = spark.range(200).select("id", F.concat(F.lit("c"), F.col("id") % 37).alias("c"))
    plain = features.category_codes(df, "c")
    wide = features.category_codes(df, "c", max_lookup_rows=3)
    assert plain.fits and not wide.fits
    names = sorted({f"c{i}" for i in range(37)})
    assert {r["c"]: r["code"] for r in plain.table.collect()} == {n: i for i, n in enumerate(names)}
    assert multiset_difference(plain.table, wide.table.select("c", "code")).isEmpty()


@pytest.mark.parametrize("value", ["new", None])
def test_unseen_category_is_an_error(spark, value):
    codes = features.category_codes(spark.createDataFrame([("a",), ("b",)], "c string"), "c")
    df = spark.createDataFrame([(1, "b"), (2, value)], "id int, c string")
    coded = features.encode_ordinal(df, "c", codes, "code", ["id"])
    assert coded.where("id = 1").first()["code"] == 1
    with pytest.raises(Exception, match="Unknown category"):
        coded.collect()


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "g string")
    assert Counter(r["g"] for r in features.impute_mode(df, "g").collect()) == {"a": 3, "b": 2, "c": 1}
    other = spark.createDataFrame([(None,)], "g string")
    assert features.impute_mode(other, "g", fitted_on=df).first()["g"] == "a"


def test_one_hot_keeps_all_categories_and_refuses_others(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, g string")
    hot = features.encode_one_hot(df, "g", ["a", "b", "c"], "g_").orderBy("i")
    assert [tuple(r)[2:] for r in hot.collect()] == [(1.0, 0.0, 0.0), (0.0, 1.0, 0.0)]
    with pytest.raises(Exception, match="Unknown category"):
        features.encode_one_hot(df, "g", ["a"], "g_").collect()


def test_zero_for_null_and_nan(spark):
    df = spark.createDataFrame([(None, 1), (math.nan, None), (2.5, 3)], "x double, n int")
    got = [tuple(r) for r in features.impute_zero(df, ["x", "n"]).collect()]
    assert got == [(0.0, 1), (0.0, 0), (2.5, 3)]


def test_days_are_relative_to_the_batch_or_the_fit(spark):
    df = spark.createDataFrame([(1, "2019-07-08"), (2, "2019-07-01"), (3, None)], "i int, d string")
    df = df.withColumn("d", F.col("d").cast("date"))

    def days(part, **options):
        return [r["days"] for r in features.days_since_latest(part, "d", "days", **options)
                .orderBy("i").collect()]

    assert days(df) == [0, 7, 3475]
    assert days(df.where("i = 2")) == [0]
    assert days(df.where("i = 2"), reference_date="fitted", fitted_on=df) == [7]
    with pytest.raises(ValueError):
        features.days_since_latest(df, "d", "days", reference_date="fitted")


def test_latest_date_is_no_window_and_no_cross_join(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    df = features.days_since_latest(orders, "o_orderdate", "days")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "Subquery" in plan


def test_tokens_are_unicode_words_of_two_or_more(spark):
    text = "Été à l'hôtel: 2 BIG_rooms, x 10€ Привет\n日本 a"
    got = spark.range(1).select(tokens(F.lit(text)).alias("t")).first()["t"]
    assert got == ["été", "hôtel", "big_rooms", "10", "привет", "日本"]
    assert spark.range(1).select(tokens(F.lit(None).cast("string")).alias("t")).first()["t"] == []


def test_stop_words_are_sparks_own(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    words = F.array(*map(F.lit, ["the", "cozy", "and", "cozy"]))
    got = spark.range(1).select(without_stop_words(words).alias("t")).first()["t"]
    assert got == ["cozy", "cozy"]


TEXTS = ["Cozy room in the city", "cozy cozy loft", "the", None, "City loft view", "sunny room"]


@pytest.fixture(scope="module")
def titles(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


@pytest.mark.parametrize("bounds", [{}, {"max_lookup_rows": 1}])
def test_vocabulary_by_corpus_count_then_term(titles, bounds):
    fitted = features.fit_vocabulary(titles, "text", 3, **bounds)
    rows = {tuple(r) for r in fitted.terms.table.collect()}
    assert rows == {("cozy", 3, 2), ("city", 2, 2), ("loft", 2, 2)}
    assert fitted.documents == 6


def test_weights_equal_the_definition_on_both_paths(titles):
    idf = math.log(7 / 3) + 1
    expected = {}
    for i, text in enumerate(TEXTS):
        words = Counter(w for w in (text or "").lower().split() if w in {"cozy", "city", "loft"})
        norm = math.sqrt(sum((n * idf) ** 2 for n in words.values()))
        expected.update({(i, w): n * idf / norm for w, n in words.items()})
    for bound in (100_000, 1):
        fitted = features.fit_vocabulary(titles, "text", 3, max_lookup_rows=bound)
        got = features.tfidf(titles, "id", "text", fitted)
        got = {(r["id"], r["term"]): r["weight"] for r in got.collect()}
        assert got.keys() == expected.keys()
        assert all(math.isclose(got[k], v, rel_tol=1e-12) for k, v in expected.items())


@pytest.mark.parametrize("bound", [100_000, 1])
def test_rows_that_share_a_key_or_have_none_are_weighed_apart(spark, bound):
    rows = [(1, "cozy loft"), (1, "cozy cozy"), (None, "city loft"), (None, "cozy"), (2, "none of it"), (3, None)]
    df = spark.createDataFrame(rows, "id int, text string")
    fitted = features.fit_vocabulary(df, "text", 2, max_lookup_rows=bound)
    got = [tuple(r) for r in features.tfidf(df, "id", "text", fitted).collect()]
    assert len(got) == 5
    lone = [w for i, _, w in got if i is None]
    assert sorted(lone) == [1.0, 1.0]
    assert sorted(w for i, t, w in got if i == 1 and t == "cozy")[1] == 1.0


def test_stop_words_go_through_the_tokenizer(spark):
    text = "don't think we've isn't you'll cozy"
    words = without_stop_words(tokens(F.lit(text)))
    assert spark.range(1).select(words.alias("t")).first()["t"] == ["think", "cozy"]


def test_more_categories_than_a_thousand(spark):
    df = spark.range(1001).select(F.concat(F.lit("c"), "id").alias("g"))
    names = features.fit_categories(df.union(df), "g")
    assert len(names) == 1001 and names == sorted(names)
    row = features.encode_one_hot(df.limit(1), "g", names, "").first()
    assert sum(v for v in row[1:]) == 1.0


def test_categories_are_bounded(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    assert features.fit_categories(df, "c", most=2) == ["a", "b"]
    with pytest.raises(ValueError, match="more than 1"):
        features.fit_categories(df, "c", most=1)
