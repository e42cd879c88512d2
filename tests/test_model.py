"""Forests: reproducible, saved and loaded alike, scored by hand-checked metrics."""

import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tallyhouse.operators import model
from tallyhouse.schemas import KNOWN_GROUPS, LISTING

SMALL = {"numTrees": 5, "maxDepth": 4}


@pytest.fixture(scope="module")
def priced(spark):
    """Listings whose price depends on room type and nights, with gaps in every filled column."""
    i = F.col("id")
    rooms = F.array(*map(F.lit, ["Entire home/apt", "Private room", "Shared room"]))
    groups = F.array(*map(F.lit, KNOWN_GROUPS))
    values = {
        "id": i,
        "name": F.when(i % 9 != 0, F.concat_ws(" ", F.lit("cozy"), F.element_at(rooms, (i % 3 + 1).cast("int")))),
        "neighbourhood_group": F.when(i % 11 != 0, F.element_at(groups, (i % 5 + 1).cast("int"))),
        "room_type": F.element_at(rooms, (i % 3 + 1).cast("int")),
        "price": 50.0 + 60.0 * (2 - i % 3) + 2.0 * (i % 7),
        "minimum_nights": F.when(i % 13 != 0, i % 7),
        "number_of_reviews": i % 17,
        "last_review": F.when(i % 4 != 0, F.date_add(F.lit("2019-01-01").cast("date"), (i % 100).cast("int"))),
        "reviews_per_month": F.when(i % 4 != 0, (i % 10) / 10),
        "longitude": F.lit(-74.0) + (i % 20) / 100,
        "latitude": F.lit(40.6) + (i % 30) / 100,
    }
    df = spark.range(600)
    return df.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LISTING]
    ).cache()


def predictions(fitted, df):
    return {r["id"]: r["prediction"] for r in fitted.predict(df, ["id"]).collect()}


def close(a, b):
    return a.keys() == b.keys() and all(
        math.isclose(a[k], b[k], rel_tol=1e-10, abs_tol=1e-10) for k in a
    )


@pytest.fixture(scope="module")
def fitted(priced):
    return model.fit_forest(priced, 42, SMALL)


def test_the_layout_of_the_input_does_not_matter(priced, fitted):
    first = predictions(fitted, priced)
    for n in (1, 7):
        again = model.fit_forest(priced.repartition(n), 42, SMALL)
        assert first == predictions(again, priced)
    other = model.fit_forest(priced, 43, SMALL)
    assert not close(first, predictions(other, priced))


def test_saved_model_predicts_the_same(priced, fitted, tmp_path):
    fitted.save(f"{tmp_path}/model")
    loaded = model.load_model(f"{tmp_path}/model")
    assert close(predictions(fitted, priced), predictions(loaded, priced))
    assert set(loaded.named_steps) == {"preprocessor", "random_forest"}
    assert loaded.parameters == dict(fitted.parameters)
    assert list(loaded.spec.columns) == list(fitted.spec.columns)
    assert model.feature_importance(loaded) == model.feature_importance(fitted)
    with pytest.raises(Exception, match="already exists"):
        fitted.save(f"{tmp_path}/model")


def test_settings_of_the_session_do_not_change_a_forest(spark, priced):
    name, seen = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(name)
    try:
        for n in (4, 8):
            spark.conf.set(name, n)
            seen.append(predictions(model.fit_forest(priced, 42, SMALL), priced))
    finally:
        spark.conf.set(name, before)
    assert close(*seen)


def test_ordinal_codes_are_numbers_of_any_count(priced):
    many = priced.withColumn("room_type", F.format_string("room %02d", F.col("id") % 40))
    many = many.withColumn("price", F.col("id") % 40 * 10.0)
    fitted = model.fit_forest(many, 42, {**SMALL, "numTrees": 10})
    attributes = model.assemble(many, fitted.named_steps["preprocessor"]).schema["features"].metadata
    nominal = attributes["ml_attr"]["attrs"].get("nominal", [])
    assert not any(a["idx"] == 0 for a in nominal)
    assert dict(model.feature_importance(fitted))["room_type"] > 0.5


def test_model_is_better_than_the_mean(priced, fitted):
    scored = fitted.predict(priced, ["id", "price"])
    row = model.regression_metrics(scored, "price", "prediction").first()
    assert row["r2"] > 0.8
    for name in ("mae", "r2"):
        check = RegressionEvaluator(labelCol="price", metricName=name).evaluate(scored)
        assert math.isclose(row[name], check, rel_tol=1e-9)


def test_importance_is_summed_per_feature(priced, fitted):
    importance = dict(model.feature_importance(fitted))
    assert list(importance) == model.FeatureSpec().columns
    assert math.isclose(sum(importance.values()), 1.0, rel_tol=1e-9)
    assert max(importance, key=importance.get) in {"room_type", "name"}
    named = model.slots(fitted.named_steps["preprocessor"], fitted.spec)
    assert len(named) == fitted.named_steps["random_forest"].numFeatures
    assert [s for f, s in named if f == "neighbourhood_group"] == [
        f"neighbourhood_group={g}" for g in KNOWN_GROUPS
    ]


def test_grid_scores_all_settings_on_one_partition(priced):
    train, validation = priced.where("id % 4 > 0"), priced.where("id % 4 = 0")
    forests = {"flat": {"numTrees": 2, "maxDepth": 1}, "deep": SMALL}
    models, scores = model.fit_grid(train, validation, 42, forests)
    rows = {r["run_id"]: r for r in model.require_finite(scores).collect()}
    assert rows["deep"]["mae"] < rows["flat"]["mae"]
    alone = model.fit_forest(train, 42, SMALL)
    assert close(predictions(alone, validation), predictions(models["deep"], validation))
    assert models["flat"].parameters["maxDepth"] == 1
    assert models["flat"].parameters["minInstancesPerNode"] == 3


def test_forest_seed_must_be_that_of_the_split(priced):
    with pytest.raises(ValueError, match="seed"):
        model.fit_forest(priced, 42, {**SMALL, "seed": 1})


def test_unknown_settings_are_refused(priced):
    with pytest.raises(ValueError, match="Unknown"):
        model.fit_forest(priced, 42, {**SMALL, "maxBins": 5})


def test_default_forest():
    assert model.DEFAULT_FOREST == {
        "numTrees": 100, "maxDepth": 15, "minInstancesPerNode": 3, "minInstancesToSplit": 4,
        "impurity": "variance", "featureSubsetStrategy": "0.5", "bootstrap": True,
        "exactThresholds": False,
    }


def test_rows_are_scored_out_of_bag(priced, fitted):
    scored = fitted.out_of_bag(priced, ["id", "price"])
    assert scored.columns == ["id", "price", "prediction"] and scored.count() == priced.count()
    known = scored.where("prediction is not null")
    assert known.count() > 500
    inside = model.regression_metrics(fitted.predict(priced, ["price"]), "price", "prediction").first()
    outside = model.regression_metrics(known, "price", "prediction").first()
    assert 0.7 < outside["r2"] <= inside["r2"] + 0.02


def test_predictions_by_joins_agree(priced, fitted):
    joined = {r["id"]: r["prediction"] for r in fitted.predict(priced, ["id"], by_joins=True).collect()}
    assert close(predictions(fitted, priced), joined)


def test_permutation_importance_of_features(priced, fitted):
    found = {r["feature"]: r["increase"] for r in model.permutation_importance(fitted, priced, 5).collect()}
    assert set(found) == set(model.FeatureSpec().columns)
    assert found["room_type"] > 100 * max(abs(found["availability_365"]), 1e-9)
    assert found["calculated_host_listings_count"] == pytest.approx(0, abs=1e-9)


def test_fitted_reference_date_is_saved(priced, tmp_path):
    spec = model.FeatureSpec(reference_date="fitted")
    model.fit_forest(priced, 42, SMALL, spec).save(f"{tmp_path}/fitted")
    days = model.load_model(f"{tmp_path}/fitted").named_steps["preprocessor"].stages[6]
    one = days.transform(priced.where("id = 1")).first()
    assert one["_days"] == 98


def test_constant_label_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    scores = model.regression_metrics(df, "y", "p")
    assert tuple(scores.first()) == (0.5, None)
    with pytest.raises(ValueError):
        model.require_finite(scores)


@pytest.mark.parametrize(
    "mae, r2, bad",
    [(1.0, 0.5, False), (0.0, -3.0, False), (-0.1, 0.5, True), (math.nan, 0.5, True),
     (1.0, math.inf, True), (1.0, -math.inf, True), (None, 0.5, True)],
)
def test_metrics_must_be_finite(spark, mae, r2, bad):
    df = spark.createDataFrame([(mae, r2)], "mae double, r2 double")
    assert (not model.bad_metrics(df).isEmpty()) is bad
