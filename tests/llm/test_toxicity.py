from pyspark.sql import functions as F

from tallyhouse.llm import toxicity as op
from tests.llm import cases


def held_out(spark, folder):
    """Held-out labelled documents with their scores, as the query gives them."""
    scored = op.op10_toxicity(spark, folder)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    docs = cases.given(spark, folder)
    assert scored.count() == docs.count()
    joined = scored.join(cases.given(spark, folder, "labels"), "doc_id").join(docs, "doc_id").toPandas()
    assert joined.score.between(0, 1).all()
    assert ((joined.score >= 0.5) == (joined.predicted == 1)).all()
    return joined[joined.held_out]


def test_held_out_labels_by_language(spark, large):
    held = held_out(spark, large)
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert len(toxic) > 50 and (toxic.predicted == 1).mean() >= 0.9
    assert (clean.predicted == 0).mean() >= 0.97
    for lang, rows in toxic.groupby("lang"):
        assert len(rows) < 5 or (rows.predicted == 1).mean() >= 0.8, lang


def test_features():
    named = dict(zip(op.FEATURES, op._features("You are an idiot!! ST0P it, 1d1ot stuuupid LOSER", {"ST0P": 1.0, "it": 4.0, "are": 3.0})))
    assert named["log insults"] > 1 and named["distinct insults"] == 2
    assert named["insults near address"] > 0 and named["disguised words"] > 0
    assert named["words in capitals"] > 0 and named["repeated marks"] > 0
    assert named["distinct learned"] == 2 and named["largest log-odds"] == 4 and named["summed log-odds"] == 7
    assert op._features("", {}) == [0.0] * len(op.FEATURES)
    assert len(op._features(cases.LONG, {})) == len(op.FEATURES)
    assert not {"die", "rat"} & op.INSULTS


def sampled(spark, rows, **options):
    docs = cases.documents(spark, [(i, t, "en", "a") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id bigint, label int")
    return op.sample_of(docs, labels, **options)


def test_lexicons_leave_their_fold_out(spark):
    rows = [(i, "grumbl word" if i % 2 else "nice word", i % 2) for i in range(400)]
    sample = sampled(spark, rows)
    folds = {r.key: r.fold for r in sample.collect()}
    alone = [i for i in folds if folds[i] == 2 and i % 2][:20]
    rows = [(i, "zorrt here", 1) if i in alone else (i, t, label) for i, t, label in rows]
    *without, whole = op.learn_lexicons(sampled(spark, rows))
    assert set(whole) == {"grumbl", "zorrt", "here"}
    assert "zorrt" not in without[2] and all("zorrt" in without[f] for f in (0, 1, 3))
    assert all("grumbl" in lexicon for lexicon in without)


def test_sample_of_odd_labels(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame(
        [(1, 0), (1, 1), (1, None), (3, None), (4, 7), (9, 0), (9, 0), (None, 1), (99, 1)], "doc_id bigint, label int"
    )
    found = sorted((r.key, r.label) for r in op.sample_of(docs, labels).collect())
    assert found == [(1, 1), (9, 0), (9, 0)]
    assert op.sample_of(docs.limit(0), labels).count() == 0
    many = [(i, "text", i % 2) for i in range(2_000)]
    assert 300 < sampled(spark, many, max_rows=400).count() < 500


def test_odd_rows_and_one_class(spark):
    featured = op.featurize(cases.documents(spark, extra=True))
    labelled = featured.select(F.col("doc_id").alias("key"), "features", F.lit(0).alias("label"))
    model = op.fit(labelled)
    assert model.trees is None
    rows = model.score(featured).collect()
    assert len(rows) == len(cases.TEXTS) and {r.predicted for r in rows} == {0}
    assert all(0 <= r.score <= 1 for r in rows)
    nothing = op.fit(labelled.limit(0))
    assert nothing.rate == 0.5 and nothing.score(featured.limit(0)).count() == 0
    assert op.fit(labelled.withColumn("label", F.lit(None).cast("int"))).trees is None
    assert op.learn_lexicons(sampled(spark, [(1, "x", 1)]).limit(0)) == ({},) * (op.FOLDS + 1)
