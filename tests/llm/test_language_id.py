import numpy as np
from pyspark.sql import functions as F

from tallyhouse.llm import language_id as op
from tests.llm import cases


def test_held_out_accuracy(spark, medium):
    docs = cases.given(spark, medium)
    scored = op.op6_language_id(spark, medium)
    assert scored.columns == ["doc_id", "held_out", "lang_pred", "score"]
    right = scored.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert scored.count() == docs.count()
    assert right.first()[0] > 0.97
    assert scored.where("score < 0 or score > 1").count() == 0


def test_odd_rows(spark):
    docs = cases.documents(spark, extra=True)
    model = op.fit_documents(docs)
    rows = op.identify(docs, model).collect()
    assert len(rows) == len(cases.TEXTS)
    by_id = {r.doc_id: r for r in rows}
    for i in (2, 3, 4, 11):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[10].lang_pred in model.languages
    assert by_id[5].words == "kept" and by_id[5].lang_pred == "en"
    assert set(model.languages) <= {"en", "de", "fr"}


def test_nothing_learned(spark):
    model = op.fit(cases.empty(spark))
    assert model.languages == ()
    rows = op.identify(cases.documents(spark), model).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    assert op.identify(cases.empty(spark), model).count() == 0


def test_ties_go_to_the_first_language():
    weights = np.zeros((2, op.BUCKETS + 1))
    model = op.LanguageModel(("aa", "bb"), np.log([0.5, 0.5]), weights)
    assert model.log_scores(["some text"]).argmax(axis=1).tolist() == [0]


def test_pieces_count_every_ngram_once(monkeypatch):
    text = "abc def\u00fc ghi " * 50
    whole = np.sort(np.concatenate([ids for _, _, ids in op._buckets([text])]))
    monkeypatch.setattr(op, "PIECE_CHARS", 37)
    cut = np.sort(np.concatenate([ids for _, _, ids in op._buckets([text])]))
    real = [x[x < op.BUCKETS].tolist() for x in (whole, cut)]
    assert real[0] == real[1]
