import os

import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline as pipeline
from tallyhouse.llm import catalog, language_id, mixing, secret_scan, simhash_dedup
from tests.llm import cases
from tests.llm.test_simhash_dedup import brute_fingerprint, brute_groups


def by_stage(spark, docs, folder):
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(stage(spark, out[-1], folder).cache())
    return out


def test_registered():
    names = set(spark_entry.queries())
    assert names >= set(catalog.queries()) | {"pipeline"}
    assert {n.split("_")[0] for n in catalog.queries()} == {f"op{i}" for i in range(1, 14)}
    assert [name for name, _ in pipeline.STAGES] == [
        "language", "near-duplicates", "benchmark", "secrets", "mixing",
    ]
    assert spark_entry.oracle_sql().get("pipeline") == pipeline.ORACLE_SQL


def test_stages_on_given_documents(spark, small):
    docs = cases.given(spark, small)
    given, told, single, clean, safe, mixed = by_stage(spark, docs, small)
    for table in (told, single, clean, safe):
        assert table.columns == docs.columns and dict(table.dtypes) == dict(docs.dtypes)
    texts = {r.doc_id: r.text for r in told.collect()}
    kept = {r.doc_id for r in given.collect() if any(c.isalpha() for c in r.text or "")}
    assert set(texts) <= kept and len(texts) >= 0.98 * len(kept)
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    roots = brute_groups(prints.values())
    first = {}
    for i in sorted(prints, reverse=True):
        first[roots[prints[i]]] = i
    assert {r.doc_id for r in single.collect()} == set(first.values())
    items = [" ".join(r.text.split()) for r in cases.given(spark, small, "benchmark").collect()]
    clean_ids = {r.doc_id for r in clean.collect()}
    for r in single.collect():
        assert not (r.doc_id in clean_ids and any(t in " ".join(r.text.split()) for t in items))
    assert len(clean_ids) > 0.9 * single.count()
    assert {r.doc_id for r in safe.collect()} == clean_ids
    for r in safe.collect():
        assert secret_scan.find(r.text)[0] == []
        assert r.n_chars == len(r.text)
    sizes = mixing.sized(safe)
    largest = {"=" + r.source: r.n for r in sizes.groupBy("source").agg({"size": "max"}).toDF("source", "n").collect()}
    targets = {r.key: r.target for r in mixing.targets(sizes).collect()}
    taken = {}
    for r in mixed.collect():
        taken["=" + r.source] = taken.get("=" + r.source, 0) + len(r.text.encode().split())
    for key, target in targets.items():
        # Whole documents are taken, and some sources have but a few.
        assert abs(taken.get(key, 0) - target) <= 0.02 * target + largest[key] / 2
    assert pipeline.run(spark, small).count() == mixed.count()


@pytest.mark.parametrize("extra", [False, True])
def test_stages_on_odd_rows(spark, small, extra):
    docs = cases.documents(spark, extra=extra)
    tables = by_stage(spark, docs, small)
    for table in tables[1:5]:
        assert table.columns == docs.columns
        if extra:
            assert table.where("score <> 'kept' or words <> 'kept'").count() == 0
    assert tables[1].where("doc_id in (2, 3, 4, 11)").count() == 0
    assert tables[2].where("doc_id = 9").count() == 0
    assert tables[2].where("doc_id is null").count() == 2


def test_stages_on_empty_documents(spark, small):
    assert [t.count() for t in by_stage(spark, cases.empty(spark), small)] == [0] * 6


def test_repeated_rows_stay_once(spark, small):
    rows = [(1, "one text with letters", "en", "a")] * 3 + [(2, "quite another text here", "en", "a")]
    docs = cases.documents(spark, rows)
    kept = pipeline.drop_near_duplicates(spark, docs, small)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert language_id.UNDETERMINED and simhash_dedup.MAX_BITS == 4


def test_rows_without_ids_are_judged(spark, small):
    item = next(r.text for r in cases.given(spark, small, "benchmark").collect() if len(r.text.split()) > 20)
    other = "a text of its own about boats and rivers and roads that nobody else has ever written down"
    rows = [(None, "before " + item, "en", "a"), (None, other, "en", "a"), (5, item, "en", "a"), (5, other + " twice", "en", "a")]
    kept = pipeline.decontaminate(spark, cases.documents(spark, rows), small)
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, other), (5, other + " twice")]
    rows = [(None, other, "en", "a"), (None, other, "en", "b"), (8, other, "en", "a"), (7, other, "en", "a"), (None, item, "en", "a"), (7, item + " x", "en", "a")]
    kept = pipeline.drop_near_duplicates(spark, cases.documents(spark, rows), small)
    found = sorted((r.doc_id or 0, r.text) for r in kept.collect())
    assert (7, other) in found and len([t for _, t in found if t == other]) == 1
    assert {t for _, t in found} >= {other} and len(found) in (2, 3)


def test_stage_tables_do_not_pile_up(spark, small, tmp_path, monkeypatch):
    folders = []
    monkeypatch.setattr("tallyhouse.llm.scratch.new_folder", lambda _, name: folders.append(f"{tmp_path}/{name}") or folders[-1])
    pipeline.run(spark, small).count()
    stages = [f for f in folders if "stage-" in f]
    assert len(stages) == 4 and [os.path.exists(f) for f in stages] == [False] * 3 + [True]
