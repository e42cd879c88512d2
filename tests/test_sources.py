"""Reading, writing, and the fixed baseline."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.ledger import multiset_difference, report_gate
from tallyhouse.schemas import CHECKS, LISTING
from tallyhouse.sources import records, tables

SIMPLE = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.StringType())])


def write(path, text):
    path.write_text(text)
    return str(path)


def test_listing_csv_with_quotes_breaks_and_markers(spark, tmp_path):
    header = ",".join(LISTING.names)
    line = '7,"Cozy, ""big""\nroom",1,Ann,Bronx,NA,40.8,-73.9,Private room,100,1,,2019-07-08,nan,2,365'
    path = write(tmp_path / "l.csv", f"{header}\n{line}\n")
    (row,) = tables.read_csv(spark, path).collect()
    assert row["name"] == 'Cozy, "big"\nroom' and row["price"] == 100.0
    assert row["neighbourhood"] is None and row["number_of_reviews"] is None
    assert row["reviews_per_month"] is None
    assert row["last_review"] == datetime.date(2019, 7, 8)


def test_bad_number_fails_or_is_null(spark, tmp_path):
    path = write(tmp_path / "b.csv", "id,value\nseven,a\n8,b\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_csv(spark, path, SIMPLE).collect()
    kept = tables.read_csv(spark, path, SIMPLE, on_bad="null").collect()
    assert [tuple(r) for r in kept] == [(None, "a"), (8, "b")]


def test_wrong_header_is_refused(spark, tmp_path):
    path = write(tmp_path / "h.csv", "value,id\na,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, path, SIMPLE).collect()


def test_csv_roundtrip_and_no_overwrite(spark, tmp_path):
    rows = [(1, 'a "quoted", text'), (2, "two\nlines"), (3, None), (4, "back\\slash")]
    df = spark.createDataFrame(rows, SIMPLE)
    path = f"{tmp_path}/out"
    tables.write_csv(df, path)
    assert multiset_difference(tables.read_csv(spark, path, SIMPLE), df).isEmpty()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_csv(df, path)


def test_samples_are_copied_by_name_only(spark, small, tmp_path):
    catalog = {"part": f"{small}/part.parquet"}
    copy, identity = tables.ingest_sample(spark, "part", catalog, f"{tmp_path}/raw")
    row = identity.first()
    assert row["source_fingerprint"] == row["copy_fingerprint"]
    assert multiset_difference(copy, spark.read.parquet(catalog["part"])).isEmpty()
    with pytest.raises(FileNotFoundError):
        tables.ingest_sample(spark, "other", catalog, f"{tmp_path}/other")


def baseline(spark, tmp_path):
    df = spark.createDataFrame([(1, "example")], SIMPLE)
    return tables.create_baseline(df, "runs/1/clean", "run-1", f"{tmp_path}/reference")


def test_baseline_is_made_once(spark, tmp_path):
    meta = baseline(spark, tmp_path).first()
    assert (meta["source_run_id"], meta["n_rows"]) == ("run-1", 1)
    loaded = tables.load_baseline(spark, f"{tmp_path}/reference")
    assert [tuple(r) for r in loaded.collect()] == [(1, "example")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        baseline(spark, tmp_path)


def test_missing_baseline_is_refused(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.load_baseline(spark, f"{tmp_path}/nothing")


def test_changed_baseline_is_refused(spark, tmp_path):
    baseline(spark, tmp_path)
    other = spark.createDataFrame([(2, "other")], SIMPLE)
    other.write.mode("overwrite").parquet(f"{tmp_path}/reference/reference")
    with pytest.raises(ValueError, match="changed"):
        tables.load_baseline(spark, f"{tmp_path}/reference")


@pytest.mark.parametrize(
    "changed, message",
    [
        ({"schema_version": 2}, "Unsupported"),
        ({"reference_path": "/elsewhere"}, "another folder"),
        ({"source_fingerprint": "0"}, "recorded source"),
    ],
)
def test_wrong_metadata_is_refused(spark, tmp_path, changed, message):
    meta = baseline(spark, tmp_path).first().asDict()
    spark.createDataFrame([tuple({**meta, **changed}.values())], tables.BASELINE).write.mode(
        "overwrite"
    ).json(f"{tmp_path}/reference/metadata")
    with pytest.raises(ValueError, match=message):
        tables.load_baseline(spark, f"{tmp_path}/reference")


def test_manifests_by_glob(spark, tmp_path):
    for name, status in (("r1", "completed"), ("r2", "failed")):
        folder = tmp_path / "runs" / name
        folder.mkdir(parents=True)
        manifest = {
            "schema_version": 1, "run_id": name, "status": status,
            "config": {"main": {"steps": "all"}}, "code": {"commit": None, "dirty": None},
            "created_at": "2024-01-01T00:00:00+00:00",
            "stages": {
                "download": {
                    "status": status, "inputs": {}, "details": {"sample": "s"},
                    "outputs": {"raw": {"path": f"runs/{name}/raw.csv", "sha256": "ab"}},
                }
            },
        }
        (folder / "manifest.json").write_text(json.dumps(manifest, indent=2))
    found = records.read_manifests(spark, f"{tmp_path}/runs/*/manifest.json", multi_line=True)
    stages = records.stages_of(found)
    assert {(r["run_id"], r["stage"], r["status"]) for r in stages.collect()} == {
        ("r1", "download", "completed"), ("r2", "download", "failed"),
    }
    assert json.loads(found.where("run_id = 'r1'").first()["config"]) == {"main": {"steps": "all"}}
    outputs = records.artifacts_of(stages).where("run_id = 'r1'").first()
    assert (outputs["name"], outputs["path"]) == ("raw", "runs/r1/raw.csv")


def test_comparison_keeps_its_parameters(spark, tmp_path):
    rows = [("r1", "m", "s", "p", '{"depth":3,"note":"a, \\"b\\""}', 1.5, 0.25)]
    df = spark.createDataFrame(
        rows, "run_id string, model_path string, split_id string, split_path string, "
        "parameters string, mae double, r2 double"
    )
    records.write_comparison(df, f"{tmp_path}/c")
    assert records.read_comparison(spark, f"{tmp_path}/c").first() == df.first()
    parsed = records.read_comparison(spark, f"{tmp_path}/c", "depth int, note string").first()
    assert parsed["parameters"].asDict() == {"depth": 3, "note": 'a, "b"'}


def report(tmp_path, children):
    cases = "".join(f'<testcase name="{n}" classname="r">{children.get(n, "")}</testcase>' for n in CHECKS)
    path = tmp_path / "report.xml"
    path.write_text(f'<?xml version="1.0"?><testsuites><testsuite>{cases}</testsuite></testsuites>')
    return str(path)


@pytest.mark.parametrize(
    "children, expected, accepted",
    [
        ({}, [], True),
        ({"test_proper_boundaries": '<failure message="x">trace</failure>'}, [], False),
        ({"test_proper_boundaries": '<failure message="x"/>'}, ["test_proper_boundaries"], True),
        ({"test_row_count": '<error message="x"/>'}, ["test_proper_boundaries"], False),
        ({"test_row_count": '<skipped message="x"/>'}, [], False),
        ({}, ["test_proper_boundaries"], False),
    ],
)
def test_reports_from_xml(spark, tmp_path, children, expected, accepted):
    cases = records.read_report(spark, report(tmp_path, children))
    assert cases.count() == 6
    assert report_gate(cases, ["report"], expected).first()["accepted"] is accepted


def test_incomplete_or_repeated_cases_are_refused(spark):
    cases = spark.createDataFrame(
        [(f"r{k}", n) for k in range(3) for n in CHECKS], "report string, name string"
    ).select("report", "name", F.lit(False).alias("failed"), F.lit(False).alias("skipped"))
    without = cases.where("report <> 'r1' or name <> 'test_row_count'")
    twice = without.unionByName(cases.where("report = 'r2' and name = 'test_row_count'"))
    got = {r["report"]: r["accepted"] for r in report_gate(twice, ["report"]).collect()}
    assert got == {"r0": True, "r1": False, "r2": False}


def test_edges_of_nested_records(spark):
    rows = [
        ("a", '{"x": {"path": "p1", "sha256": "s1"}, "list": [[{"deep": {"path": "p2", "sha256": "s2", "k": []}}]]}'),
        ("b", '{"path": "p3", "sha256": "s3", "more": {"path": "no digest"}, "odd": {"sha256": "s"}}'),
        ("c", '"text"'),
        ("d", "[]"),
        ("e", None),
        ("f", '{"path": 7, "sha256": true}'),
        ("g", '{"path": [1], "sha256": "s"}'),
    ]
    df = spark.createDataFrame(rows, "id string, record string")
    got = sorted(tuple(r) for r in records.edges_of(df, "id", "record").collect())
    assert got == [("a", "p1", "s1"), ("a", "p2", "s2"), ("b", "p3", "s3"), ("f", "7", "true")]
    for text in ("{", '{"a": NaN}'):
        with pytest.raises(Exception, match="JSON|Expecting"):
            records.edges_of(spark.createDataFrame([("a", text)], "id string, record string"), "id", "record").collect()
    none = records.edges_of(df.limit(0), "id", "record")
    assert none.columns == ["src", "dst", "sha256"] and none.count() == 0


def test_manifest_problems(spark):
    rows = [(1, "r1", "r1"), (2, "r2", "r2"), (1, "r3", "other"), (None, None, "r4")]
    df = spark.createDataFrame(rows, "schema_version int, run_id string, folder string")
    got = {r["folder"]: r["problems"] for r in records.manifest_problems(df).collect()}
    assert got == {"r2": ["version"], "other": ["run"], "r4": ["version", "run"]}


def test_csv_keeps_blanks_at_both_ends(spark, tmp_path):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("t", T.StringType())])
    df = spark.createDataFrame([(1, " lead"), (2, "trail \t"), (3, "  ")], schema)
    tables.write_csv(df, f"{tmp_path}/t")
    back = tables.read_csv(spark, f"{tmp_path}/t", schema)
    assert sorted(map(tuple, back.collect())) == [(1, " lead"), (2, "trail \t"), (3, "  ")]


def test_baseline_needs_a_completed_cleaning(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    outputs = spark.createDataFrame(
        [("r1", "basic_cleaning", "completed", "here"), ("r2", "basic_cleaning", "failed", "here")],
        "run_id string, stage string, stage_status string, path string",
    )
    with pytest.raises(ValueError, match="completed cleaning"):
        tables.create_baseline(df, "here", "r2", f"{tmp_path}/no", outputs)
    tables.create_baseline(df, "here", "r1", f"{tmp_path}/yes", outputs)
    assert tables.load_baseline(spark, f"{tmp_path}/yes").count() == 1
