"""Batches that arrive: together they come to what one batch does, also after a broken call."""

import json

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import ledger
from tallyhouse.streaming import stages


def drop_file(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in events))


def event(run, stage, status, at, event_id):
    return {"run_id": run, "stage": stage, "status": status, "at": at, "event_id": event_id}


BATCHES = [
    [
        event("r1", "a", "running", 10, 1),
        event("r1", "a", "completed", 30, 3),
        event("r1", "b", "running", 5, 4),
        event(None, "a", "running", 1, 5),
        event("r2", "a", "running", 7, None),
    ],
    [event("r1", "a", "running", 20, 2), event("r2", "a", "failed", 7, 6), event("r2", "a", "running", 7, 7)],
    [event("r1", "a", "running", 40, 8), event("r1", "b", "running", 1, 9), event("r2", "a", "failed", 6, 10)],
]


def judged(spark, target):
    rows = stages.invalid_transitions(spark, target).collect()
    return (
        sorted(tuple(r) for r in stages.status(spark, target).collect()),
        sorted((r["event_id"], r["reason"]) for r in rows),
        sorted(tuple(r) for r in stages.marks(spark, target).collect()),
    )


def test_batches_come_to_what_one_does(spark, tmp_path):
    one, many = tmp_path / "one", tmp_path / "many"
    drop_file(one, "all.json", [e for b in BATCHES for e in b])
    stages.follow(spark, str(one), f"{tmp_path}/t1")
    for i, batch in enumerate(BATCHES):
        drop_file(many, f"{i}.json", batch)
        stages.follow(spark, str(many), f"{tmp_path}/t2")
    # A call without new files changes nothing.
    stages.follow(spark, str(many), f"{tmp_path}/t2")
    first = judged(spark, f"{tmp_path}/t1")
    assert first == judged(spark, f"{tmp_path}/t2")
    assert first[0] == [("r1", "a", "running"), ("r1", "b", "running"), ("r2", "a", "running")]
    assert first[1] == [(2, "second start"), (4, "second start"), (6, "after end"), (7, "after end"), (8, "after end")]
    events = spark.createDataFrame(
        [e for b in BATCHES for e in b if e["run_id"] and e["event_id"]], stages.EVENTS
    )
    plain = ledger.invalid_transitions(events, stages.ORDER, ["event_id"])
    assert first[1] == sorted((r["event_id"], r["reason"]) for r in plain.collect())


def test_a_bad_line_fails_and_the_next_call_goes_on(spark, tmp_path):
    source, target = tmp_path / "s", f"{tmp_path}/t"
    drop_file(source, "0.json", BATCHES[0])
    stages.follow(spark, str(source), target)
    (source / "1.json").write_text('{"run_id": "r1", "stage": ')
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILED_READ"):
        stages.follow(spark, str(source), target)
    drop_file(source, "1.json", BATCHES[1])
    stages.follow(spark, str(source), target)
    rows = spark.read.schema(stages.EVENTS).parquet(f"{target}/events")
    assert sorted(r["event_id"] for r in rows.collect()) == [1, 2, 3, 4, 6, 7]
    kept = stages.marks(spark, target).where("run_id = 'r1' and stage = 'a'").first()
    assert (kept["n"], kept["end_at"], kept["last_at"]) == (3, 30, 30)


def test_marks_need_no_python_call_or_state_per_stage(spark, tmp_path):
    """Ten thousand stages in two batches: each batch adds its own marks, a task holds few events."""
    source, target = tmp_path / "s", f"{tmp_path}/t"
    for k in range(2):
        events = [event(f"r{i}", "a", None if i % 7 == 0 else "running", 10 - k, 2 * i + k) for i in range(10_000)]
        events += [event("r1", "a", "failed", 100 + k, 50_000 + k)]
        drop_file(source, f"{k}.json", events)
        stages.follow(spark, str(source), target)
    kept = stages.marks(spark, target)
    assert kept.count() == 10_000 and kept.agg(F.sum("n")).first()[0] == 20_002
    assert tuple(kept.where("run_id = 'r1'").first()) == ("r1", "a", 9, 3, 100, 50_000, 101, 50_001, "failed", 4)
    assert tuple(kept.where("run_id = 'r7'").first()) == ("r7", "a", 9, 15, None, None, 10, 14, None, 2)
    rows = spark.read.schema(stages.MARKS).parquet(f"{target}/marks")
    assert rows.count() == 20_000 and rows.agg(F.max("n")).first()[0] == 2
    assert not (tmp_path / "t" / "checkpoint-marks" / "state").exists()


def test_marks_given_out_in_parts_merge(spark, tmp_path, monkeypatch):
    drop_file(tmp_path / "s", "all.json", [e for b in BATCHES for e in b])
    whole, parts = f"{tmp_path}/t1", f"{tmp_path}/t2"
    stages.follow(spark, str(tmp_path / "s"), whole)
    monkeypatch.setattr(stages, "HELD_EVENTS", 1)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, "1")
    try:
        stages.follow(spark, str(tmp_path / "s"), parts)
    finally:
        spark.conf.set(rows, before)
    assert judged(spark, whole) == judged(spark, parts)
    assert spark.read.schema(stages.MARKS).parquet(f"{parts}/marks").count() > stages.marks(spark, parts).count()
