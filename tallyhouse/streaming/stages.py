"""Stage events followed as their files arrive.

A call takes in all files since the last one and ends. Offsets are kept in checkpoints, outputs in
file sinks, so a call that is broken off and repeated neither loses nor doubles an event. The state
of a stage is made of minima, a maximum and a count, which merge: each batch adds the marks of its
own events, dealt out by stage, and readers merge the marks of all batches, in whatever order they
came. So a batch costs what its events cost, and no state is held in memory between them.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import ledger

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EVENTS = "run_id string, stage string, status string, at bigint, event_id bigint"
ORDER = ("at", "event_id")
# What a stage's history comes to: its first event, its first end, its last event and status.
STATE = (
    "first_at bigint, first_id bigint, end_at bigint, end_id bigint, "
    "last_at bigint, last_id bigint, status string, n bigint"
)
MARKS = f"run_id string, stage string, {STATE}"
# Events that a task holds before it gives out their marks.
HELD_EVENTS = 1_000_000


def _taken_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= HELD_EVENTS:
            yield _marks_of(held)
            held, n = [], 0
    if n:
        yield _marks_of(held)


def _marks_of(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    events = pa.Table.from_batches(batches).select(["run_id", "stage", "status", "at", "event_id"])
    runs, stages, statuses = (events[c].to_pandas() for c in ("run_id", "stage", "status"))
    at, event = (events[c].to_numpy() for c in ORDER)
    stage_codes, stage_names = pd.factorize(stages)
    group = pd.factorize(runs)[0].astype("int64") * len(stage_names) + stage_codes
    status_codes, _ = pd.factorize(statuses, sort=True)
    order = np.lexsort((status_codes, event, at, group))
    sorted_group = group[order]
    starts = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]])
    stops = np.r_[starts[1:], len(order)]
    first, last = order[starts], order[stops - 1]
    # The place of the first end of a stage, or, without one, a place behind all.
    ended = statuses.isin((ledger.COMPLETED, ledger.FAILED)).to_numpy()[order]
    places = np.minimum.reduceat(np.where(ended, np.arange(len(order)), len(order)), starts)
    none = places == len(order)
    end = order[np.where(none, 0, places)]

    def texts(values, rows):
        return pa.array(values.to_numpy()[rows], pa.string(), from_pandas=True)

    columns = [
        texts(runs, first), texts(stages, first), pa.array(at[first]), pa.array(event[first]),
        pa.array(at[end], mask=none), pa.array(event[end], mask=none),
        pa.array(at[last]), pa.array(event[last]), texts(statuses, last), pa.array(stops - starts, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in MARKS.split(", ")])


def follow(spark: SparkSession, source: str, target: str) -> None:
    """Take in the event files that have come to ``source`` since the last call, and end.

    Events are JSON lines (``EVENTS``); those without run, stage or place are left out, and a line
    that is no JSON fails. Below ``target`` are kept ``events``, ``marks`` and the checkpoints. Each
    batch adds marks of the stages that it has events of.
    """
    arrived = (
        spark.readStream.schema(EVENTS)
        .option("mode", "FAILFAST")
        .json(source)
        .where("run_id is not null and stage is not null and at is not null and event_id is not null")
    )
    marks = arrived.repartition("run_id", "stage").mapInArrow(_taken_in, MARKS)
    started = [
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{target}/checkpoint-{name}")
        .trigger(availableNow=True)
        .start(f"{target}/{name}")
        for name, rows in (("events", arrived), ("marks", marks))
    ]
    for query in started:
        query.awaitTermination()


def marks(spark: SparkSession, target: str) -> DataFrame:
    """The present marks of every stage: those of all batches merged."""
    rows = spark.read.schema(MARKS).parquet(f"{target}/marks")
    end = F.when(F.col("end_at").isNotNull(), F.struct("end_at", "end_id"))
    merged = rows.groupBy("run_id", "stage").agg(
        F.min(F.struct("first_at", "first_id")).alias("f"),
        F.min(end).alias("e"),
        F.max(F.struct("last_at", "last_id", "status")).alias("l"),
        F.sum("n").alias("n"),
    )
    return merged.select("run_id", "stage", "f.*", "e.*", "l.*", "n")


def status(spark: SparkSession, target: str) -> DataFrame:
    """(run_id, stage, status) of all stages seen so far."""
    return marks(spark, target).select("run_id", "stage", "status")


def invalid_transitions(spark: SparkSession, target: str) -> DataFrame:
    """Events so far that their stage's history forbids, with the reason, by the kept marks."""
    kept = marks(spark, target)
    end = F.when(F.col("end_at").isNotNull(), F.struct(*[F.col(f"end_{c}") for c in ("at", "id")]))
    found = kept.select(
        "run_id", "stage", F.struct("first_at", "first_id").alias("_first"), end.alias("_end")
    )
    events = spark.read.schema(EVENTS).parquet(f"{target}/events")
    return ledger.invalid_transitions(events, ORDER, ["event_id"], marks=found)
