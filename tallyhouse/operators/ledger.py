"""Run records as tables: ranking, set checks, reconciliation, stage rules, lineage
(T1-T3, U1-U2, J1-J6, L1-L6).

Shapes used below, all produced by ``sources.records``:

- stages: run_id, stage, status, inputs, outputs, details
- outputs / inputs: run_id, stage, name, path, sha256
"""

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.plans.lookups import (
    BROADCAST_ROWS,
    derived_lookup,
    hot_keys,
    join_lookup,
    stored_lookup,
)
from tallyhouse.plans.shared import checkpointed, written
from tallyhouse.schemas import CHECKS, TRAINING_STAGES

RUNNING, COMPLETED, FAILED = "running", "completed", "failed"
TRAINING_RECORDS = ("parameters", "split_id", "trainval_sha256")


def _same(pairs: Mapping[str, str]) -> Column:
    """Null-safe equality of all column pairs."""
    condition = F.lit(True)
    for left, right in pairs.items():
        condition = condition & F.col(left).eqNullSafe(F.col(right))
    return condition


# --- ranking and selection (T1-T3) ----------------------------------------------------


def _usable(error: str) -> Column:
    """An error that is there, finite and not negative."""
    c = F.col(error)
    return F.coalesce(~F.isnan(c) & (c >= 0) & (c < float("inf")), F.lit(False))


def rank_candidates(df: DataFrame, error: str = "mae", run: str = "run_id") -> DataFrame:
    """Sorted by error, then run, with the best one marked.

    Runs whose error is missing, not finite or negative come last and are never the best.
    The best is a scalar subquery over partial minima; the sort is a distributed range sort.
    """
    usable, place = _usable(error), F.struct(error, run)
    best = df.agg(F.min(F.when(usable, place))).scalar()
    return df.withColumn("is_best", F.coalesce(usable & (place == best), F.lit(False))).orderBy(
        ~usable, F.asc_nulls_last(error), run
    )


def select_best(df: DataFrame, error: str = "mae", run: str = "run_id") -> DataFrame:
    """The run with the lowest usable error; none if no run has one."""
    return df.where(_usable(error)).orderBy(error, run).limit(1)


def comparable_runs(
    df: DataFrame,
    by: Sequence[str],
    settings: Sequence[str],
    configuration: str = "parameters",
    run: str = "run_id",
    least: int = 3,
) -> DataFrame:
    """Per comparison: distinct runs, settings, configurations, and whether it is allowed.

    Needs at least ``least`` runs, none repeated, one shared setting, and ``least`` different
    configurations. Equal rows are added up first, so that only different ones are multiplied
    by the distinct counts.
    """
    # JSON keeps nulls inside a setting visible; a bare distinct count skips such rows.
    setting = F.to_json(F.struct(*settings), {"ignoreNullFields": "false"})
    different = df.groupBy(
        *by, F.col(run).alias("_run"), setting.alias("_setting"), F.col(configuration).alias("_configuration")
    ).agg(F.count(F.lit(1)).alias("_n"))
    return (
        different.groupBy(*by)
        .agg(
            F.sum("_n").alias("n_rows"),
            F.count_distinct("_run").alias("n_runs"),
            F.count_distinct("_setting").alias("n_settings"),
            F.count_distinct("_configuration").alias("n_configurations"),
        )
        .withColumn(
            "comparable",
            (F.col("n_runs") >= least)
            & (F.col("n_runs") == F.col("n_rows"))
            & (F.col("n_settings") == 1)
            & (F.col("n_configurations") >= least),
        )
    )


def eligible_candidates(
    runs: DataFrame,
    stages: DataFrame,
    metrics: DataFrame,
    stage: str = "train_random_forest",
    outputs: Sequence[str] = ("model", "parameters", "metrics", "feature_importance"),
) -> DataFrame:
    """Runs that are completed, whose training is completed with all outputs, whose files say
    what the run record says, and whose metrics are finite.

    ``runs`` has run_id and status; ``stages`` has run_id, stage, status, output_names and the
    recorded mae and r2; ``metrics`` has run_id, mae and r2 as read from the files. Of
    parameters, split_id and trainval_sha256, those that both have are compared as well.
    """
    compared = ["mae", "r2"] + [
        c for c in TRAINING_RECORDS if c in stages.columns and c in metrics.columns
    ]
    trained = stages.where(
        (F.col("stage") == stage)
        & (F.col("status") == COMPLETED)
        & (F.size(F.array_except(F.array(*map(F.lit, outputs)), "output_names")) == 0)
    ).select("run_id", *compared)
    stored = metrics.select("run_id", *[F.col(c).alias(f"file_{c}") for c in compared])
    r2 = F.col("r2")
    return (
        runs.where(F.col("status") == COMPLETED)
        .join(trained, "run_id")
        .join(stored, "run_id")
        .where(_same({c: f"file_{c}" for c in compared}))
        .where(_usable("mae") & ~F.isnan(r2) & (F.abs(r2) < float("inf")))
        .select("run_id", "mae", "r2")
    )


# --- set checks (U1, U2) --------------------------------------------------------------


def common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in both tables, once each: empty if they are disjoint."""
    return left.intersect(right)


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the surplus of ``left`` (negative: missing).

    One aggregation instead of a difference in each direction; copies are added up before
    the shuffle.
    """
    columns = left.columns
    if columns != right.columns:
        raise ValueError("Both tables must have the same columns in the same order")
    one = F.lit(1).cast("bigint")
    return (
        left.withColumn("_side", one)
        .unionByName(right.withColumn("_side", -one))
        .groupBy(*columns)
        .agg(F.sum("_side").alias("surplus"))
        .where("surplus <> 0")
    )


# --- reconciliation (J1-J6) -----------------------------------------------------------


def verify_digests(
    recorded: DataFrame, actual: DataFrame, key: Sequence[str], digest: str = "sha256"
) -> DataFrame:
    """Status of every recorded artifact: ok, changed or missing. Keys are unique on each side."""
    key = list(key)
    found = actual.select(*key, F.col(digest).alias("_now"), F.lit(True).alias("_found"))
    return recorded.join(found, key, "left").select(
        *key,
        F.when(F.col("_found").isNull(), "missing")
        .when(F.col(digest).eqNullSafe(F.col("_now")), "ok")
        .otherwise("changed")
        .alias("status"),
    )


def disagreements(
    left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Rows of ``left`` that have no partner in ``right`` or differ from it in any column.

    Result: the key and the list of differing columns; a missing partner is ``<missing>``.
    ``key`` is unique in both tables.
    """
    key = list(key)
    other = right.select(
        *key, *[F.col(c).alias(f"_other_{c}") for c in columns], F.lit(True).alias("_found")
    )
    differing = F.array_compact(
        F.array(
            *[
                F.when(~F.col(c).eqNullSafe(F.col(f"_other_{c}")), F.lit(c))
                for c in columns
            ]
        )
    )
    return (
        left.join(other, key, "left")
        .select(
            *key,
            F.when(F.col("_found").isNull(), F.array(F.lit("<missing>")))
            .otherwise(differing)
            .alias("differing"),
        )
        .where(F.size("differing") > 0)
    )


def reconcile_comparison(comparison: DataFrame, evidence: DataFrame) -> DataFrame:
    """Comparison rows that disagree with the training evidence of their run."""
    columns = ["model_path", "split_id", "split_path", "parameters", "mae", "r2"]
    return disagreements(comparison, evidence, ["run_id"], columns)


def reconcile_evaluation(evaluations: DataFrame, selections: DataFrame) -> DataFrame:
    """Every completed evaluation with a verdict against the selected model it names.

    Verdicts: accepted, unselected (its model was not selected), mismatch (another split,
    test set or model path; also another test path or selection digest where both tables have
    ``test_path`` or ``selection_sha256``), bad metrics. A selection that no completed
    evaluation names is a row without ``run_id`` and ``missing``. Evaluations with a
    ``status`` other than completed do not count.
    """
    compared = ["split_id", "test_sha256", "model_path"] + [
        c for c in ("test_path", "selection_sha256") if c in selections.columns and c in evaluations.columns
    ]
    if "status" in evaluations.columns:
        evaluations = evaluations.where(F.col("status") == COMPLETED)
    chosen = derived_lookup(
        selections.select(
            F.col("run_id").alias("model_run_id"),
            *[F.col(c).alias(f"_{c}") for c in compared],
            F.lit(True).alias("_found"),
        )
    )
    joined = join_lookup(evaluations, chosen, ["model_run_id"], "left", spread_by=["run_id"])
    same = _same({c: f"_{c}" for c in compared})
    named = evaluations.select("model_run_id").distinct()
    unnamed = chosen.table.select("model_run_id").join(named, "model_run_id", "left_anti")
    missing = unnamed.select(
        F.lit(None).cast(evaluations.schema["run_id"].dataType).alias("run_id"),
        "model_run_id",
        F.lit("missing").alias("verdict"),
    )
    finite = F.lit(True)
    for name in ("mae", "r2"):
        c = F.col(name)
        finite = finite & c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return joined.select(
        "run_id",
        "model_run_id",
        F.when(F.col("_found").isNull(), "unselected")
        .when(~same, "mismatch")
        .when(~(finite & (F.col("mae") >= 0)), "bad metrics")
        .otherwise("accepted")
        .alias("verdict"),
    ).unionByName(missing)


def reconcile_split(
    splits: DataFrame,
    outputs: DataFrame,
    trainings: DataFrame,
    configured: Column,
    identity: Column | None = None,
) -> DataFrame:
    """Problems of each split, none for a sound one.

    ``splits``: split_id, run_id (its producer), source_run_id, source_sha256, trainval_sha256,
    test_sha256, test_size, random_seed, stratify_by. ``outputs``: completed outputs of all
    runs as run_id, stage, name, sha256. ``trainings``: split_id, trainval_sha256, one row per
    training. ``configured``: a struct of test_size, random_seed and stratify_by to compare
    with. ``identity``: the split id as it follows from source and parameters.
    """
    made = F.col("stage") == "data_split"
    produced = (
        outputs.where(made & F.col("name").isin("trainval", "test"))
        .groupBy("run_id")
        .agg(
            F.max(F.when(F.col("name") == "trainval", F.col("sha256"))).alias("_produced"),
            F.max(F.when(F.col("name") == "test", F.col("sha256"))).alias("_tested"),
        )
    )
    cleaned = outputs.where((F.col("stage") == "basic_cleaning") & (F.col("name") == "clean"))
    used = trainings.groupBy("split_id").agg(
        F.min("trainval_sha256").alias("_used_low"), F.max("trainval_sha256").alias("_used_high")
    )
    joined = (
        splits.join(produced, "run_id", "left")
        .transform(
            lambda df: join_lookup(
                df,
                stored_lookup(
                    cleaned.select(
                        F.col("run_id").alias("source_run_id"), F.col("sha256").alias("_cleaned")
                    )
                ),
                ["source_run_id"],
                "left",
                spread_by=["split_id"],
            )
        )
        .join(used, "split_id", "left")
    )
    parameters = F.struct("test_size", "random_seed", "stratify_by")
    return joined.select(
        "split_id",
        F.array_compact(
            F.array(
                F.when(~F.col("_produced").eqNullSafe(F.col("trainval_sha256")), "producer"),
                F.when(~F.col("_tested").eqNullSafe(F.col("test_sha256")), "test"),
                F.when(~F.col("_cleaned").eqNullSafe(F.col("source_sha256")), "source"),
                F.when(
                    F.col("_used_low").isNotNull()
                    & (
                        (F.col("_used_low") != F.col("trainval_sha256"))
                        | (F.col("_used_high") != F.col("trainval_sha256"))
                    ),
                    "training",
                ),
                F.when(~parameters.eqNullSafe(configured), "parameters"),
                F.lit(None).cast("string")
                if identity is None
                else F.when(~identity.eqNullSafe(F.col("split_id")), "identity"),
            )
        ).alias("problems"),
    )


def mark_validated(
    datasets: DataFrame,
    checks: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    max_lookup_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All datasets, with ``validated``: whether ``validated_only`` keeps them."""
    passed = checks.where(F.col("status") == COMPLETED).select(*on).distinct()
    lookup = derived_lookup(passed.withColumn("_passed", F.lit(True)), max_lookup_rows)
    joined = join_lookup(datasets, lookup, on, "left", spread_by)
    return joined.withColumn("validated", F.coalesce("_passed", F.lit(False))).drop("_passed")


def validated_only(
    datasets: DataFrame,
    checks: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    refused: bool = False,
    max_lookup_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Datasets with a completed check on the same data and baseline, or the refused ones.

    ``checks`` may hold many rows for one digest; they are reduced first, and a digest shared
    by very many datasets is spread over tasks.
    """
    passed = checks.where(F.col("status") == COMPLETED).select(*on).distinct()
    lookup = derived_lookup(passed, max_lookup_rows)
    return join_lookup(datasets, lookup, on, "left_anti" if refused else "left_semi", spread_by)


# --- stage rules (L1-L3) --------------------------------------------------------------


def latest_status(events: DataFrame, order: Sequence[str]) -> DataFrame:
    """Current status of each (run_id, stage) from its event history, by partial maxima."""
    return events.groupBy("run_id", "stage").agg(
        F.max_by("status", F.struct(*order)).alias("status")
    )


def run_status(runs: DataFrame, stages: DataFrame) -> DataFrame:
    """Failed if any stage failed, completed if all did, else running; also without stages."""
    per_run = stages.groupBy("run_id").agg(
        F.bool_or(F.col("status") == FAILED).alias("_any_failed"),
        F.bool_and(F.col("status") == COMPLETED).alias("_all_completed"),
        F.count(F.lit(1)).alias("n_stages"),
    )
    return runs.join(per_run, "run_id", "left").select(
        *runs.columns,
        F.coalesce("n_stages", F.lit(0)).cast("bigint").alias("n_stages"),
        F.when(F.col("_any_failed"), FAILED)
        .when(F.col("_all_completed"), COMPLETED)
        .otherwise(RUNNING)
        .alias("status"),
    )


def invalid_transitions(
    events: DataFrame,
    order: Sequence[str],
    spread_by: Sequence[str],
    max_lookup_rows: int = BROADCAST_ROWS,
    marks: DataFrame | None = None,
) -> DataFrame:
    """Events that a stage's history forbids: a second start, or anything after its end.

    A stage may be at its end from its first completed or failed event on; before that all
    its events are starts, and only the first is valid. So two minima per stage decide, and
    a history of any length is never sorted. ``marks`` may hand them over: run_id, stage,
    _first, _end.
    """
    at = F.struct(*order)
    ends = F.col("status").isin(COMPLETED, FAILED)
    if marks is None:
        marks = events.groupBy("run_id", "stage").agg(
            F.min(at).alias("_first"), F.min(F.when(ends, at)).alias("_end")
        )
    joined = join_lookup(
        events, derived_lookup(marks, max_lookup_rows), ["run_id", "stage"], "inner", spread_by
    )
    return joined.select(
        *events.columns,
        F.when(at > F.col("_end"), "after end")
        .when((F.col("status") == RUNNING) & (at > F.col("_first")), "second start")
        .alias("reason"),
    ).where(F.col("reason").isNotNull())


def path_parts(path: Column) -> Column:
    """Folders and file of a path, with ``.`` and ``..`` resolved.

    A ``..`` with nothing above it stays, so such a path is inside no folder. The first part
    of an absolute path is empty.
    """
    nothing = F.array().cast("array<string>")

    def step(done, part):
        up = (F.size(done) > 0) & ~F.element_at(done, -1).isin("..", "")
        return (
            F.when(part.isin("", "."), done)
            .when((part == "..") & F.coalesce(up, F.lit(False)), F.slice(done, 1, F.size(done) - 1))
            .otherwise(F.concat(done, F.array(part)))
        )

    start = F.when(F.startswith(path, F.lit("/")), F.array(F.lit(""))).otherwise(nothing)
    return F.aggregate(F.split(path, "/"), start, step)


def foreign_outputs(outputs: DataFrame, path: str, run_dir: Column) -> DataFrame:
    """Outputs that lie neither in their run's folder nor are it, once paths are resolved."""
    top = path_parts(run_dir)
    inside = F.slice(path_parts(F.col(path)), F.lit(1), F.size(top)) == top
    return outputs.where(~F.coalesce(inside, F.lit(False)))


# --- lineage and reports (L4-L6) ------------------------------------------------------


def _contracted(
    single: DataFrame, branches: DataFrame, seeds: DataFrame, max_rows: int
) -> tuple[DataFrame, list[DataFrame]]:
    """Chains with most of their inner nodes taken out: node, dst, length; and what was passed over.

    A node is inner if only nodes of chains lead to it and no seed is one. A round takes out the
    inner nodes whose hash has the bit of the round and whose target's has not, about a quarter
    and no two in a row; those that led to one lead to its target now, by the summed length. So
    all rounds together move a few times the rows of the chains. Per round: node, the inner node
    ``via`` that it led to, and how far that is. Rounds end once inner nodes are within ``max_rows``
    or fewer than a quarter of the rest.
    """
    plain = single.withColumn("length", F.lit(1).cast("bigint"))
    if len(single.take(max_rows + 1)) <= max_rows:
        return plain, []
    targets = single.select(F.col("dst").alias("node")).distinct()
    inside = written(single.select("node").join(targets, "node", "left_semi"), "lineage-inside", "zstd")
    if len(inside.take(max_rows + 1)) <= max_rows:
        return plain, []
    entered = branches.select(F.col("dst").alias("node")).unionByName(seeds).distinct()
    inner = inside.join(entered, "node", "left_anti")
    chains = written(
        plain.join(inner.withColumn("inner", F.lit(True)), "node", "left").select(
            "node", "dst", "length", F.coalesce("inner", F.lit(False)).alias("inner")
        ),
        "lineage-chains", "zstd",
    )
    passed = []
    while True:
        left, rows = chains.agg(F.count_if("inner"), F.count(F.lit(1))).first()
        if left <= max_rows or 4 * left < rows:
            return chains.select("node", "dst", "length"), passed

        def bit(name, turn=len(passed)):
            return F.xxhash64(F.col(name), F.lit(turn)).bitwiseAND(F.lit(1)) == 1

        out = F.col("inner") & bit("node") & ~bit("dst")
        gone = chains.where(out).select(
            F.col("node").alias("dst"), F.col("dst").alias("_to"), F.col("length").alias("_more")
        )
        rest = chains.where(~out)
        lookup = stored_lookup(gone, max_rows)
        moved = join_lookup(rest.where(bit("dst")), lookup, ["dst"], "left", spread_by=["node"]).select(
            "node",
            F.coalesce("_to", "dst").alias("dst"),
            (F.col("length") + F.coalesce("_more", F.lit(0))).alias("length"),
            "inner",
            F.when(F.col("_to").isNotNull(), F.col("dst")).alias("via"),
            F.when(F.col("_to").isNotNull(), F.col("length")).alias("via_length"),
        )
        nothing = F.when(F.lit(False), F.col("dst")), F.when(F.lit(False), F.col("length"))
        kept = rest.where(~bit("dst")).select("*", nothing[0].alias("via"), nothing[1].alias("via_length"))
        step = written(kept.unionByName(moved), "lineage-chains", "zstd")
        passed.append(step.where("via is not null").select("node", "via", "via_length"))
        # A loop that has shrunk to one node leads to nothing new.
        chains = step.where("node <> dst").select("node", "dst", "length", "inner")


def _expanded(
    reached: DataFrame, single: DataFrame, passed: Sequence[DataFrame]
) -> Iterator[DataFrame]:
    """Depths of the nodes taken out by ``_contracted``, last round first: node, depth."""
    if not passed:
        return
    near = written(reached.join(single.select("node"), "node", "left_semi"), "lineage-reached", "zstd")
    for step in reversed(passed):
        found = written(
            step.join(near, "node")
            .groupBy(F.col("via").alias("node"))
            .agg(F.min(F.col("depth") + F.col("via_length")).alias("depth")),
            "lineage-found", "zstd",
        )
        yield found
        near = near.unionByName(found)


def closure_rounds(
    seeds: DataFrame, edges: DataFrame, max_lookup_rows: int = BROADCAST_ROWS
) -> Iterator[DataFrame]:
    """Rounds of ``lineage_closure``: (node, depth) of the nodes found or found nearer in each.

    A node with one target is a link of a chain. Chains are followed by jumps that double: the
    jump of level k skips 2 ** k links, and a round joins the jumps of one level with themselves
    to get the next. From the round a chain is entered, all its found nodes jump by the next level
    each round, so it is covered in as many rounds as its length has binary digits, from whatever
    node it is entered and however many chains lie one behind the other. Only chains are shortened:
    jumps are never more than nodes. Nodes with several targets pass on one step, once. Targets
    that lead nowhere do not count as targets here: they are found in one step after the rest.
    Chains longer than the bound of a lookup are first contracted (``_contracted``), so that the
    levels of jumps are made of what is left; the nodes passed over get their depth afterwards.
    """
    every = written(
        edges.where("src is not null and dst is not null and src <> dst")
        .select(F.col("src").alias("node"), "dst"),
        "lineage-edges", "zstd",
    )
    sources = written(every.select(F.col("node").alias("dst")).distinct(), "lineage-sources", "zstd")
    sources = stored_lookup(sources.withColumn("onward", F.lit(True)), max_lookup_rows)
    # Links and the targets that lead nowhere come from one join with all edges.
    marked = join_lookup(every, sources, ["dst"], "left", spread_by=["node"])
    marked = written(marked.select("node", "dst", F.col("onward").isNotNull().alias("onward")), "lineage-links", "zstd")
    links, leaves = (marked.where(is_link).select("node", "dst") for is_link in ("onward", "not onward"))
    ends = links.groupBy("node").agg(F.min("dst").alias("dst"), F.max("dst").alias("last"))
    single = written(ends.where("dst = last").select("node", "dst"), "lineage-jumps", "zstd")
    branches = written(
        join_lookup(
            links,
            stored_lookup(single.select("node"), max_lookup_rows),
            ["node"],
            "left_anti",
            spread_by=["dst"],
        ),
        "lineage-branches", "zstd",
    )
    hot = branching = None
    start = seeds.where("node is not null").select("node")
    chains, passed = _contracted(single, branches, start, max_lookup_rows)
    jumps = [chains]
    found = written(
        seeds.where("node is not null")
        .select("node", F.lit(0).cast("bigint").alias("depth"), F.lit(0).alias("level"))
        .distinct(),
        "lineage-found", "zstd",
    )
    known, active = [found], found
    while True:
        yield found.select("node", "depth")
        entered = stored_lookup(found.select("node", "depth"), max_lookup_rows)
        if not entered.fits:
            # Beyond the bound all branches are shuffled, so only for nodes that have some.
            if branching is None:
                branching = written(branches.select("node").distinct(), "lineage-branching", "zstd")
            onward = found.select("node", "depth").join(branching, "node", "left_semi")
            entered = stored_lookup(written(onward, "lineage-entered", "zstd"), max_lookup_rows)
        if not entered.fits and hot is None:
            hot = hot_keys(branches, ["node"])
        stepped = join_lookup(branches, entered, ["node"], "inner", spread_by=["dst"], hot=hot)
        by_level = reduce(
            DataFrame.unionByName,
            [jump.withColumn("level", F.lit(k)) for k, jump in enumerate(jumps)],
        )
        jumped = written(active.join(by_level, ["node", "level"]), "lineage-jumped", "zstd")
        reached = (
            stepped.select("dst", (F.col("depth") + 1).alias("depth"), F.lit(0).alias("level"))
            .unionByName(
                jumped.select(
                    "dst", (F.col("depth") + F.col("length")).alias("depth"), (F.col("level") + 1).alias("level")
                )
            )
            .groupBy(F.col("dst").alias("node"))
            .agg(F.min(F.struct("depth", "level")).alias("best"))
            .select("node", "best.depth", "best.level")
        )
        before = reduce(DataFrame.unionByName, [k.select("node", F.col("depth").alias("_old")) for k in known])
        before = before.groupBy("node").agg(F.min("_old").alias("_old"))
        found = written(
            reached.join(before, "node", "left")
            .where("_old is null or depth < _old")
            .select("node", "depth", "level"),
            "lineage-found", "zstd",
        )
        if found.isEmpty():
            reached = before.select("node", F.col("_old").alias("depth"))
            for inner in _expanded(reached, single, passed):
                yield inner
                reached = reached.unionByName(inner)
            lookup = stored_lookup(reached, max_lookup_rows)
            last_step = join_lookup(leaves, lookup, ["node"], "inner", spread_by=["dst"])
            nearest = last_step.groupBy(F.col("dst").alias("node")).agg(F.min("depth").alias("depth"))
            yield written(nearest.withColumn("depth", F.col("depth") + 1), "lineage-leaves", "zstd")
            return
        known.append(found)
        onward = jumped.select("node", "depth", (F.col("level") + 1).alias("level"))
        active = written(
            onward.unionByName(found)
            .groupBy("node")
            .agg(F.min(F.struct("depth", "level")).alias("best"))
            .select("node", "best.depth", "best.level"),
            "lineage-active", "zstd",
        )
        last = jumps[-1]
        if not last.isEmpty():
            half = last.select(
                F.col("node").alias("_half"), F.col("dst").alias("_end"), F.col("length").alias("_more")
            )
            doubled = join_lookup(
                last.withColumnRenamed("dst", "_half"),
                stored_lookup(half, max_lookup_rows),
                ["_half"],
                "inner",
                spread_by=["node"],
            )
            # A jump that ends where it began leads to nothing new.
            doubled = doubled.where("node <> _end").select(
                "node", F.col("_end").alias("dst"), (F.col("length") + F.col("_more")).alias("length")
            )
            jumps.append(written(doubled, "lineage-jumps", "zstd"))


def lineage_closure(
    seeds: DataFrame, edges: DataFrame, max_lookup_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Every node reachable from the seeds, with its least number of steps: node, depth.

    ``seeds`` has ``node``; ``edges`` has ``src`` and ``dst``; nulls and loops of one node are left
    out. Longer loops end as nothing new is found. The number of rounds grows with the number of
    branching nodes one behind the other (targets that lead nowhere make no branch), and with the
    logarithm of the chains between them (``closure_rounds``). Each round is written to the shared folder.
    """
    found = reduce(DataFrame.unionByName, closure_rounds(seeds, edges, max_lookup_rows))
    return found.groupBy("node").agg(F.min("depth").alias("depth"))


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose target no record holds. ``nodes`` has ``node``, once or more often."""
    known = derived_lookup(nodes.select(F.col("node").alias("dst")).distinct())
    return join_lookup(
        edges.where("dst is not null"), known, ["dst"], "left_anti", spread_by=["src"]
    )


def report_gate(
    cases: DataFrame,
    by: Sequence[str],
    expected_failures: Sequence[str] = (),
    required: Sequence[str] = CHECKS,
) -> DataFrame:
    """Verdict per check report: every required check exactly once, nothing skipped, and the
    failed checks are exactly the expected ones (U2).

    ``cases``: name, failed, skipped. The counts per name are plain conditional counts.
    """
    name, failed = F.col("name"), F.col("failed")
    once = F.lit(True)
    for check in required:
        once = once & (F.count_if(name == check) == 1)
    expected = list(expected_failures)
    hits = F.lit(True)
    for check in expected:
        hits = hits & F.coalesce(F.bool_or((name == check) & failed), F.lit(False))
    unexpected = F.count_if(failed & ~name.isin(expected)) if expected else F.count_if(failed)
    return (
        cases.groupBy(*by)
        .agg(
            once.alias("complete"),
            F.coalesce(F.bool_or("skipped"), F.lit(False)).alias("any_skipped"),
            F.count_if(failed).alias("n_failed"),
            (hits & (unexpected == 0)).alias("as_expected"),
        )
        .withColumn(
            "accepted", F.col("complete") & ~F.col("any_skipped") & F.col("as_expected")
        )
    )


def version_outcomes(
    executions: DataFrame,
    stages: DataFrame,
    failed_checks: DataFrame,
    first: str = "1.0.0",
    second: str = "1.0.1",
    must_fail: str = "test_proper_boundaries",
    must_complete: Sequence[str] = TRAINING_STAGES,
    not_reached: str = "train_random_forest",
    sample: str = "sample2.csv",
) -> DataFrame:
    """Whether each of the two versions shows its required outcome: always two rows.

    The first version has to fail on one named check alone and not reach training; the second
    has to complete every training stage. At least one execution has to show it, and none may
    contradict it: fail in another way, or end well without all stages. ``executions``:
    run_id, version, exit_status; ``stages``: run_id, stage, status; ``failed_checks``:
    run_id, name. Where executions have a ``sample``, those on other samples do not count;
    where they have ``commit`` and ``dirty``, all of a version must be of one clean commit
    that the other version does not have.
    """
    spark = executions.sparkSession
    if "sample" in executions.columns:
        executions = executions.where(F.col("sample") == sample)
    has_code = {"commit", "dirty"} <= set(executions.columns)
    reached = stages.groupBy("run_id").agg(
        F.bool_or(F.col("stage") == not_reached).alias("_trained"),
        F.bool_or(F.col("status") == FAILED).alias("_failed"),
        *[
            F.bool_or((F.col("stage") == s) & (F.col("status") == COMPLETED)).alias(f"_done_{i}")
            for i, s in enumerate(must_complete)
        ],
    )
    broken = failed_checks.groupBy("run_id").agg(
        F.bool_and(F.col("name") == must_fail).alias("_only_expected")
    )

    def known(name):
        return F.coalesce(F.col(name), F.lit(False))

    all_done = F.lit(True)
    for i in range(len(must_complete)):
        all_done = all_done & known(f"_done_{i}")
    shows = (
        F.when(
            F.col("version") == first,
            (F.col("exit_status") != 0)
            & known("_failed")
            & ~known("_trained")
            & known("_only_expected"),
        )
        .when(F.col("version") == second, (F.col("exit_status") == 0) & all_done)
        .otherwise(False)
    )
    failed = F.col("exit_status") != 0
    relevant = F.when(F.col("version") == first, failed).otherwise(~failed)
    commit = F.col("commit") if has_code else F.col("version")
    clean = ~F.col("dirty") if has_code else F.lit(True)
    per_version = (
        executions.join(reached, "run_id", "left")
        .join(broken, "run_id", "left")
        .groupBy("version")
        .agg(
            F.count(F.lit(1)).alias("executions"),
            F.count_if(shows).alias("matching"),
            F.count_if(relevant & ~shows).alias("contradicting"),
            F.min(commit).alias("_low"),
            F.max(commit).alias("_high"),
            F.bool_and(F.coalesce(clean, F.lit(False))).alias("_clean"),
        )
    )
    required = spark.createDataFrame([(first,), (second,)], "version string")
    none = F.lit(0).cast("bigint")
    both = Window.partitionBy("_low")
    # Two rows from here on.
    return (
        required.join(per_version, "version", "left")
        .withColumn("_alone", F.count(F.lit(1)).over(both) == 1)
        .select(
            "version",
            *[F.coalesce(c, none).alias(c) for c in ("executions", "matching", "contradicting")],
            F.coalesce(
                (F.col("matching") > 0)
                & (F.col("contradicting") == 0)
                & F.col("_clean")
                & (F.col("_low") == F.col("_high"))
                & F.col("_alone"),
                F.lit(False),
            ).alias("accepted"),
        )
    )
