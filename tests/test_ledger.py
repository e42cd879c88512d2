"""Records: selection, reconciliation, stage rules, digests, lineage."""

import hashlib

import math

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import digests, ledger


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_lowest_error_wins_and_ties_go_by_run(spark):
    df = spark.createDataFrame(
        [("r1", 3.0), ("r3", 1.0), ("r2", 1.0)], "run_id string, mae double"
    )
    assert ledger.select_best(df).first()["run_id"] == "r2"
    ranked = [tuple(r) for r in ledger.rank_candidates(df).collect()]
    assert ranked == [("r2", 1.0, True), ("r3", 1.0, False), ("r1", 3.0, False)]


def test_a_run_without_a_usable_error_never_wins(spark):
    bad = [("a", None), ("b", math.nan), ("c", -1.0), ("d", math.inf)]
    df = spark.createDataFrame([*bad, ("r", 2.0)], "run_id string, mae double")
    assert ledger.select_best(df).first()["run_id"] == "r"
    ranked = [(r["run_id"], r["is_best"]) for r in ledger.rank_candidates(df).collect()]
    assert ranked[0] == ("r", True) and not any(best for _, best in ranked[1:])
    none = spark.createDataFrame(bad, "run_id string, mae double")
    assert ledger.select_best(none).count() == 0
    assert not any(r["is_best"] for r in ledger.rank_candidates(none).collect())


@pytest.mark.parametrize(
    "runs, comparable",
    [
        ([("a", "s", "1"), ("b", "s", "2"), ("c", "s", "3")], True),
        ([("a", "s", "1"), ("b", "s", "2")], False),
        ([("a", "s", "1"), ("b", "s", "2"), ("b", "s", "3")], False),
        ([("a", "s", "1"), ("b", "s", "2"), ("c", "t", "3")], False),
        ([("a", "s", "1"), ("b", "s", "2"), ("c", "s", "2")], False),
        ([("a", "s", "1"), ("b", "s", "2"), ("c", "s", "3"), ("c", "s", "3")], False),
        ([("a", "s", "1"), ("b", "s", "2"), ("c", None, "3")], False),
    ],
)
def test_comparison_needs_three_runs_one_setting_three_configurations(spark, runs, comparable):
    df = spark.createDataFrame(runs, "run_id string, split string, parameters string")
    got = ledger.comparable_runs(df.withColumn("g", F.lit(1)), ["g"], ["split"]).first()
    assert got["comparable"] is comparable


def test_only_complete_training_is_eligible(spark):
    names = ["model", "parameters", "metrics", "feature_importance"]
    runs = [("ok", "completed"), ("late", "completed"), ("lost", "completed"), ("off", "completed"),
            ("bad", "failed")]
    stages = [(r, "train_random_forest", "running" if r == "late" else "completed",
               names[:3] if r == "lost" else names, 1.0, 0.5) for r, _ in runs]
    metrics = [(r, 2.0 if r == "off" else 1.0, 0.5) for r, _ in runs]
    got = ledger.eligible_candidates(
        spark.createDataFrame(runs, "run_id string, status string"),
        spark.createDataFrame(
            stages, "run_id string, stage string, status string, output_names array<string>, mae double, r2 double"
        ),
        spark.createDataFrame(metrics, "run_id string, mae double, r2 double"),
    )
    assert rows_of(got) == [("ok", 1.0, 0.5)]


def test_training_records_must_agree_and_metrics_be_finite(spark):
    names = ["model", "parameters", "metrics", "feature_importance"]
    rows = [("ok", "{}", "{}", 0.5), ("other", "{}", "{1}", 0.5), ("endless", "{}", "{}", -math.inf)]
    runs = spark.createDataFrame([(r[0], "completed") for r in rows], "run_id string, status string")
    stages = spark.createDataFrame(
        [(r, "train_random_forest", "completed", names, 1.0, r2, p) for r, p, _, r2 in rows],
        "run_id string, stage string, status string, output_names array<string>, mae double, r2 double, "
        "parameters string",
    )
    metrics = spark.createDataFrame(
        [(r, 1.0, r2, p) for r, _, p, r2 in rows], "run_id string, mae double, r2 double, parameters string"
    )
    assert rows_of(ledger.eligible_candidates(runs, stages, metrics)) == [("ok", 1.0, 0.5)]


def test_multiset_difference_counts_copies(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    right = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v int")
    assert rows_of(ledger.multiset_difference(left, right)) == [(1, 1), (3, -1)]


def test_digests_ok_changed_missing(spark):
    recorded = spark.createDataFrame(
        [("a", "1"), ("b", "2"), ("c", "3")], "path string, sha256 string"
    )
    actual = spark.createDataFrame([("a", "1"), ("b", "9")], "path string, sha256 string")
    got = rows_of(ledger.verify_digests(recorded, actual, ["path"]))
    assert got == [("a", "ok"), ("b", "changed"), ("c", "missing")]


def test_disagreements_name_the_columns(spark):
    left = spark.createDataFrame(
        [("a", 1, "x"), ("b", 1, None), ("c", 2, "y"), ("d", 1, "x")], "k string, n int, t string"
    )
    right = spark.createDataFrame(
        [("a", 1, "x"), ("b", 1, None), ("c", 1, None)], "k string, n int, t string"
    )
    got = rows_of(ledger.disagreements(left, right, ["k"], ["n", "t"]))
    assert got == [("c", ["n", "t"]), ("d", ["<missing>"])]


def test_evaluation_verdicts(spark):
    selections = spark.createDataFrame(
        [("m1", "s1", "h1", "p1"), ("m9", "s1", "h1", "p1")],
        "run_id string, split_id string, test_sha256 string, model_path string",
    )
    rows = [
        ("e1", "m1", "s1", "h1", "p1", 1.5, 0.4),
        ("e2", "m2", "s1", "h1", "p1", 1.5, 0.4),
        ("e3", "m1", "s1", "h2", "p1", 1.5, 0.4),
        ("e4", "m1", "s1", "h1", "p1", -1.0, 0.4),
        ("e5", "m1", "s1", "h1", "p1", 1.5, None),
    ]
    evaluations = spark.createDataFrame(
        rows, "run_id string, model_run_id string, split_id string, test_sha256 string, "
        "model_path string, mae double, r2 double"
    )
    got = {r["run_id"]: r["verdict"] for r in ledger.reconcile_evaluation(evaluations, selections).collect()}
    assert got == {"e1": "accepted", "e2": "unselected", "e3": "mismatch", "e4": "bad metrics",
                   "e5": "bad metrics", None: "missing"}
    running = evaluations.withColumn("status", F.lit("running"))
    alone = ledger.reconcile_evaluation(running, selections)
    assert rows_of(alone) == [(None, "m1", "missing"), (None, "m9", "missing")]
    paths = selections.withColumn("test_path", F.lit("a"))
    moved = ledger.reconcile_evaluation(evaluations.withColumn("test_path", F.lit("b")), paths)
    assert moved.where("run_id = 'e1'").first()["verdict"] == "mismatch"


@pytest.mark.parametrize("max_lookup_rows", [100, 1])
def test_only_checked_data_goes_on(spark, max_lookup_rows):
    datasets = spark.range(1000).select(
        "id", F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string")).alias("sha256")
    )
    checks = spark.createDataFrame(
        [("hot", "completed"), ("hot", "completed"), ("950", "failed"), ("951", "completed")],
        "sha256 string, status string",
    )
    passed = ledger.validated_only(datasets, checks, ["sha256"], ["id"], max_lookup_rows=max_lookup_rows)
    refused = ledger.validated_only(
        datasets, checks, ["sha256"], ["id"], refused=True, max_lookup_rows=max_lookup_rows
    )
    assert passed.count() == 901 and refused.count() == 99
    assert passed.join(refused, "id").isEmpty()


def test_run_status(spark):
    runs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "run_id string")
    stages = spark.createDataFrame(
        [("a", "x", "completed"), ("a", "y", "completed"), ("b", "x", "failed"), ("b", "y", "running"),
         ("c", "x", "completed"), ("c", "y", "running")],
        "run_id string, stage string, status string",
    )
    assert rows_of(ledger.run_status(runs, stages)) == [
        ("a", 2, "completed"), ("b", 2, "failed"), ("c", 2, "running"), ("d", 0, "running"),
    ]


@pytest.mark.parametrize("max_lookup_rows", [100, 1])
def test_stage_history_rules(spark, max_lookup_rows):
    histories = {
        "fine": "running completed",
        "twice": "running running completed",
        "again": "running failed running completed",
        "short": "completed completed",
    }
    rows = [
        (run, "s", status, i) for run, text in histories.items() for i, status in enumerate(text.split())
    ]
    events = spark.createDataFrame(rows, "run_id string, stage string, status string, t int")
    got = ledger.invalid_transitions(events, ["t"], ["t"], max_lookup_rows)
    assert sorted((r["run_id"], r["t"], r["reason"]) for r in got.collect()) == [
        ("again", 2, "after end"), ("again", 3, "after end"), ("short", 1, "after end"),
        ("twice", 1, "second start"),
    ]


def test_outputs_outside_their_run(spark):
    df = spark.createDataFrame(
        [("r1", "runs/r1/a"), ("r1", "runs/r1/./b/../a"), ("r1", "x/../runs//r1/"), ("r1", "runs/r1"),
         ("r1", "runs/r10/a"), ("r1", "runs/r1/../b/x"), ("r1", "../runs/r1/a"), ("r1", "/runs/r1/a"),
         ("r1", "runs/r1/a/../../.."), ("r1", ""), ("r1", None)],
        "run_id string, path string",
    )
    own = F.concat(F.lit("runs/"), F.col("run_id"))
    assert ledger.foreign_outputs(df, "path", own).count() == 7


@pytest.mark.parametrize("max_lookup_rows", [100, 1])
def test_lineage_ends_in_loops_and_passes_hot_nodes(spark, max_lookup_rows):
    loop = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("c", "d"), ("d", "d"), ("d", None)]
    edges = spark.createDataFrame(loop, "src string, dst string").unionByName(
        spark.range(500).select(F.lit("d").alias("src"), F.concat(F.lit("leaf"), "id").alias("dst"))
    )
    seeds = spark.createDataFrame([("a",), ("a",)], "node string")
    got = {r["node"]: r["depth"] for r in ledger.lineage_closure(seeds, edges, max_lookup_rows).collect()}
    assert got.pop("a") == 0 and got.pop("b") == 1 and got.pop("c") == 2 and got.pop("d") == 3
    assert len(got) == 500 and set(got.values()) == {4}


def chain(spark, n, name="n"):
    link = [F.concat(F.lit(name), (F.col("id") + step).cast("string")) for step in (0, 1)]
    return spark.range(n).select(link[0].alias("src"), link[1].alias("dst"))


def test_a_long_chain_closes_in_few_rounds(spark):
    seeds = spark.createDataFrame([("n0",)], "node string")
    leaves = spark.range(10_000).selectExpr("concat('n', id) as src", "concat('leaf', id % 50) as dst")
    rounds = list(ledger.closure_rounds(seeds, chain(spark, 10_000).unionByName(leaves)))
    assert len(rounds) <= 16
    found = {r["node"]: r["depth"] for part in rounds for r in part.collect()}
    expected = {f"n{i}": i for i in range(10_001)} | {f"leaf{i}": i + 1 for i in range(50)}
    assert found == expected


@pytest.mark.parametrize("seed, max_lookup_rows", [(0, 100_000), (1, 1)])
def test_closure_equals_a_plain_search(spark, seed, max_lookup_rows):
    """Chains that meet, branch, loop and are entered in their middle."""
    import random

    pick = random.Random(seed)
    edges = [(f"a{i}", f"a{i + 1}") for i in range(60)] + [("a60", pick.choice(["a30", "b0"]))]
    edges += [(f"b{i}", f"b{i + 1}") for i in range(25)]
    edges += [(f"a{pick.randrange(61)}", f"b{pick.randrange(26)}") for _ in range(3)]
    edges += [(f"b{pick.randrange(26)}", f"a{pick.randrange(61)}") for _ in range(2)]
    edges += [("b25", "c0"), ("c0", "c1"), ("c1", "c2"), ("c2", "c0"), ("a5", "a5"), (None, "a1"), ("a1", None)]
    seeds = [f"a{pick.randrange(61)}", f"b{pick.randrange(26)}", None, "elsewhere"]
    targets = {}
    for a, b in edges:
        targets.setdefault(a, []).append(b)
    depths = {s: 0 for s in seeds if s}
    layer = list(depths)
    while layer:
        layer = [d for n in layer for d in targets.get(n, ()) if d and d not in depths and not depths.update({d: depths[n] + 1})]
    got = ledger.lineage_closure(
        spark.createDataFrame([(s,) for s in seeds], "node string"),
        spark.createDataFrame(edges + edges[:9], "src string, dst string"),
        max_lookup_rows,
    )
    assert {r["node"]: r["depth"] for r in got.collect()} == depths


def test_chains_beyond_the_bound_are_contracted_first(spark):
    """Rows of all rounds of contraction are a few times the chain's, not one chain a level."""
    n = 1000
    seeds = spark.createDataFrame([("n0",), ("n100",), ("l3",)], "node string")
    loop = spark.range(60).selectExpr("concat('l', id) as src", "concat('l', (id + 1) % 60) as dst")
    single = chain(spark, n).unionByName(loop).withColumnRenamed("src", "node")
    chains, passed = ledger._contracted(single, single.where("false"), seeds, 150)
    assert chains.count() <= 200 and sum(p.count() for p in passed) >= n - 200
    edges = chain(spark, n).unionByName(loop)
    edges = edges.unionByName(spark.createDataFrame([("n500", "l7"), ("n900", "leaf")], "src string, dst string"))
    got = {r["node"]: r["depth"] for r in ledger.lineage_closure(seeds, edges, 150).collect()}
    expected = {f"n{i}": i if i < 100 else i - 100 for i in range(n + 1)} | {"leaf": 801}
    assert got == expected | {f"l{i}": (i - 3) % 60 for i in range(60)}


def test_beyond_the_bound_only_branching_nodes_are_joined_to_branches(spark, monkeypatch):
    names, plain = {}, ledger.written
    def kept(df, name, *more):
        names.setdefault(name, []).append(done := plain(df, name, *more))
        return done
    monkeypatch.setattr(ledger, "written", kept)
    edges = [(f"o{i}", f"{k}{i % 3}") for i in range(9) for k in "cp"]
    edges += [(f"o{i}", f"s{i % 4}") for i in range(9)]
    edges += [(f"{k}{i}", "nation") for k in "cs" for i in range(4)] + [("nation", "region")]
    seeds = spark.createDataFrame([(f"o{i}",) for i in range(6)], "node string")
    got = ledger.lineage_closure(seeds, spark.createDataFrame(edges, "src string, dst string"), 3)
    depths = {f"o{i}": 0 for i in range(6)} | {f"{k}{i}": 1 for k in "cp" for i in range(3)}
    depths |= {f"s{i}": 1 for i in range(4)} | {"nation": 2, "region": 3}
    assert {r["node"]: r["depth"] for r in got.collect()} == depths
    entered = [{r["node"][0] for r in df.collect()} for df in names["lineage-entered"]]
    assert entered[0] == {"o"} and all(not nodes for nodes in entered[1:])
    # Links and ends come from one table, so all edges are joined to their sources once.
    assert {"node", "dst", "onward"} == set(names["lineage-links"][0].columns)


def test_edges_of_records_are_kept_with_digests_as_bytes(spark, tmp_path, monkeypatch):
    import hashlib

    from tallyhouse.workload import recording

    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    table("orders", [(1, 7, "F"), (2, None, "O"), (3, 8, "P")], "o_orderkey long, o_custkey long, o_orderstatus string")
    lines = [(1, 1, 5, "R"), (1, 2, 5, "N"), (1, 2, 5, "N"), (2, 1, None, "N"), (9, 1, 5, "N")]
    table("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string")
    table("customer", [(7, 1.0), (8, -1.0)], "c_custkey long, c_acctbal double")
    table("part", [(5,)], "p_partkey long")
    types, plain = [], recording.written
    monkeypatch.setattr(recording, "written", lambda df, *more: types.append(dict(df.dtypes)) or plain(df, *more))
    rows = [tuple(r) for r in recording.lineage_edges(spark, str(tmp_path)).collect()]
    wanted = [("1", "customers/7", False), ("3", "customers/8", True), ("1", "parts/5-returned", True)]
    wanted += [("1", "parts/5", False)] * 2
    digest = lambda path: hashlib.sha256(path.encode()).hexdigest()
    assert sorted(rows) == sorted((f"orders/{o}", path, digest(path), open_end) for o, path, open_end in wanted)
    assert [t["sha256"] for t in types] == ["binary"]


def test_nothing_to_start_from(spark):
    seeds = spark.createDataFrame([(None,)], "node string")
    assert ledger.lineage_closure(seeds, chain(spark, 5)).count() == 0


def test_version_outcomes(spark):
    five = ["download", "basic_cleaning", "data_check", "data_split", "train_random_forest"]
    executions = spark.createDataFrame(
        [("v1", "1.0.0", 1), ("v2", "1.0.1", 0), ("v3", "1.0.0", 0)],
        "run_id string, version string, exit_status int",
    )
    stages = [("v1", "data_check", "failed")] + [("v2", s, "completed") for s in five]
    stages = spark.createDataFrame(stages, "run_id string, stage string, status string")
    failed = spark.createDataFrame([("v1", "test_proper_boundaries")], "run_id string, name string")
    assert rows_of(ledger.version_outcomes(executions, stages, failed)) == [
        ("1.0.0", 2, 1, 0, True), ("1.0.1", 1, 1, 0, True),
    ]
    only = executions.where("version = '1.0.1'")
    assert rows_of(ledger.version_outcomes(only, stages, failed))[0] == ("1.0.0", 0, 0, 0, False)
    again = executions.unionByName(spark.createDataFrame([("v4", "1.0.1", 0)], executions.schema))
    assert rows_of(ledger.version_outcomes(again, stages, failed))[1] == ("1.0.1", 2, 1, 1, False)
    for commits, dirty, accepted in (
        ({"1.0.0": "a", "1.0.1": "b"}, False, True),
        ({"1.0.0": "a", "1.0.1": "a"}, False, False),
        ({"1.0.0": "a", "1.0.1": "b"}, True, False),
    ):
        commit = F.when(F.col("version") == "1.0.0", commits["1.0.0"]).otherwise(commits["1.0.1"])
        coded = executions.withColumn("commit", commit).withColumn("dirty", F.lit(dirty))
        got = rows_of(ledger.version_outcomes(coded, stages, failed))
        assert [r[-1] for r in got] == [accepted, accepted]
    sampled = executions.withColumn("sample", F.lit("sample1.csv"))
    assert [r[1] for r in rows_of(ledger.version_outcomes(sampled, stages, failed))] == [0, 0]
    more = failed.unionByName(spark.createDataFrame([("v1", "test_price_range")], failed.schema))
    assert rows_of(ledger.version_outcomes(executions, stages, more))[0] == ("1.0.0", 2, 0, 1, False)
    trained = stages.unionByName(
        spark.createDataFrame([("v1", "train_random_forest", "running")], stages.schema)
    )
    assert rows_of(ledger.version_outcomes(executions, trained, failed))[0][2] == 0
    part = stages.where("stage <> 'download'")
    assert rows_of(ledger.version_outcomes(executions, part, failed))[1] == ("1.0.1", 1, 0, 1, False)


def test_split_problems(spark):
    schema = (
        "split_id string, run_id string, source_run_id string, source_sha256 string, "
        "trainval_sha256 string, test_size double, random_seed bigint, stratify_by string, test_sha256 string"
    )
    splits = spark.createDataFrame(
        [("s1", "r1", "c1", "src", "tv", 0.2, 42, "g", "te"), ("s2", "r2", "c2", "src", "other", 0.2, 42, "g", "te"),
         ("s3", "r3", "c1", "src", "tv", 0.3, 42, "g", "x")], schema,
    )
    outputs = spark.createDataFrame(
        [("r1", "data_split", "trainval", "tv"), ("r2", "data_split", "trainval", "tv"),
         ("r3", "data_split", "trainval", "tv"), ("c1", "basic_cleaning", "clean", "src"),
         ("r1", "data_split", "test", "te"), ("r2", "data_split", "test", "te"), ("r3", "data_split", "test", "te")],
        "run_id string, stage string, name string, sha256 string",
    )
    trainings = spark.createDataFrame(
        [("s1", "tv"), ("s1", "tv"), ("s3", "tv"), ("s3", "xx")], "split_id string, trainval_sha256 string"
    )
    configured = F.struct(
        F.lit(0.2).alias("test_size"), F.lit(42).cast("bigint").alias("random_seed"), F.lit("g").alias("stratify_by")
    )
    assert rows_of(ledger.reconcile_split(splits, outputs, trainings, configured)) == [
        ("s1", []), ("s2", ["producer", "source"]), ("s3", ["test", "training", "parameters"]),
    ]
    identity = F.concat(F.lit("s"), F.when(F.col("run_id") == "r1", "1").otherwise("0"))
    got = dict(rows_of(ledger.reconcile_split(splits, outputs, trainings, configured, identity)))
    assert got["s1"] == [] and got["s2"][-1] == "identity"


def test_fingerprint_ignores_order_and_sees_every_change(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, t string")
    first = digests.fingerprint(df)
    assert digests.fingerprint(df.repartition(5).orderBy(F.desc("i"))) == first
    changed = [
        df.limit(0), df.distinct(), df.na.fill(""), df.na.fill("N"),
        df.withColumn("t", F.upper("t")), df.select("t", "i"),
    ]
    prints = [digests.fingerprint(d) for d in changed]
    assert first not in prints and len(set(prints)) == len(prints)
    # Neighbouring columns cannot trade characters.
    pair = [digests.fingerprint(spark.createDataFrame([r], "a string, b string"))
            for r in (("ab", "c"), ("a", "bc"))]
    assert pair[0] != pair[1]


def test_folder_digest_of_nested_files(spark, tmp_path):
    folder = tmp_path / "model"
    contents = {"MLmodel": b"x", "a/1": b"\x00\xff", "a/b/c": b"0", "a.txt": b"t", "a-b/z": b"q"}
    for name, data in contents.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    expected = hashlib.sha256()
    for name in sorted(contents, key=lambda n: n.split("/")):
        expected.update(name.encode() + b"\0" + hashlib.sha256(contents[name]).digest())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(folder))
    named = digests.file_digests(files).select(
        F.lit("model").alias("folder"),
        F.expr(f"substring_index(path, '{folder}/', -1)").alias("path"),
        "sha256",
    )
    got = digests.folder_digest(named, "folder", "path", "sha256").first()
    assert (got["n_files"], got["sha256"]) == (5, expected.hexdigest())


def test_folder_digest_over_many_batches(spark):
    files = spark.range(25_000).select(
        F.when(F.col("id") < 24_000, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 3)).alias("folder"),
        F.concat_ws("/", F.lit("d"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("path"),
        F.sha2(F.col("id").cast("string"), 256).alias("digest"),
    )
    got = {r["folder"]: r for r in digests.folder_digest(files, "folder", "path", "digest").collect()}
    expected = hashlib.sha256()
    for i in range(24_000):
        expected.update(f"d/{i:06d}".encode() + b"\0" + hashlib.sha256(str(i).encode()).digest())
    assert set(got) == {"hot", "f0", "f1", "f2"}
    assert (got["hot"]["n_files"], got["hot"]["sha256"]) == (24_000, expected.hexdigest())


def tree_of(files, bucket):
    """A folder's hash tree by recursion."""
    levels = 0
    while len(files) > bucket * 16**levels:
        levels += 1

    def sha(data):
        return hashlib.sha256(data).digest()

    def node(at, inside):
        if len(at) == levels:
            return sha(b"".join(sha(p.encode() + b"\0" + bytes.fromhex(d)) for p, d in sorted(inside)))
        parts = b""
        for digit in "0123456789abcdef":
            own = [f for f in inside if hashlib.sha256(f[0].encode()).hexdigest().startswith(at + digit)]
            if own:
                parts += bytes([int(digit, 16)]) + node(at + digit, own)
        return sha(parts)

    return len(files), levels, node("", files).hex()


def test_folder_trees(spark):
    digest = hashlib.sha256(b"x").hexdigest()
    names = {"a": 1, "b": 9, "c": 300, "": 5, None: 40}
    rows = [(f, f"d{i % 7}/ä{i}", hashlib.sha256(str(i).encode()).hexdigest()) for f, n in names.items() for i in range(n)]
    rows += [("b", "d0/ä0", digest), ("b", None, digest), ("b", "x", None)]
    df = spark.createDataFrame(rows, "folder string, path string, digest string")
    expected = {f: tree_of([(p, d) for g, p, d in rows if g == f and p and d], 8) for f in names}
    for given in (df, df.repartition(5, "digest")):
        got = {r["folder"]: tuple(r)[1:] for r in digests.folder_tree(given, "folder", "path", "digest", 8).collect()}
        assert got == expected
    assert [expected[f][1] for f in ("a", "b", "c", None)] == [0, 1, 2, 1]
    assert digests.folder_tree(df.limit(0), "folder", "path", "digest").count() == 0
