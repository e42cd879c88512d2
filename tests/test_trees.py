"""Trees against a plain search over all cuts, on every path that grows and reads them."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import trees as op

SETTINGS = {
    "numTrees": 1, "maxDepth": 3, "minInstancesPerNode": 3, "featureSubsetStrategy": "all",
    "bootstrap": False, "seed": 7,
}
SCHEMA = "key bigint, label double, features array<double>"


def rows(n=500, seed=1):
    random = np.random.default_rng(seed)
    x = np.stack(
        [random.normal(size=n), random.integers(0, 4, n), random.integers(0, 2, n), np.ones(n), random.normal(size=n)],
        axis=1,
    )
    x[:, 4] = x[:, 0]
    y = np.round(10 * x[:, 1] + 3 * np.sin(3 * x[:, 0]) + random.normal(size=n), 2)
    return [(i, float(y[i]), x[i].tolist()) for i in range(n)]


def brute(data, tree, weights):
    """Nodes of a tree by trying every cut of every node, with whole labels."""
    y = np.array([round(r[1] * 100) for r in data], dtype=object)
    x = np.array([r[2] for r in data])
    out = {}

    def grow(node, at):
        w = weights[at]
        n, s = int(w.sum()), int(sum(w * y[at]))
        best = None
        if not tree.ends(node, n):
            for f in op.tried(tree, np.array([node]), x.shape[1])[0]:
                values = sorted(set(x[at, f].tolist()))
                for low, high in zip(values, values[1:]):
                    left = at[x[at, f] <= low]
                    ln, ls = int(weights[left].sum()), int(sum(weights[left] * y[left]))
                    if ln < tree.least or n - ln < tree.least:
                        continue
                    gain = float((ls * n - s * ln) ** 2) / (ln * (n - ln) * n)
                    if gain > 0 and (best is None or gain > best[0] * (1 + 1e-12)):
                        best = (gain, int(f), (low + high) / 2)
        out[node] = (best[1], round(best[2], 9)) if best else (None, None), n, s / n / 100
        if best:
            right = x[at, best[1]] > best[2]
            grow(2 * node, at[~right])
            grow(2 * node + 1, at[right])

    grow(1, np.flatnonzero(weights))
    return out


def found(nodes, tree=0):
    return {
        r.node: ((r.feature, None if r.threshold is None else round(r.threshold, 9)), r.rows, r.value)
        for r in nodes.where(F.col("tree") == tree).collect()
    }


def equal(a, b):
    assert a.keys() == b.keys()
    for node in a:
        assert a[node][:2] == b[node][:2]
        assert a[node][2] == pytest.approx(b[node][2], rel=1e-12, abs=1e-9)


@pytest.fixture(scope="module")
def data():
    return rows()


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, SCHEMA).cache()


def grown(df, **settings):
    prepared = op.prepared_rows(df, "key", "label", "features")
    forest = op.trees_of({**SETTINGS, **settings}, prepared.width)
    return op.grow(prepared, forest), forest, prepared


def keys(df):
    return np.array([r[0] for r in df.orderBy("key").select(F.xxhash64("key")).collect()]).astype(np.uint64)


@pytest.mark.parametrize("depth", [0, 1, 3, 12])
def test_small_nodes_are_finished_exactly(df, data, depth):
    nodes, forest, _ = grown(df, maxDepth=depth)
    equal(found(nodes), brute(data, forest[0], np.ones(len(data), dtype=int)))


@pytest.mark.parametrize("small", [1, 40, 200])
def test_large_nodes_are_split_exactly(df, data, monkeypatch, small):
    """No node, some and most nodes above the bound, with few chunks and with many."""
    monkeypatch.setattr(op, "SMALL_ROWS", small)
    for chunks in (4, 1024):
        monkeypatch.setattr(op, "CHUNKS", chunks)
        nodes, forest, _ = grown(df, exactThresholds=True, maxDepth=4)
        equal(found(nodes), brute(data, forest[0], np.ones(len(data), dtype=int)))


def test_drawn_rows_and_features(df, data, monkeypatch):
    settings = dict(bootstrap=True, featureSubsetStrategy="0.5", numTrees=3, exactThresholds=True)
    nodes, forest, _ = grown(df, **settings)
    ids = keys(df)
    for number, tree in enumerate(forest):
        weights = op.draws(tree, ids)
        equal(found(nodes, number), brute(data, tree, weights))
    assert found(nodes, 0) != found(nodes, 1)
    monkeypatch.setattr(op, "SMALL_ROWS", 50)
    again, _, _ = grown(df, **settings)
    for number in range(3):
        equal(found(nodes, number), found(again, number))


def test_draws_are_poisson_and_features_even():
    tree = op.Tree(1, 2, 5, 1, 2, 3, True, False)
    drawn = op.draws(tree, np.arange(200_000, dtype=np.uint64))
    shares = np.bincount(drawn)[:4] / len(drawn)
    assert shares == pytest.approx([np.exp(-1), np.exp(-1), np.exp(-1) / 2, np.exp(-1) / 6], abs=0.005)
    chosen = op.tried(tree, np.arange(1, 5_001), 6)
    assert (np.diff(chosen, axis=1) > 0).all()
    assert np.bincount(chosen.ravel()) / 5_000 == pytest.approx([0.5] * 6, abs=0.03)


def test_bins_for_large_nodes(df, data, monkeypatch):
    """Few bins, one pass at a time: cuts lie between bins, and quality holds."""
    monkeypatch.setattr(op, "SMALL_ROWS", 100)
    monkeypatch.setattr(op, "PASS_CELLS", 1)
    nodes, _, prepared = grown(df, maxDepth=6, numTrees=2, bootstrap=True)
    cuts = {(f, round(float(c), 9)) for f, b in enumerate(prepared.bins) for c in b}
    big = nodes.where("rows > 100 and feature is not null").collect()
    assert big and all((r.feature, round(r.threshold, 9)) in cuts for r in big)
    scored = op.predict(df, nodes, "features", "p").select("label", "p").toPandas()
    assert ((scored.label - scored.p) ** 2).mean() < 0.2 * scored.label.var()


def test_values_that_no_bin_tells_apart(spark, monkeypatch):
    monkeypatch.setattr(op, "SMALL_ROWS", 10)
    monkeypatch.setattr(op, "BINS", 2)
    # The one cut between two bins leaves two rows on its right, which are too few.
    data = [(i, 1.0 if i < 190 else 9.0, [0.0 if i < 190 else 10.0 if i < 198 else 1e3]) for i in range(200)]
    nodes, _, _ = grown(spark.createDataFrame(data, SCHEMA), maxDepth=1)
    assert found(nodes)[1] == ((0, 5.0), 200, pytest.approx(1.4))


@pytest.mark.parametrize("small", [op.SMALL_ROWS, 60])
def test_layout_does_not_matter(df, monkeypatch, small):
    monkeypatch.setattr(op, "SMALL_ROWS", small)
    settings = dict(bootstrap=True, featureSubsetStrategy="0.5", numTrees=4, maxDepth=8)
    one, _, _ = grown(df.coalesce(1), **settings)
    other, _, _ = grown(df.repartition(7, F.rand(3)).sortWithinPartitions("label"), **settings)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, other.collect()), key=str)


def test_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    values = [nan, inf, -inf, 0.0, -0.0, 1.0, 5e-324, nan, inf, -inf, 1.7e308, -1.7e308]
    data = [(i, float(i % 5), [v, float(i % 2)]) for i, v in enumerate(values * 20)]
    data += [(1, None, [0.0, 0.0]), (None, 3.25, [2.0, 1.0])]
    df = spark.createDataFrame(data, SCHEMA)
    for small in (1, 10_000):
        op.SMALL_ROWS, before = small, op.SMALL_ROWS
        try:
            nodes, _, prepared = grown(df, exactThresholds=True, minInstancesPerNode=1, maxDepth=6)
        finally:
            op.SMALL_ROWS = before
        if small == 1:
            first = found(nodes)
        else:
            equal(first, found(nodes))
    assert prepared.count == 241
    numpy_way = op.predict(df, nodes, "features", "p").select("key", "p")
    by_joins = op.predict_by_joins(df, nodes, "features", "p").select("key", "p")
    assert sorted(numpy_way.collect(), key=str) == sorted(by_joins.collect(), key=str)


def test_refusals(spark, df):
    for data in ([], [(1, None, [1.0])]):
        with pytest.raises(ValueError, match="no row"):
            grown(spark.createDataFrame(data, SCHEMA))
    with pytest.raises(ValueError, match="same features"):
        grown(spark.createDataFrame([(1, 1.0, [1.0]), (2, 1.0, [1.0, 2.0])], SCHEMA))
    with pytest.raises(ValueError, match="finite"):
        grown(spark.createDataFrame([(1, float("inf"), [1.0])], SCHEMA))
    with pytest.raises(ValueError, match="variance"):
        grown(df, impurity="gini")
    with pytest.raises(ValueError, match="depth"):
        grown(df, maxDepth=99)


def test_equal_labels_give_one_leaf(spark):
    data = [(i, 7.1, [float(i)]) for i in range(100)]
    nodes, _, _ = grown(spark.createDataFrame(data, SCHEMA), maxDepth=5)
    assert found(nodes) == {1: ((None, None), 100, pytest.approx(7.1))}


def test_labels_that_are_not_decimal(spark):
    random = np.random.default_rng(4)
    data = [(i, float(random.normal() * 1e-7), [float(i % 9)]) for i in range(300)]
    nodes, _, _ = grown(spark.createDataFrame(data, SCHEMA), maxDepth=1)
    mean = np.mean([r[1] for r in data])
    assert found(nodes)[1][2] == pytest.approx(mean, abs=1e-15)


@pytest.mark.parametrize("most", [op.BROADCAST_ROWS, 0])
def test_joins_predict_what_arrays_do(df, most):
    nodes, _, _ = grown(df, numTrees=3, bootstrap=True, maxDepth=5)
    extra = df.withColumns({"tree": F.lit("x"), "node": F.lit("y"), "value": F.lit("z")})
    extra = extra.unionByName(extra.where("key < 3").withColumn("features", F.lit(None).cast("array<double>")))
    one = op.predict(extra, nodes, "features", "p")
    other = op.predict_by_joins(extra, nodes, "features", "p", max_lookup_rows=most)
    assert other.columns == one.columns
    a, b = (
        sorted((r.key, r.features is None, r.p if r.p is None else round(r.p, 9)) for r in d.collect())
        for d in (one, other)
    )
    assert a == b and sum(p is None for _, _, p in a) == 3
    assert op.predict(extra, nodes, "features", "p", max_nodes=2).count() == extra.count()


def test_out_of_bag_means(df, data):
    nodes, forest, _ = grown(df, numTrees=8, bootstrap=True)
    scored = {r.key: r.p for r in op.out_of_bag(df, nodes, forest, "key", "features", "p").collect()}
    ids = keys(df)
    one = {
        t: {r.key: r.p for r in op.predict(df, nodes.where(F.col("tree") == t), "features", "p").collect()}
        for t in range(8)
    }
    for i in range(0, len(data), 17):
        out = [one[t][i] for t, tree in enumerate(forest) if op.draws(tree, ids[i : i + 1])[0] == 0]
        assert scored[i] == (pytest.approx(np.mean(out)) if out else None)


def test_importance_adds_up_and_gains_match(df, data):
    nodes, _, _ = grown(df, maxDepth=3)
    gains = {r.node: r.gain for r in op.split_gains(nodes).collect()}
    y, x = np.array([r[1] for r in data]), np.array([r[2] for r in data])
    parts = found(nodes)
    left = x[:, parts[1][0][0]] <= parts[1][0][1]
    spread = sum(((y[s] - y[s].mean()) ** 2).sum() for s in (left, ~left))
    assert gains[1] == pytest.approx(((y - y.mean()) ** 2).sum() - spread)
    shares = {r.feature: r.importance for r in op.slot_importance(nodes).collect()}
    assert sum(shares.values()) == pytest.approx(1.0) and max(shares, key=shares.get) == 1
    leaf, _, _ = grown(df, maxDepth=0)
    assert op.slot_importance(leaf).count() == 0


def test_subset_sizes():
    for strategy, size in (("all", 9), ("0.5", 4), ("sqrt", 3), ("onethird", 3), ("2", 2), ("0.01", 1), ("50", 9)):
        assert op.subset_size(strategy, 9) == size


def jobs_of(spark, work):
    """How many jobs a piece of work starts."""
    context = spark.sparkContext
    context.setJobGroup(group := f"counted-{id(work)}", "")
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_more_trees_take_few_more_passes(spark, df, monkeypatch):
    monkeypatch.setattr(op, "SMALL_ROWS", 60)
    prepared = op.prepared_rows(df, "key", "label", "features")
    forest = op.trees_of({**SETTINGS, "maxDepth": 4, "numTrees": 12, "bootstrap": True}, prepared.width)
    together = jobs_of(spark, lambda: op.grow(prepared, forest))
    apart = sum(jobs_of(spark, lambda t=t: op.grow(prepared, [t])) for t in forest[:3])
    assert 0 < together < apart


def test_nodes_that_a_task_can_hold_take_no_pass(spark, df, monkeypatch):
    """The same forest whether large nodes are cut in passes or in tasks, in which depth starts no job."""
    monkeypatch.setattr(op, "SMALL_ROWS", 60)
    settings = dict(bootstrap=True, featureSubsetStrategy="0.5", numTrees=3, maxDepth=7)
    in_tasks, _, prepared = grown(df, **settings)
    shallow, deep = (op.trees_of({**SETTINGS, **settings, "maxDepth": d}, prepared.width) for d in (1, 7))
    work = [lambda f=f: op.grow(prepared, f) for f in (shallow, deep, deep)]
    jobs = [jobs_of(spark, w) for w in work[:2]]
    assert jobs[0] == jobs[1]
    monkeypatch.setattr(op, "TASK_ROWS", 0)
    assert jobs_of(spark, work[2]) > jobs[1]
    in_passes, _, _ = grown(df, **settings)
    assert sorted(map(tuple, in_tasks.collect()), key=str) == sorted(map(tuple, in_passes.collect()), key=str)


def test_large_nodes_in_tasks_that_no_bin_tells_apart(spark, monkeypatch):
    monkeypatch.setattr(op, "SMALL_ROWS", 10)
    monkeypatch.setattr(op, "BINS", 2)
    random = np.random.default_rng(8)
    data = [(i, float(i % 7 + 5 * (i > 380)), [float(i > 380) * i, float("nan") if i % 9 == 0 else random.normal()]) for i in range(400)]
    df = spark.createDataFrame(data, SCHEMA)
    in_tasks = found(grown(df, maxDepth=5)[0])
    monkeypatch.setattr(op, "TASK_ROWS", 0)
    equal(in_tasks, found(grown(df, maxDepth=5)[0]))


def test_trees_that_differ_in_depth_are_grown_once(df, monkeypatch):
    counted, grown_ = [], op._grown
    monkeypatch.setattr(op, "_grown", lambda rows, trees: counted.append(len(trees)) or grown_(rows, trees))
    monkeypatch.setattr(op, "SMALL_ROWS", 60)
    prepared = op.prepared_rows(df, "key", "label", "features")
    settings = {**SETTINGS, "bootstrap": True, "featureSubsetStrategy": "0.5"}
    forests = [
        op.trees_of({**settings, "numTrees": n, "maxDepth": d}, prepared.width) for n, d in ((3, 2), (2, 6), (1, 0))
    ]
    together = op.grow(prepared, [tree for forest in forests for tree in forest])
    first = 0
    for forest in forests:
        apart = op.grow(prepared, forest)
        for number in range(len(forest)):
            equal(found(together, first + number), found(apart, number))
        first += len(forest)
    assert counted == [3, 3, 2, 1]


def test_packed_rows_come_back():
    nan, inf = float("nan"), float("inf")
    x = np.array([[0.5, 3, 70_000, -0.0, 7, nan], [0.25, -4, -2, 1e300, 8, inf], [0.5, 40_000, 5, -inf, 7, 5e-324]])
    known = [np.array([0.25, 0.5]), *[np.zeros(0)] * 3, np.array([7.0]), np.array([1.0])]
    y = np.array([-(2**33), 0, 2**33])
    kinds, records = op._packed(y, x, known)
    assert kinds == "Biidhd"
    records["w"] = [1, 18, 2]
    other, more = op._packed(y[:1], x[:1], known)
    assert other != kinds
    more["w"] = 3
    w, back, columns = op._unpacked([kinds, other], [records.tobytes(), more.tobytes()], known)
    assert w.tolist() == [1, 18, 2, 3] and back.tolist() == [*y, y[0]]
    for f, column in enumerate(columns):
        values = column.values[column.code]
        assert np.array_equal(values, np.append(x[:, f], x[0, f]), equal_nan=True)
        assert (np.diff(column.values[~np.isnan(column.values)]) > 0).all()


def test_gains_of_large_nodes_do_not_overflow():
    """Rows times totals beyond 64 bits: the best cut is still the one that whole numbers find."""
    random = np.random.default_rng(3)
    n = np.full(40, 1_739_298)
    s = np.full(40, 29_000_000_000_000)
    left_n = random.integers(1, n[0], 40)
    left_s = random.integers(-(2**45), 2**45, 40)
    exact = [
        (int(a) * int(n[0]) - int(s[0]) * int(b)) ** 2 / (int(b) * (int(n[0]) - int(b)) * int(n[0]))
        for a, b in zip(left_s, left_n)
    ]
    assert op._gains(left_n, left_s, n, s) == pytest.approx(exact, rel=1e-9)
    # Each cut alone gives the same as all together.
    alone = [op._gains(*(c[i : i + 1] for c in (left_n, left_s, n, s)))[0] for i in range(40)]
    assert op._gains(left_n, left_s, n, s).tolist() == alone
    assert op._gains(left_n[:1], 3 * left_n[:1], n[:1], 3 * n[:1]).tolist() == [0.0]


def test_draws_by_whole_bounds():
    tree = op.Tree(9, 4, 5, 1, 2, 3, True, False)
    ids = np.arange(300_000, dtype=np.uint64)
    uniform = (op._mixed(ids ^ tree.salt) >> np.uint64(11)) * 2.0**-53
    expected = np.searchsorted(op.POISSON, uniform, side="right")
    rows, times = op.drawn(tree, ids)
    assert np.array_equal(rows, np.flatnonzero(expected)) and np.array_equal(times, expected[rows])
    assert np.array_equal(op.draws(tree, ids), expected)


def test_codes_lead_where_values_do():
    random = np.random.default_rng(6)
    x = np.round(random.normal(size=(500, 2)), 1)
    x[::7, 0], x[1::7, 1] = np.nan, np.inf
    bins = [np.array([-0.5, 0.0, 0.5]), np.array([0.25])]
    held = op.Held([0, 1])
    left, right = held.split(0, 0, 0.0, 1, 1)
    for thresholds, plain in (((0.25, 0.5), True), ((0.3, -0.7), False)):
        held.split(left, 1, thresholds[0], 1, 1)
        held.split(right, 0, thresholds[1], 1, 1)
        steps = op._steps(bins, held, 2)
        assert steps.plain is plain and steps.levels.tolist() == [2, 0]
        paths = op.Paths(*(np.array(c) for c in (held.feature, held.threshold, held.left)))
        rows = np.arange(0, 500, 3)
        codes = op._codes(steps.cuts, x)
        for tree in (0, 1):
            assert np.array_equal(steps.follow(codes, rows, tree, tree), paths.follow(x, rows, tree))


def test_only_lesser_children_are_summed(monkeypatch):
    random = np.random.default_rng(2)
    each = random.integers(1, 4, 4_000) + 1j * random.integers(-(2**33), 2**33, 4_000)
    code = random.integers(0, 3, 4_000).astype(np.uint8)
    first = op.Level(random.integers(0, 3, 4_000), 3, each, {}, np.zeros(0, dtype=np.int64))
    first.sums("f", code, 2)
    # Nodes 0 and 2 are split in unequal parts, node 1 has ended.
    child = np.array([0, 4, 2])[first.place] + (random.random(4_000) < np.array([0.1, 0, 0.8])[first.place])
    parents = np.array([0, 2])
    second = op.Level(child, 4, each, first.kept, parents)
    direct = op.Level(child, 4, each, {}, parents).sums("f", code, 2)
    summed = []
    monkeypatch.setattr(op, "np", SpyNumpy(summed))
    assert np.array_equal(second.sums("f", code, 2)[:4], direct[:4])
    assert 0 < sum(summed) < 0.2 * 4_000


class SpyNumpy:
    """NumPy, counting the rows that are added up."""

    def __init__(self, summed):
        self.add = type("add", (), {"at": lambda out, at, v: (summed.append(len(at)), np.add.at(out, at, v))})

    def __getattr__(self, name):
        return getattr(np, name)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_what_is_sent_is_freed(spark, df, monkeypatch):
    """The same forest in one turn and in many, of which each leaves nothing on the disk."""
    settings = dict(bootstrap=True, featureSubsetStrategy="0.5", numTrees=5, maxDepth=6)
    prepared = op.prepared_rows(df, "key", "label", "features")
    forest = op.trees_of({**SETTINGS, **settings}, prepared.width)
    packed = []
    monkeypatch.setattr(op, "_packed_rows", lambda rows, f=op._packed_rows: packed.append(f(rows)) or packed[-1])
    monkeypatch.setattr(op, "SMALL_ROWS", 60)
    monkeypatch.setattr(op, "TASK_ROWS", 200)
    before = shuffle_files(spark)
    at_once = op.grow(prepared, forest)
    monkeypatch.setattr(op, "SENT_ROWS", 300)
    turns = []
    monkeypatch.setattr(op, "_finished", lambda *a, f=op._finished: turns.append(a[-1]) or f(*a))
    in_turns = op.grow(prepared, forest)
    assert len(turns) > 3 and len({at for turn in turns for at in turn}) == sum(map(len, turns))
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert sorted(map(tuple, at_once.collect()), key=str) == sorted(map(tuple, in_turns.collect()), key=str)
    assert len(packed) == 2
    for table in packed:
        assert not any(os.path.exists(file.removeprefix("file://")) for file in table.inputFiles())


def test_hundredths_and_short_labels_are_packed_short():
    x = np.array([[0.1, 900.01, 1.005], [-7.25, -12.5, 2.0]])
    known = [np.zeros(0)] * 3
    kinds, records = op._packed(np.array([5, -6]), x, known)
    assert kinds == "scd" + op.SHORT_LABELS and records.dtype.itemsize == 1 + 4 + 2 + 4 + 8
    assert np.array_equal(op._features(kinds, records, known), x)
    records["w"] = 1
    _, y, columns = op._unpacked([kinds], [records.tobytes()], known)
    assert y.tolist() == [5, -6]
    assert all(np.array_equal(c.values[c.code], x[:, f]) for f, c in enumerate(columns))
