"""Regression trees as tables of nodes: grown by Spark, kept as rows, followed by joins (M1-M5, M7).

Nodes with many rows are split level by level, all trees of all settings in one pass: tasks sum
labels by bin, one aggregate merges them. The rows of a node that a task can hold go to one, packed,
which goes on by bins and finishes the nodes of few rows with exact thresholds; each such node is a
group of its own, of bounded size.

Labels are summed as whole numbers, draws are hashes of the row's key, and equal gains go to the
first feature and the least threshold. So a forest depends on its rows, its settings and its seed,
not on partitions or on the order of rows.
"""

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.plans.lookups import BROADCAST_ROWS, join_lookup, stored_lookup
from tallyhouse.plans.shared import dropped, shuffles_freed, written

# Tasks carry this module's code along, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A node of at most so many rows, repeats counted, is cut between any two of its values.
SMALL_ROWS = 16_384
# A node of at most so many rows, and values of all features, is finished in a task.
TASK_ROWS = 500_000
TASK_CELLS = 10_000_000
# Rows that a task of the last step gets in all, about, and bytes of features that are packed at a time.
PART_ROWS = 2_000_000
PACKED_BYTES = 8_000_000
# Rows, repeats counted, that are sent to tasks at a time; what they took on disk is freed before the next.
SENT_ROWS = 250_000_000
# A column whose sample has at most so many values is sent as their numbers.
CODED_VALUES = 256
# Bins of a column in a node beyond that bound, and chunks of its sorted values where cuts are exact.
BINS = 32
CHUNKS = 1024
# Cuts between bins come from the rows with the least hashes, up to so many.
SAMPLE_ROWS = 20_000
# Sums that a task holds in one pass; more open nodes take more passes.
PASS_CELLS = 4_000_000
# Nodes that the driver and the tasks may hold: those above the bound, or those of a whole model.
MAX_HELD_NODES = 4_000_000
MAX_MODEL_NODES = 8_000_000
# Labels are whole numbers of at most so many bits, so sums over a batch are exact as doubles.
LABEL_BITS = 34
BATCH_ROWS = 32_768
# Packed rows to a line of a table: longer values are costly to the JVM's garbage collection.
LINE_ROWS = 8_192
# Sums of so many rows, repeats counted, are exact as doubles.
EXACT_ROWS = 1_000_000
# Labels that are decimals of few places are summed exactly.
DECIMAL_SCALES = (1.0, 10.0, 100.0, 1_000.0, 10_000.0)
MAX_DEPTH = 50

NODES = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.LongType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("rows", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Tree:
    """One tree to grow: draws follow ``seed`` and ``number``, limits are those of its forest."""

    seed: int
    number: int
    depth: int
    least: int
    split: int
    features: int
    bootstrap: bool
    exact: bool

    @property
    def salt(self) -> np.uint64:
        pair = np.array([(self.seed << 20) + self.number], dtype=np.int64).astype(np.uint64)
        return _mixed(pair)[0]

    def ends(self, node: int, rows: int) -> bool:
        """True if a node is a leaf by depth or number of rows alone."""
        return node.bit_length() > self.depth or rows < self.enough

    @property
    def enough(self) -> int:
        """Rows that a node needs for a split."""
        return max(self.split, 2 * self.least)


def subset_size(strategy: str, width: int) -> int:
    """Features tried in a node: ``all``, ``sqrt``, ``onethird``, a share below 1 or a number."""
    if strategy == "all":
        return width
    if strategy in ("sqrt", "onethird"):
        return max(1, int(width**0.5 if strategy == "sqrt" else width / 3))
    number = float(strategy)
    if number <= 0:
        raise ValueError("The share of features must be above zero")
    return min(width, max(1, int(number * width) if number <= 1 and "." in strategy else int(number)))


def trees_of(settings: Mapping[str, object], width: int) -> list[Tree]:
    """The trees of one forest. Names of settings are those of Spark ML where it has them."""
    if settings.get("impurity", "variance") != "variance":
        raise ValueError("Regression trees split by variance")
    if not 0 <= settings["maxDepth"] <= MAX_DEPTH:
        raise ValueError(f"The depth must lie between 0 and {MAX_DEPTH}")
    return [
        Tree(
            seed=settings["seed"],
            number=number,
            depth=settings["maxDepth"],
            least=max(1, settings["minInstancesPerNode"]),
            split=settings.get("minInstancesToSplit", 2),
            features=subset_size(str(settings["featureSubsetStrategy"]), width),
            bootstrap=settings.get("bootstrap", True),
            exact=settings.get("exactThresholds", False),
        )
        for number in range(settings["numTrees"])
    ]


# --- draws ----------------------------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    """Well spread hashes of 64-bit values (the finalizer of SplitMix64)."""
    z = values + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


# Distribution function of a Poisson variable of mean one.
POISSON = np.cumsum(np.exp(-1) / np.cumprod(np.maximum(np.arange(18), 1), dtype=np.float64))


# The same as bounds of the 64-bit hash, whose upper 53 bits are the uniform draw.
DRAWN_FROM = np.array([int(np.ceil(p * 2.0**53)) << 11 for p in POISSON if p < 1], dtype=np.uint64)


def drawn(tree: Tree, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that the tree's sample holds, and how often it does."""
    if not tree.bootstrap:
        return np.arange(len(ids)), np.ones(len(ids), dtype=np.int64)
    hashes = _mixed(ids ^ tree.salt)
    rows = np.flatnonzero(hashes >= DRAWN_FROM[0])
    hashes = hashes.take(rows)
    times = np.ones(len(rows), dtype=np.int64)
    for bound in DRAWN_FROM[1:4]:
        times += hashes >= bound
    often = np.flatnonzero(hashes >= DRAWN_FROM[4])
    times[often] = np.searchsorted(DRAWN_FROM, hashes[often], side="right")
    return rows, times


def draws(tree: Tree, ids: np.ndarray) -> np.ndarray:
    """How often the tree's sample holds each row: Poisson draws with mean one."""
    times = np.zeros(len(ids), dtype=np.int64)
    rows, found = drawn(tree, ids)
    times[rows] = found
    return times


def tried(tree: Tree, nodes: np.ndarray, width: int) -> np.ndarray:
    """Features tried in each node, ascending."""
    if tree.features >= width:
        return np.tile(np.arange(width), (len(nodes), 1))
    of_node = _mixed(nodes.astype(np.uint64) ^ ~tree.salt)
    order = _mixed(of_node[:, None] + np.arange(width, dtype=np.uint64))
    return np.sort(np.argsort(order, axis=1, kind="stable")[:, : tree.features], axis=1)


# --- rows -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rows:
    """Training rows, written once: (id, y, x), and how whole labels turn back into labels."""

    table: DataFrame
    count: int
    width: int
    scale: float
    centre: int
    # Ascending cuts of each feature; ``x <= cut`` goes left.
    bins: list[np.ndarray]
    chunks: list[np.ndarray]
    # Values of each feature in the sample, ascending; empty where they are many.
    coded: list[np.ndarray]
    # The same rows packed (see ``PACKED``), while trees grow.
    packed: DataFrame | None = None

    def value(self, rows: np.ndarray, total: np.ndarray) -> np.ndarray:
        return (total / np.maximum(rows, 1) + self.centre) / self.scale


def _cuts(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most - 1`` cuts half way between neighbouring values, evenly spread by rank."""
    values = np.sort(values[~np.isnan(values)])
    if not len(values):
        return np.zeros(0)
    distinct = np.unique(values)
    if len(distinct) > most:
        places = np.linspace(0, len(values) - 1, most + 1).astype(np.int64)[1:]
        distinct = np.unique(values[places])
    return _between(distinct[:-1], distinct[1:])


def _between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Half way between two values, or the lower one where that is not below the upper."""
    with np.errstate(invalid="ignore", over="ignore"):
        middle = low + (high - low) / 2
    return np.where(middle < high, middle, low)


def _array(df: DataFrame, features: str) -> Column:
    """Features as an array, whether they are a vector or an array of numbers."""
    if isinstance(df.schema[features].dataType, T.ArrayType):
        return F.col(features).cast("array<double>")
    return vector_to_array(features)


def prepared_rows(df: DataFrame, key: str, label: str, features: str) -> Rows:
    """Rows with a label and features, written once, and the cuts of every feature.

    Rows without a label are left out; rows that repeat a key share their draws. A NaN feature
    counts as larger than any number. An infinite or NaN label, or no row at all, raises.
    """
    table = written(
        df.where(F.col(label).isNotNull()).select(
            F.xxhash64(key).alias("id"),
            F.col(label).cast("double").alias("y"),
            _array(df, features).alias("x"),
        ),
        "tree-rows",
    )
    y = F.col("y")
    found = table.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.size("x")).alias("least"),
        F.max(F.size("x")).alias("most"),
        F.min("y").alias("low"),
        F.max("y").alias("high"),
        *[F.bool_and(F.round(y * s) / s == y).alias(f"_{i}") for i, s in enumerate(DECIMAL_SCALES)],
    ).first()
    if not found["n"]:
        raise ValueError("There is no row with a label to learn from")
    if found["least"] != found["most"] or not found["most"] or found["least"] < 0:
        raise ValueError("Every row must have the same features, at least one")
    low, high = found["low"], found["high"]
    if not (np.isfinite(low) and np.isfinite(high)):
        raise ValueError("Labels must be finite")
    reach = max(abs(low), abs(high), high - low, 1e-300)
    scale = next(
        (s for i, s in enumerate(DECIMAL_SCALES) if found[f"_{i}"] and reach * s < 2.0**LABEL_BITS),
        2.0 ** (LABEL_BITS - 1 - int(np.ceil(np.log2(reach)))),
    )
    centre = round((low + high) / 2 * scale)
    whole_y = (F.round(y * F.lit(scale)) - F.lit(float(centre))).cast("bigint")
    table = table.withColumn("y", whole_y)
    sample = table.orderBy(F.xxhash64("id"), "y", "x").limit(SAMPLE_ROWS).select("x").collect()
    values = np.array([r["x"] for r in sample], dtype=np.float64)
    width = found["most"]
    seen = [np.unique(column[~np.isnan(column)]) + 0.0 for column in values.T]
    return Rows(
        table,
        found["n"],
        width,
        scale,
        centre,
        [_cuts(values[:, f], BINS) for f in range(width)],
        [_cuts(values[:, f], CHUNKS) for f in range(width)],
        [v if len(v) <= CODED_VALUES else v[:0] for v in seen],
    )


def _arrays(batches: Iterator[pa.RecordBatch], width: int, most: int = BATCH_ROWS) -> Iterator[tuple]:
    """(ids, whole labels, features) of at most ``most`` rows at a time, small batches together."""

    def joined():
        return tuple(np.concatenate(c) for c in zip(*held))

    held, count = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            part = batch.slice(start, most)
            if count + part.num_rows > most:
                yield joined()
                held, count = [], 0
            ids = part.column("id").to_numpy().astype(np.uint64)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            held.append((ids, part.column("y").to_numpy(), x))
            count += part.num_rows
    if held:
        yield joined()


# --- growing --------------------------------------------------------------------------------


class Held:
    """Nodes that the driver holds: those above the bound, and a model that fits.

    ``left`` is the place of the left child, the right one follows it; ``feature`` is -1 where a
    node has no children here.
    """

    def __init__(self, roots: Sequence[int]):
        self.tree = list(roots)
        self.node = [1] * len(roots)
        self.feature = [-1] * len(roots)
        self.threshold = [np.nan] * len(roots)
        self.left = [-1] * len(roots)
        self.rows = [0] * len(roots)
        self.total = [0] * len(roots)

    def split(self, at: int, feature: int, threshold: float, rows: int, total: int) -> tuple[int, int]:
        """Give a node two children; ``rows`` and ``total`` are those of the left one."""
        left = len(self.node)
        self.feature[at], self.threshold[at], self.left[at] = feature, threshold, left
        for side in (0, 1):
            self.tree.append(self.tree[at])
            self.node.append(2 * self.node[at] + side)
            self.feature.append(-1)
            self.threshold.append(np.nan)
            self.left.append(-1)
        self.rows += [rows, self.rows[at] - rows]
        self.total += [total, self.total[at] - total]
        if len(self.node) > MAX_HELD_NODES:
            raise ValueError(f"More than {MAX_HELD_NODES} nodes of more than {SMALL_ROWS} rows")
        return left, left + 1


@dataclass(frozen=True)
class Paths:
    """Nodes in arrays, to follow rows through."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray

    def follow(self, x: np.ndarray, rows: np.ndarray, root: int) -> np.ndarray:
        """Place of the last node on the way of each given row."""
        at, live, here = np.full(len(rows), root), None, np.full(len(rows), root)
        values, start = x.ravel(), rows * x.shape[1]
        while len(here):
            feature = self.feature.take(here)
            inner = feature >= 0
            if not inner.all():
                if live is None:
                    live, at = np.flatnonzero(inner), here
                else:
                    at[live] = here
                    live = live[inner]
                here, feature, start = here[inner], feature[inner], start[inner]
            right = ~(values.take(start + feature) <= self.threshold.take(here))
            here = self.left.take(here) + right
        return at


@dataclass(frozen=True)
class Steps:
    """Nodes of growing trees in arrays, to follow coded rows through: a row's code counts the cuts
    below its value, and it goes right where its code is above ``last``. Leaves lead to themselves."""

    cuts: list[np.ndarray]
    # Whether all cuts are those between bins.
    plain: bool
    feature: np.ndarray
    last: np.ndarray
    left: np.ndarray
    levels: np.ndarray

    def follow(self, codes: np.ndarray, rows: np.ndarray, tree: int, root: int) -> np.ndarray:
        """Place of the last node on the way of each given row of a tree."""
        at, flat, start = np.full(len(rows), root), codes.ravel(), rows * codes.shape[1]
        for _ in range(self.levels[tree]):
            at = self.left.take(at) + (flat.take(start + self.feature.take(at)) > self.last.take(at))
        return at


def _code_type(cuts: list[np.ndarray]) -> np.dtype:
    """The smallest type for the codes of all columns and one more."""
    return np.min_scalar_type(max(map(len, cuts)) + 1)


def _codes(cuts: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """How many cuts lie below each value; all do for NaN."""
    codes = np.empty(x.shape, dtype=_code_type(cuts))
    for f, own in enumerate(cuts):
        codes[:, f] = np.searchsorted(own, x[:, f], side="left")
    return codes


def _steps(bins: list[np.ndarray], held: Held, trees: int) -> Steps:
    feature, threshold, left = np.array(held.feature), np.array(held.threshold), np.array(held.left)
    inner = np.flatnonzero(feature >= 0)
    cuts, plain = [], True
    for f, own in enumerate(bins):
        more = np.setdiff1d(threshold[inner[feature[inner] == f]], own)
        plain &= not len(more)
        cuts.append(np.union1d(own, more) if len(more) else own)
    kind = _code_type(cuts)
    last = np.full(len(feature), np.iinfo(kind).max, dtype=kind)
    for f, own in enumerate(cuts):
        at = inner[feature[inner] == f]
        last[at] = np.searchsorted(own, threshold[at], side="left")
    levels = np.zeros(trees, dtype=np.int64)
    depth = np.frexp(np.array(held.node, dtype=np.float64))[1] - 1
    np.maximum.at(levels, np.array(held.tree), depth)
    ends = feature < 0
    return Steps(
        cuts, plain, np.where(ends, 0, feature), last, np.where(ends, np.arange(len(left)), left), levels
    )


def _gains(left_n, left_s, n, s):
    """Decrease of the sum of squares by a cut: zero, exactly, where both sides have one mean and
    products of rows and totals are below 2^62; beyond that, products are taken as doubles."""
    off = (left_s * n - s * left_n).astype(np.float64)
    wide = np.maximum(np.abs(s), np.abs(left_s)).astype(np.float64) * n >= 2.0**62
    if wide.any():
        off = np.where(wide, left_s.astype(np.float64) * n - s.astype(np.float64) * left_n, off)
    return off * off / ((left_n * (n - left_n)).astype(np.float64) * n)


@dataclass(frozen=True)
class Steps:
    """Nodes of growing trees in arrays, to follow coded rows through: a row's code counts the cuts
    below its value, and it goes right where its code is above ``last``. Leaves lead to themselves."""

    cuts: list[np.ndarray]
    # Whether all cuts are those between bins.
    plain: bool
    feature: np.ndarray
    last: np.ndarray
    left: np.ndarray
    levels: np.ndarray

    def follow(self, codes: np.ndarray, rows: np.ndarray, tree: int, root: int) -> np.ndarray:
        """Place of the last node on the way of each given row of a tree."""
        at, flat, start = np.full(len(rows), root), codes.ravel(), rows * codes.shape[1]
        for _ in range(self.levels[tree]):
            at = self.left.take(at) + (flat.take(start + self.feature.take(at)) > self.last.take(at))
        return at


def _code_type(cuts: list[np.ndarray]) -> np.dtype:
    """The smallest type for the codes of all columns and one more."""
    return np.min_scalar_type(max(map(len, cuts)) + 1)


def _codes(cuts: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """How many cuts lie below each value; all do for NaN."""
    codes = np.empty(x.shape, dtype=_code_type(cuts))
    for f, own in enumerate(cuts):
        codes[:, f] = np.searchsorted(own, x[:, f], side="left")
    return codes


def _steps(bins: list[np.ndarray], held: Held, trees: int) -> Steps:
    feature, threshold, left = np.array(held.feature), np.array(held.threshold), np.array(held.left)
    inner = np.flatnonzero(feature >= 0)
    cuts, plain = [], True
    for f, own in enumerate(bins):
        more = np.setdiff1d(threshold[inner[feature[inner] == f]], own)
        plain &= not len(more)
        cuts.append(np.union1d(own, more) if len(more) else own)
    kind = _code_type(cuts)
    last = np.full(len(feature), np.iinfo(kind).max, dtype=kind)
    for f, own in enumerate(cuts):
        at = inner[feature[inner] == f]
        last[at] = np.searchsorted(own, threshold[at], side="left")
    levels = np.zeros(trees, dtype=np.int64)
    depth = np.frexp(np.array(held.node, dtype=np.float64))[1] - 1
    np.maximum.at(levels, np.array(held.tree), depth)
    ends = feature < 0
    return Steps(
        cuts, plain, np.where(ends, 0, feature), last, np.where(ends, np.arange(len(left)), left), levels
    )


def _gains(left_n, left_s, n, s):
    """Decrease of the sum of squares by a cut: zero, exactly, where both sides have one mean."""
    wide = float(max(np.abs(s).max(initial=0), np.abs(left_s).max(initial=0))) * n.max(initial=0) >= 2.0**62
    if wide:
        left_s, s = left_s.astype(np.float64), s.astype(np.float64)
    off = (left_s * n - s * left_n).astype(np.float64)
    return off * off / ((left_n * (n - left_n)).astype(np.float64) * n)


def _open_rows(trees, steps, roots, slots, ids, codes):
    """For each tree: (tree, rows, draws, slot of each row) of rows in its open nodes."""
    for g, tree in enumerate(trees):
        if roots[g] < 0:
            continue
        rows, weight = drawn(tree, ids)
        slot = slots.take(steps.follow(codes, rows, g, roots[g]))
        inside = slot >= 0
        if not inside.all():
            rows, weight, slot = rows[inside], weight[inside], slot[inside]
        if len(rows):
            yield g, rows, weight, slot


def _slots(held: Held, trees: list[Tree], opened: list[int]):
    """Numbers of the open nodes within their trees, and the features tried in each."""
    slots = np.full(len(held.node), -1)
    of_tree: dict[int, list[int]] = {}
    for at in opened:
        places = of_tree.setdefault(held.tree[at], [])
        slots[at] = len(places)
        places.append(at)
    roots = np.array([g if g in of_tree else -1 for g in range(len(trees))])
    return slots, of_tree, roots


BEST = T.StructType(
    [
        T.StructField("at", T.LongType()),
        T.StructField("gain", T.DoubleType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("left_rows", T.LongType()),
        T.StructField("left_total", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("total", T.LongType()),
    ]
)


def _best(found: DataFrame) -> list:
    """The best cut of each node: largest gain, then first feature, then least threshold."""
    order = F.struct("gain", -F.col("feature"), -F.col("threshold"))
    return found.groupBy("at").agg(F.max_by(F.struct(*BEST.names[1:]), order).alias("best")).select(
        "at", "best.*"
    ).collect()


def _by_bins(rows: Rows, trees: list[Tree], held: Held, opened: list[int]) -> list:
    """Best cuts of open nodes among the cuts between bins."""
    width, bins, coded = rows.width, rows.bins, rows.coded
    steps = _steps(bins, held, len(trees))
    size = max(map(len, bins)) + 1
    slots, of_tree, roots = _slots(held, trees, opened)
    sets = {g: tried(trees[g], np.array([held.node[at] for at in places]), width) for g, places in of_tree.items()}
    least = np.array([trees[g].least for g in held.tree])
    schema = T.StructType(
        [
            T.StructField("at", T.LongType()),
            T.StructField("feature", T.IntegerType()),
            T.StructField("n", T.ArrayType(T.LongType())),
            T.StructField("s", T.ArrayType(T.LongType())),
        ]
    )

    def sums(batches):
        # Rows are summed as the real part of a number, labels as its imaginary part, in one step.
        both = {g: np.zeros(chosen.size * size, dtype=np.complex128) for g, chosen in sets.items()}
        count, total = ({g: np.zeros(chosen.size * size, dtype=np.int64) for g, chosen in sets.items()} for _ in "ns")
        held_rows = dict.fromkeys(sets, 0)

        def settle(g):
            count[g] += both[g].real.astype(np.int64)
            total[g] += both[g].imag.astype(np.int64)
            both[g][:] = 0
            held_rows[g] = 0

        for ids, kinds, records, binned in _pieces(batches, bins):
            codes = binned if steps.plain else _codes(steps.cuts, _features(kinds, records, coded))
            flat, y = binned.ravel(), records["y"].astype(np.float64)
            for g, row, weight, slot in _open_rows(trees, steps, roots, slots, ids, codes):
                more = int(weight.sum())
                if held_rows[g] + more > EXACT_ROWS:
                    settle(g)
                held_rows[g] += more
                each = np.empty(len(row), dtype=np.complex128)
                each.real, each.imag = weight, weight * y.take(row)
                first, start = slot * (sets[g].shape[1] * size), row * width
                for j, feature in enumerate(sets[g].T):
                    code = flat.take(start + feature.take(slot))
                    np.add.at(both[g], first + j * size + code, each)
        for g, chosen in sets.items():
            settle(g)
            n = count[g].reshape(-1, size)
            some = np.flatnonzero(n.any(axis=1))
            ends = pa.array((np.arange(len(some) + 1) * size).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(of_tree[g]), chosen.shape[1])[some]),
                    pa.array(chosen.ravel()[some].astype(np.int32)),
                    pa.ListArray.from_arrays(ends, pa.array(n[some].ravel())),
                    pa.ListArray.from_arrays(ends, pa.array(total[g].reshape(-1, size)[some].ravel())),
                ],
                names=schema.names,
            )

    def cuts(batches):
        for batch in batches:
            at, feature = batch.column("at").to_numpy(), batch.column("feature").to_numpy()
            n, s = (
                np.stack([batch.column(f"{c}{i}").to_numpy() for i in range(size)], axis=1)
                for c in "ns"
            )
            left_n, left_s = n.cumsum(axis=1), s.cumsum(axis=1)
            n, s = left_n[:, -1:], left_s[:, -1:]
            left_n, left_s = left_n[:, :-1], left_s[:, :-1]
            few = least[at][:, None]
            allowed = (left_n >= few) & (n - left_n >= few)
            gain = np.full(left_n.shape, -1.0)
            whole = np.broadcast_to(n, left_n.shape), np.broadcast_to(s, left_n.shape)
            gain[allowed] = _gains(left_n[allowed], left_s[allowed], whole[0][allowed], whole[1][allowed])
            # A column that has no cut at all keeps its node's sums.
            gain = np.concatenate([gain, np.full((len(at), 1), -1.0)], axis=1)
            best = gain.argmax(axis=1)
            line = np.arange(len(at))
            cut = np.minimum(best, size - 2) if size > 1 else best
            threshold = [bins[f][c] if c < len(bins[f]) else np.nan for f, c in zip(feature, best)]
            if size > 1:
                sides = left_n[line, cut], left_s[line, cut]
            else:
                sides = n[:, 0], s[:, 0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(at),
                    pa.array(gain[line, best]),
                    pa.array(feature),
                    pa.array(threshold, pa.float64()),
                    *(pa.array(c) for c in (*sides, n[:, 0], s[:, 0])),
                ],
                names=BEST.names,
            )

    summed = rows.packed.mapInArrow(sums, schema).groupBy("at", "feature").agg(
        *[F.sum(F.col(c)[i]).alias(f"{c}{i}") for c in "ns" for i in range(size)]
    )
    return _best(summed.mapInArrow(cuts, BEST))


def _exactly(rows: Rows, trees: list[Tree], held: Held, opened: list[int]) -> list:
    """Best cuts of open nodes among all cuts between neighbouring values of a node.

    The values of a column are summed up in sorted chunks, then within each chunk: prefix sums
    over any number of values, in which no window holds more than a chunk or all chunks.
    """
    width, chunks, steps = rows.width, rows.chunks, _steps(rows.bins, held, len(trees))
    slots, of_tree, roots = _slots(held, trees, opened)
    sets = {g: tried(trees[g], np.array([held.node[at] for at in places]), width) for g, places in of_tree.items()}
    schema = T.StructType(
        [
            T.StructField("at", T.LongType()),
            T.StructField("feature", T.IntegerType()),
            T.StructField("chunk", T.IntegerType()),
            T.StructField("v", T.DoubleType()),
            T.StructField("n", T.LongType()),
            T.StructField("s", T.LongType()),
            T.StructField("few", T.IntegerType()),
        ]
    )

    def sums(batches):
        for ids, y, x in _arrays(batches, width):
            for g, row, weight, slot in _open_rows(trees, steps, roots, slots, ids, _codes(steps.cuts, x)):
                allowed = np.zeros((len(of_tree[g]), width), dtype=bool)
                np.put_along_axis(allowed, sets[g], True, axis=1)
                places = np.array(of_tree[g])
                for f in range(width):
                    here = allowed[slot, f]
                    r, v, p = row[here], x[row[here], f] + 0.0, slot[here]
                    if not len(r):
                        continue
                    order = np.lexsort((v, p))
                    r, v, p = r[order], v[order], p[order]
                    w = weight[here][order]
                    # Two NaN are one value here.
                    same = (v[1:] == v[:-1]) | (np.isnan(v[1:]) & np.isnan(v[:-1]))
                    first = np.flatnonzero(np.concatenate(([True], ~same | (p[1:] != p[:-1]))))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(places[p[first]]),
                            pa.array(np.full(len(first), f, dtype=np.int32)),
                            pa.array(np.searchsorted(chunks[f], v[first], side="left").astype(np.int32)),
                            pa.array(v[first]),
                            pa.array(np.add.reduceat(w, first)),
                            pa.array(np.add.reduceat(w * y[r], first)),
                            pa.array(np.full(len(first), trees[g].least, dtype=np.int32)),
                        ],
                        names=schema.names,
                    )

    values = (
        rows.table.mapInArrow(sums, schema)
        .groupBy("at", "feature", "chunk", "v")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("few").alias("few"))
    )
    values = written(values, "tree-values")
    column, chunk = ["at", "feature"], ["at", "feature", "chunk"]
    across = Window.partitionBy(*column).orderBy("chunk")
    ahead = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*column)
    zero = F.lit(0).cast("bigint")
    by_chunk = (
        values.groupBy(*chunk)
        .agg(F.sum("n").alias("_n"), F.sum("s").alias("_s"), F.min("v").alias("_v"))
        .select(
            *chunk,
            F.coalesce(F.sum("_n").over(ahead), zero).alias("before_n"),
            F.coalesce(F.sum("_s").over(ahead), zero).alias("before_s"),
            F.lead("_v").over(across).alias("next_v"),
            F.sum("_n").over(whole).alias("rows"),
            F.sum("_s").over(whole).alias("total"),
        )
    )
    within = Window.partitionBy(*chunk).orderBy("v")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = values.join(by_chunk, chunk).select(
        *column,
        "v",
        "few",
        "rows",
        "total",
        (F.col("before_n") + F.sum("n").over(upto)).alias("left_rows"),
        (F.col("before_s") + F.sum("s").over(upto)).alias("left_total"),
        F.coalesce(F.lead("v").over(within), "next_v").alias("after"),
    )
    right_rows = F.col("rows") - F.col("left_rows")
    allowed = F.col("after").isNotNull() & (F.col("left_rows") >= F.col("few")) & (right_rows >= F.col("few"))

    def wide(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    off = (wide("left_total") * wide("rows") - wide("total") * wide("left_rows")).cast("double")
    sides = (F.col("left_rows") * right_rows).cast("double") * F.col("rows")
    middle = F.col("v") + (F.col("after") - F.col("v")) / 2
    found = left.select(
        "at",
        F.when(allowed, off * off / sides).otherwise(-1.0).alias("gain"),
        "feature",
        F.when(allowed, F.when(middle < F.col("after"), middle).otherwise(F.col("v"))).alias("threshold"),
        "left_rows",
        "left_total",
        "rows",
        "total",
    )
    return _best(found)


# Kinds of packed values: numbers of known values, short and long whole numbers, short and long
# hundredths, doubles.
KINDS = {"B": "u1", "h": "i2", "i": "i4", "s": "i2", "c": "i4", "d": "f8"}
# A letter behind those of the features: labels are long.
SHORT_LABELS = "-"


def _record(kinds: str) -> np.dtype:
    """A packed row: draws, whole label, and each feature as its kind says."""
    label = "i4" if kinds.endswith(SHORT_LABELS) else "i8"
    features = [(f"x{f}", KINDS[kind]) for f, kind in enumerate(kinds.rstrip(SHORT_LABELS))]
    return np.dtype([("w", "u1"), ("y", label), *features])


def _kind(column: np.ndarray, coded: np.ndarray) -> tuple[str, np.ndarray]:
    """The smallest of the kinds that keeps a column as it is, and the numbers to keep."""
    if len(coded):
        code = np.searchsorted(coded, column).clip(max=len(coded) - 1)
        if (coded[code] == column).all():
            return "B", code
    with np.errstate(invalid="ignore", over="ignore"):
        for scale, short, long in ((1.0, "h", "i"), (100.0, "s", "c")):
            whole = np.rint(column * scale)
            reach = np.abs(whole).max(initial=0)
            if reach < 2**31 and (whole / scale == column).all():
                return (short if reach < 2**15 else long), whole
    return "d", column


def _packed(y: np.ndarray, x: np.ndarray, coded: list[np.ndarray]) -> tuple[str, np.ndarray]:
    """Kinds of the features, one letter each, and the rows as records; draws are left open."""
    columns = [_kind(x[:, f] + 0.0, coded[f]) for f in range(x.shape[1])]
    kinds = "".join(kind for kind, _ in columns)
    if np.abs(y).max(initial=0) < 2**31:
        kinds += SHORT_LABELS
    records = np.empty(len(y), dtype=_record(kinds))
    records["y"] = y
    for f, (_, column) in enumerate(columns):
        records[f"x{f}"] = column
    return kinds, records


def _values(kind: str, column: np.ndarray, known: np.ndarray) -> np.ndarray:
    """A packed column as it was."""
    if kind == "B":
        return known[column]
    return column / 100.0 if kind in "sc" else column.astype(np.float64)


def _features(kinds: str, records: np.ndarray, coded: list[np.ndarray]) -> np.ndarray:
    return np.stack([_values(kinds[f], records[f"x{f}"], known) for f, known in enumerate(coded)], axis=1)


PACKED = T.StructType(
    [
        T.StructField("ids", T.BinaryType()),
        T.StructField("kinds", T.StringType()),
        T.StructField("records", T.BinaryType()),
        T.StructField("bins", T.BinaryType()),
    ]
)


def _packed_rows(rows: Rows) -> DataFrame:
    """All rows, many to a line: hashes of keys, records without draws, and numbers of bins."""
    width, bins, coded = rows.width, rows.bins, rows.coded
    most = min(LINE_ROWS, max(1, PACKED_BYTES // (8 * width)))

    def pack(batches):
        for ids, y, x in _arrays(batches, width, most):
            kinds, records = _packed(y, x, coded)
            line = [[ids.tobytes()], [kinds], [records.tobytes()], [_codes(bins, x).tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in line], names=PACKED.names)

    return written(rows.table.mapInArrow(pack, PACKED), "tree-packed")


def _pieces(batches: Iterator[pa.RecordBatch], bins: list[np.ndarray]) -> Iterator[tuple]:
    """(ids, kinds, records, numbers of bins) of packed lines, those alike together."""

    def joined():
        ids, records, codes = (b"".join(c) for c in zip(*held))
        codes = np.frombuffer(codes, _code_type(bins)).reshape(-1, len(bins))
        return np.frombuffer(ids, np.uint64), kind, np.frombuffer(records, _record(kind)), codes

    held, kind, count = [], "", 0
    for batch in batches:
        for ids, kinds, records, codes in zip(*(batch.column(c).to_pylist() for c in PACKED.names)):
            more = len(ids) // 8
            if held and (kinds != kind or count + more > BATCH_ROWS):
                yield joined()
                held, count = [], 0
            held.append((ids, records, codes))
            kind, count = kinds, count + more
    if held:
        yield joined()


SHIPPED = T.StructType(
    [
        T.StructField("at", T.LongType()),
        T.StructField("kinds", T.StringType()),
        T.StructField("packed", T.BinaryType()),
    ]
)


@dataclass
class Slot:
    """A feature of a node's rows: its values, ascending and NaN last, and the place of each row's."""

    values: np.ndarray
    code: np.ndarray


def _unpacked(kinds: list[str], packed: list[bytes], coded: list[np.ndarray]) -> tuple:
    """(draws, whole labels, columns) of the rows that were packed in any number of pieces."""
    pieces: dict[str, list[bytes]] = {}
    for kind, rows in zip(kinds, packed):
        pieces.setdefault(kind, []).append(rows)
    records = [(kind, np.frombuffer(b"".join(rows), _record(kind))) for kind, rows in pieces.items()]
    w, y = (np.concatenate([r[c] for _, r in records]).astype(np.int64) for c in "wy")
    columns = []
    for f, known in enumerate(coded):
        own = {kind[f] for kind, _ in records}
        if own == {"B"}:
            columns.append(Slot(known, np.concatenate([r[f"x{f}"] for _, r in records])))
        elif own <= {*"hi"} or own <= {*"sc"}:
            slot = _coded(np.concatenate([r[f"x{f}"] for _, r in records]))
            columns.append(Slot(slot.values / (100.0 if own <= {*"sc"} else 1.0), slot.code))
        else:
            columns.append(_coded(np.concatenate([_values(kind[f], r[f"x{f}"], known) for kind, r in records])))
    return w, y, columns


def _coded(values: np.ndarray) -> Slot:
    if values.dtype.kind == "i" and len(values):
        low, high = int(values.min()), int(values.max())
        if high - low < 8 * len(values) + CODED_VALUES:
            seen = np.zeros(high - low + 1, dtype=bool)
            place = values.astype(np.int64) - low
            seen[place] = True
            code = (np.cumsum(seen, dtype=np.int32) - 1).take(place)
            return Slot((np.flatnonzero(seen) + low).astype(np.float64), code)
    order = np.argsort(values)
    v = values[order].astype(np.float64)
    # Two NaN are one value here.
    first = np.concatenate(([True], (v[1:] != v[:-1]) & ~np.isnan(v[:-1])))
    code = np.empty(len(v), dtype=np.int32)
    code[order] = first.cumsum() - 1
    return Slot(v[first], code)


def _first_in_runs(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


class Level:
    """The rows of one level's nodes: their places, the last one for rows of ended nodes, and draws
    with drawn labels as real and imaginary parts, which one step sums.

    Of two children only the lesser one is summed where the sums of their parent were kept; those of
    the other are the rest, exactly, as all sums are whole.
    """

    def __init__(self, place: np.ndarray, nodes: int, each: np.ndarray, kept: dict, parents: np.ndarray):
        self.place, self.nodes, self.each = place, nodes, each
        self.kept_before, self.parents = kept, parents
        self.kept: dict[object, np.ndarray] = {}
        self.shifted: dict[int, np.ndarray] = {}
        both = np.zeros(nodes + 1, dtype=np.complex128)
        np.add.at(both, place, each)
        self.n, self.s = _whole(both[:-1])
        self.lesser = None

    def _lesser_rows(self) -> tuple:
        """(rows of the lesser children, their pairs, draws and labels, and the places of those children)."""
        if self.lesser is None:
            child = 2 * np.arange(len(self.parents)) + (self.n[1::2] < self.n[::2])
            chosen = np.zeros(self.nodes + 1, dtype=bool)
            chosen[child] = True
            row = np.flatnonzero(chosen.take(self.place))
            self.lesser = row, self.place.take(row) >> 1, self.each.take(row), child
        return self.lesser

    def sums(self, of: object, code: np.ndarray, bits: int) -> np.ndarray:
        """Sums by node and code of the column ``of``, each node's in a row of its own."""
        few = self.nodes << bits <= len(code) // 16
        if few and of in self.kept_before:
            row, pair, each, child = self._lesser_rows()
            part = np.zeros(len(self.parents) << bits, dtype=np.complex128)
            np.add.at(part, (pair << bits) + code.take(row), each)
            part = part.reshape(-1, 1 << bits)
            found = np.zeros((self.nodes + 1, 1 << bits), dtype=np.complex128)
            found[child] = part
            found[child ^ 1] = self.kept_before[of][self.parents] - part
        else:
            if bits not in self.shifted:
                self.shifted[bits] = self.place << bits
            found = np.zeros((self.nodes + 1) << bits, dtype=np.complex128)
            np.add.at(found, self.shifted[bits] + code, self.each)
            found = found.reshape(-1, 1 << bits)
        if few:
            self.kept[of] = found
        return found


def _whole(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return both.real.astype(np.int64), both.imag.astype(np.int64)


def _ordered(level: Level, of: object, code: np.ndarray, size: int, mine: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place among given nodes, code, rows, total), by place and code: one line for equal ones where
    codes are few."""
    bits = (size - 1).bit_length()
    if (level.nodes + 1) << bits <= 2 * len(code) + CODED_VALUES:
        both = level.sums(of, code, bits)[mine].ravel()
        some = np.flatnonzero(both.real)
        return some >> bits, some & (1 << bits) - 1, *_whole(both[some])
    slots = np.full(level.nodes + 1, -1)
    slots[mine] = np.arange(len(mine))
    slot = slots.take(level.place)
    row = np.flatnonzero(slot >= 0)
    key = (slot.take(row) << bits) + code.take(row)
    if len(mine) << bits <= 2 * len(row) + CODED_VALUES:
        both = np.zeros(len(mine) << bits, dtype=np.complex128)
        np.add.at(both, key, level.each.take(row))
        some = np.flatnonzero(both.real)
        return some >> bits, some & (1 << bits) - 1, *_whole(both[some])
    low = len(code).bit_length()
    if (len(mine) << bits).bit_length() + low < 63:
        # Sorted as one number each: node, code and row.
        key = np.sort((key << low) | row)
        row, key = key & (1 << low) - 1, key >> low
    else:
        order = np.argsort(key, kind="stable")
        row, key = row[order], key[order]
    return key >> bits, key & (1 << bits) - 1, *_whole(level.each.take(row))


def _searched(
    level: Level,
    codes: np.ndarray,
    values: list[np.ndarray],
    allowed: np.ndarray,
    least: int,
    binned: bool,
) -> tuple:
    """(gain, feature, threshold) of the best cut of each node: among those between its values, or,
    where codes are the numbers of bins and ``values`` their cuts, among those between bins."""
    k, n, s = level.nodes, level.n, level.s
    gain, feature, threshold = np.zeros(k), np.full(k, -1), np.full(k, np.nan)
    for f in np.flatnonzero(allowed.any(axis=0)):
        mine = np.flatnonzero(allowed[:, f])
        p, code, each_n, each_s = _ordered(level, (f, binned), codes[f], len(values[f]) + binned, mine)
        cut = np.flatnonzero((p[1:] == p[:-1]) & (code[:-1] != code[1:]))
        if not len(cut):
            continue
        first = _first_in_runs(p)
        sums_n, sums_s = each_n.cumsum(), each_s.cumsum()
        before_n, before_s = np.zeros(len(mine), dtype=np.int64), np.zeros(len(mine), dtype=np.int64)
        before_n[p[first]] = sums_n[first] - each_n[first]
        before_s[p[first]] = sums_s[first] - each_s[first]
        at = mine[p[cut]]
        left_n, left_s = sums_n[cut] - before_n[p[cut]], sums_s[cut] - before_s[p[cut]]
        enough = (left_n >= least) & (n[at] - left_n >= least)
        cut, at, left_n, left_s = cut[enough], at[enough], left_n[enough], left_s[enough]
        if not len(cut):
            continue
        gains = _gains(left_n, left_s, n[at], s[at])
        runs = _first_in_runs(at)
        best = np.zeros(k)
        best[at[runs]] = np.maximum.reduceat(gains, runs)
        top = np.flatnonzero(gains == best[at])
        top = top[_first_in_runs(at[top])]
        top = top[gains[top] > gain[at[top]]]
        low, high = code[cut[top]], code[cut[top] + 1]
        gain[at[top]], feature[at[top]] = gains[top], f
        threshold[at[top]] = values[f][low] if binned else _between(values[f][low], values[f][high])
    return gain, feature, threshold


def finish(
    tree: Tree,
    root: int,
    size: int,
    w: np.ndarray,
    y: np.ndarray,
    columns: list[Slot],
    bins: list[np.ndarray],
) -> tuple:
    """The subtree below a node from its rows: (node, feature, threshold, rows, total) arrays.

    Each level sums labels by node and value for all its nodes together, or by node and bin for
    those of many rows. A node that no cut between bins splits is searched exactly. ``size`` is what
    the first node counts as; for the root of a tree that is all rows, drawn or not.
    """
    width, count = len(columns), len(w)
    values = [c.values for c in columns]
    codes = np.empty((width, count), dtype=np.min_scalar_type(max(map(len, values))))
    for f, column in enumerate(columns):
        codes[f] = column.code
    # Sums stay far below 2^53, so they are exact as doubles.
    each = np.empty(count, dtype=np.complex128)
    each.real, each.imag = w, w * y
    binned = None
    place = np.zeros(count, dtype=np.int64)
    nodes = np.array([root], dtype=np.int64)
    kept, inner, out = {}, np.zeros(0, dtype=np.int64), []
    while len(nodes):
        k = len(nodes)
        level = Level(place, k, each, kept, inner)
        n, s, kept = level.n, level.s, level.kept
        # Nodes of one level have one depth.
        opened = (n >= tree.enough) & (not tree.ends(int(nodes[0]), tree.enough))
        allowed = np.zeros((k, width), dtype=bool)
        trying = np.flatnonzero(opened)
        allowed[trying[:, None], tried(tree, nodes[trying], width)] = True
        large = (n > SMALL_ROWS) if out else np.array([size > SMALL_ROWS])
        large &= not tree.exact
        found = np.zeros(k), np.full(k, -1), np.full(k, np.nan)
        if (large & opened).any():
            if binned is None:
                binned = np.empty(codes.shape, dtype=_code_type(bins))
                for f in range(width):
                    of_value = np.searchsorted(bins[f], values[f], side="left").astype(binned.dtype)
                    binned[f] = of_value.take(codes[f])
            found = _searched(level, binned, bins, allowed & large[:, None], tree.least, True)
        rest = allowed & (found[1] < 0)[:, None]
        exact = _searched(level, codes, values, rest, tree.least, False)
        chosen = found[1] >= 0
        feature, threshold = (np.where(chosen, a, b) for a, b in zip(found[1:], exact[1:]))
        out.append((nodes, feature, threshold, n, s))
        inner = np.flatnonzero(feature >= 0)
        if not len(inner):
            break
        ended = 2 * len(inner)
        child, last, of = np.full(k + 1, ended), np.full(k + 1, np.iinfo(np.int64).max), np.zeros(k + 1, dtype=np.int64)
        child[inner], of[inner] = 2 * np.arange(len(inner)), feature[inner]
        for f in np.unique(feature[inner]):
            own = np.flatnonzero(feature == f)
            last[own] = np.searchsorted(values[f], threshold[own], side="right") - 1
        cell = of.take(place) * count + np.arange(count)
        place = child.take(place) + (codes.ravel().take(cell) > last.take(place))
        nodes = (2 * nodes[inner][:, None] + np.arange(2)).ravel()
        live = np.flatnonzero(place < ended)
        if len(live) < 0.8 * count:
            count = len(live)
            place, each, codes = place.take(live), each.take(live), codes.take(live, axis=1)
            binned = binned if binned is None else binned.take(live, axis=1)
    return tuple(np.concatenate(c) for c in zip(*out))


def _finished(rows: Rows, trees: list[Tree], held: Held, shipped: list[int]) -> DataFrame:
    """The subtrees of the nodes that tasks can hold, each by the task that its rows are sent to."""
    bins, coded = rows.bins, rows.coded
    steps = _steps(bins, held, len(trees))
    slots, of_tree, roots = _slots(held, trees, shipped)
    own = {at: (held.tree[at], held.node[at], held.rows[at] or rows.count) for at in shipped}

    def send(batches):
        for ids, kinds, records, binned in _pieces(batches, bins):
            codes = binned if steps.plain else _codes(steps.cuts, _features(kinds, records, coded))
            for g, row, weight, slot in _open_rows(trees, steps, roots, slots, ids, codes):
                # Short numbers are sorted by their digits.
                slot = slot.astype(np.min_scalar_type(len(of_tree[g])))
                order = np.argsort(slot, kind="stable")
                slot = slot[order]
                sent = records.take(row.take(order))
                sent["w"] = weight.take(order)
                first = _first_in_runs(slot)
                ends = np.append(first, len(slot))
                data = [sent[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                at = np.array(of_tree[g])[slot[first]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array([kinds] * len(first)), pa.array(data, pa.binary())],
                    names=SHIPPED.names,
                )

    def grow(key, group):
        g, node, size = own[key[0].as_py()]
        w, y, columns = _unpacked(group.column("kinds").to_pylist(), group.column("packed").to_pylist(), coded)
        found, feature, threshold, n, s = finish(trees[g], node, size, w, y, columns, bins)
        return pa.table(
            {
                "tree": pa.array(np.full(len(found), g, dtype=np.int32)),
                "node": pa.array(found),
                "feature": pa.array(feature.astype(np.int32), mask=feature < 0),
                "threshold": pa.array(threshold, mask=feature < 0),
                "rows": pa.array(n),
                "value": pa.array(rows_value(n, s)),
            }
        )

    rows_value = Rows(None, 0, 0, rows.scale, rows.centre, [], [], []).value
    # Packed rows are much work for few bytes, so the number of tasks does not follow their bytes.
    total = sum(size for _, _, size in own.values())
    context = rows.table.sparkSession.sparkContext
    parts = min(len(shipped), max(8 * context.defaultParallelism, total // PART_ROWS))
    return rows.packed.mapInArrow(send, SHIPPED).repartition(parts, "at").groupBy("at").applyInArrow(grow, NODES)


def _in_turns(rows: Rows, held: Held, shipped: list[int]) -> list[list[int]]:
    """Nodes to send at a time, tree by tree: as many as ``SENT_ROWS`` allow, at least one."""
    turns, room = [], 0
    for at in sorted(shipped, key=lambda at: (held.tree[at], at)):
        size = held.rows[at] or rows.count
        if size > room:
            turns.append([])
            room = SENT_ROWS
        turns[-1].append(at)
        room -= size
    return turns


def grow(rows: Rows, trees: list[Tree]) -> DataFrame:
    """The nodes of all trees, written once; ``tree`` is the place in the given list.

    The root is node 1, the children of node i are 2 i (at most the threshold) and 2 i + 1. A
    leaf has neither feature nor threshold. ``rows`` counts a row as often as it was drawn, and
    ``value`` is the mean label. Passes follow the depth down to small nodes, whatever the
    number of trees.
    """
    if len(trees) > MAX_HELD_NODES:
        raise ValueError("Too many trees")
    # Trees that differ by their depth alone are one tree, cut off at several depths.
    deepest: dict[Tree, int] = {}
    for tree in trees:
        alike = replace(tree, depth=0)
        deepest[alike] = max(tree.depth, deepest.get(alike, 0))
    distinct = [replace(alike, depth=depth) for alike, depth in deepest.items()]
    with shuffles_freed(rows.table.sparkSession):
        rows = replace(rows, packed=_packed_rows(rows))
        nodes = written(_cut_off(_grown(rows, distinct), distinct, trees), "tree-nodes")
    dropped(rows.packed)
    return nodes


def _cut_off(nodes: DataFrame, distinct: list[Tree], trees: list[Tree]) -> DataFrame:
    """The nodes of all trees from those of the trees that differ by more than their depth."""
    if distinct != trees:
        numbers = {replace(tree, depth=0): g for g, tree in enumerate(distinct)}
        wanted = [(numbers[replace(tree, depth=0)], i, tree.depth) for i, tree in enumerate(trees)]
        copies = nodes.sparkSession.createDataFrame(wanted, "tree int, copy int, depth int")
        ends = F.col("node") >= F.expr("shiftleft(1L, depth)")
        nodes = (
            nodes.join(F.broadcast(copies), "tree")
            .where("node < shiftleft(1L, depth + 1)")
            .select(
                F.col("copy").alias("tree"),
                "node",
                *[F.when(~ends, F.col(c)).alias(c) for c in ("feature", "threshold")],
                "rows",
                "value",
            )
        )
    return nodes


def _grown(rows: Rows, trees: list[Tree]) -> DataFrame:
    """The nodes of trees that all differ."""
    held = Held(range(len(trees)))
    by_bins, exactly, shipped = [], [], []
    most = max(SMALL_ROWS, min(TASK_ROWS, TASK_CELLS // rows.width))

    def place(at: int, count: int) -> None:
        exact = trees[held.tree[at]].exact
        if count <= (SMALL_ROWS if exact else most):
            shipped.append(at)
        elif exact:
            exactly.append(at)
        else:
            by_bins.append(at)

    for at in range(len(trees)):
        place(at, rows.count)
    size = max(map(len, rows.bins)) + 1
    while by_bins or exactly:
        search, queue = (_by_bins, by_bins) if by_bins else (_exactly, exactly)
        room = max(1, PASS_CELLS // (rows.width * size))
        # Tree by tree, so that a pass follows the trees of its own nodes only.
        opened = sorted(queue, key=lambda at: (held.tree[at], at))[:room]
        rest = set(opened)
        queue[:] = [at for at in queue if at not in rest]
        for found in search(rows, trees, held, opened):
            at = found["at"]
            tree = trees[held.tree[at]]
            held.rows[at], held.total[at] = found["rows"], found["total"]
            if tree.ends(held.node[at], found["rows"]):
                continue
            if found["gain"] > 0:
                sides = found["left_rows"], found["left_total"]
                for child in held.split(at, found["feature"], found["threshold"], *sides):
                    if not tree.ends(held.node[child], held.rows[child]):
                        place(child, held.rows[child])
            elif search is _by_bins:
                # No cut between bins tells its rows apart; one between values may.
                exactly.append(at)
    top = _held_nodes(rows.table.sparkSession, held, rows, set(shipped))
    turns = [_finished(rows, trees, held, turn) for turn in _in_turns(rows, held, shipped)]
    if len(turns) > 1:
        turns = [written(turn, "tree-turn") for turn in turns]
    return reduce(DataFrame.unionByName, turns, top)


def _held_nodes(spark: SparkSession, held: Held, rows: Rows, left_out: set[int]) -> DataFrame:
    kept = np.array([at for at in range(len(held.node)) if at not in left_out], dtype=np.int64)
    if not len(kept):
        return spark.createDataFrame([], NODES)
    feature = np.array(held.feature)[kept]
    n, s = np.array(held.rows)[kept], np.array(held.total)[kept]
    table = pa.table(
        {
            "tree": pa.array(np.array(held.tree, dtype=np.int32)[kept]),
            "node": pa.array(np.array(held.node, dtype=np.int64)[kept]),
            "feature": pa.array(feature.astype(np.int32), mask=feature < 0),
            "threshold": pa.array(np.array(held.threshold)[kept], mask=feature < 0),
            "rows": pa.array(n),
            "value": pa.array(rows.value(n, s)),
        }
    )
    return spark.createDataFrame(table, NODES)


# --- models as tables -----------------------------------------------------------------------


def _model_paths(nodes: DataFrame) -> tuple[Paths, np.ndarray]:
    """A whole model in arrays: paths, whose thresholds are the values where a node is a leaf, and
    the places of the roots in order of trees."""
    table = nodes.select("tree", "node", "feature", "threshold", "value").toArrow()
    node = table.column("node").to_numpy()
    order = np.lexsort((node, table.column("tree").to_numpy()))
    node = node[order]
    feature = table.column("feature").fill_null(-1).to_numpy()[order]
    feature = feature.astype(np.min_scalar_type(-int(feature.max(initial=0)) - 1))
    threshold = table.column("threshold").fill_null(np.nan).to_numpy()[order]
    threshold = np.where(feature < 0, table.column("value").to_numpy()[order], threshold)
    # The driver holds the model twice for a while; what it was made from is let go before.
    del table, order
    roots = np.flatnonzero(node == 1)
    # Sorted by tree and node, the two children of a node are neighbours.
    bounds = np.append(roots, len(node))
    left = np.full(len(node), -1, dtype=np.int32)
    for a, b in zip(bounds[:-1], bounds[1:]):
        left[a:b] = a + np.searchsorted(node[a:b], 2 * node[a:b])
    return Paths(feature, threshold, left), roots


def predict(
    df: DataFrame,
    nodes: DataFrame,
    features: str,
    output: str,
    max_nodes: int = MAX_MODEL_NODES,
) -> DataFrame:
    """Add the mean of the trees' values for a vector of features.

    A model of at most ``max_nodes`` nodes goes to the tasks whole; a larger one stays a table,
    and rows are joined to it level by level (``predict_by_joins``). Null features give null.
    """
    if nodes.count() > max_nodes:
        return predict_by_joins(df, nodes, features, output)
    paths, roots = _model_paths(nodes)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            known = x.notna()
            result = pd.Series(np.nan, index=x.index)
            if known.any() and len(roots):
                matrix = np.stack(x[known].to_numpy())
                rows, total = np.arange(len(matrix)), np.zeros(len(matrix))
                for root in roots:
                    total += paths.threshold[paths.follow(matrix, rows, root)]
                result[known] = total / len(roots)
            yield result

    return df.withColumn(output, F.nanvl(scores(_array(df, features)), F.lit(None).cast("double")))


def out_of_bag(
    df: DataFrame, nodes: DataFrame, trees: list[Tree], key: str, features: str, output: str
) -> DataFrame:
    """Add the mean value of the trees whose sample does not hold the row; null if all do.

    ``trees`` are the settings that the nodes were grown with, ``key`` the key of the same rows.
    """
    paths, roots = _model_paths(nodes)

    @F.pandas_udf("double")
    def scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for ids, x in batches:
            matrix = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            ids, rows = ids.to_numpy().astype(np.uint64), np.arange(len(matrix))
            total, times = np.zeros(len(matrix)), np.zeros(len(matrix))
            for tree, root in zip(trees, roots):
                out = rows[draws(tree, ids) == 0]
                total[out] += paths.threshold[paths.follow(matrix, out, root)]
                times[out] += 1
            yield pd.Series(np.divide(total, times, out=np.full(len(total), np.nan), where=times > 0), index=x.index)

    found = scores(F.xxhash64(key), _array(df, features))
    return df.withColumn(output, F.nanvl(found, F.lit(None).cast("double")))


def predict_by_joins(
    df: DataFrame, nodes: DataFrame, features: str, output: str, max_lookup_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The same by joins alone: every row takes one step down in every tree, once a level.

    Rows are written once with a number. A level's nodes are broadcast if they are few; else
    both sides are shuffled and nodes that many rows pass are salted.
    """
    numbered = {"_row": F.monotonically_increasing_id(), "_x": _array(df, features)}
    rows = written(df.withColumns(numbered), "scored-rows")
    nodes = nodes.select("tree", "node", "feature", "threshold", "value")
    levels = nodes.agg(F.max("node")).first()[0]
    trees = nodes.where("node = 1").count()
    state = rows.where("_x is not null").select(
        "_row", "_x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(1).cast("bigint").alias("node")
    )
    found = []
    for level in range((levels or 0).bit_length()):
        here = nodes.where((F.col("node") >= 1 << level) & (F.col("node") < 1 << (level + 1)))
        lookup = stored_lookup(here, max_lookup_rows)
        step = join_lookup(state, lookup, ["tree", "node"], "inner", spread_by=["_row"])
        if not lookup.fits:
            step = written(step, "tree-level")
        found.append(step.where("feature is null").select("_row", "value"))
        right = ~(F.col("_x")[F.col("feature")] <= F.col("threshold"))
        state = step.where("feature is not null").select(
            "_row", "_x", "tree", (2 * F.col("node") + right.cast("int")).alias("node")
        )
    means = reduce(DataFrame.unionByName, found).groupBy("_row").agg(F.avg("value").alias(output))
    return rows.drop("_x").drop(output).join(means, "_row", "left").drop("_row")


def split_gains(nodes: DataFrame) -> DataFrame:
    """(tree, node, feature, gain): how much each split lowers the sum of squares of its rows.

    Worked out anew from the rows and values of the node's two children.
    """

    def side(name: str, half: int) -> DataFrame:
        of = nodes.where(F.pmod("node", F.lit(2)) == half)
        return of.select(
            "tree",
            F.expr("node div 2").alias("node"),
            F.col("rows").alias(f"{name}_rows"),
            F.col("value").alias(f"{name}_value"),
        )

    pairs = (
        nodes.where("feature is not null")
        .select("tree", "node", "feature")
        .join(side("left", 0).where("node > 0"), ["tree", "node"])
        .join(side("right", 1).where("node > 0"), ["tree", "node"])
    )
    a, b = F.col("left_rows").cast("double"), F.col("right_rows").cast("double")
    off = F.col("left_value") - F.col("right_value")
    return pairs.select("tree", "node", "feature", (a * b / (a + b) * off * off).alias("gain"))


def slot_importance(nodes: DataFrame) -> DataFrame:
    """(feature, importance): share of the gain per tree, averaged over trees, adding up to one.

    Trees without a split count for nothing.
    """
    by_slot = split_gains(nodes).groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    in_tree = F.sum("gain").over(Window.partitionBy("tree"))
    shares = by_slot.withColumn("share", F.col("gain") / in_tree).groupBy("feature").agg(F.sum("share").alias("share"))
    trees = by_slot.select("tree").distinct().agg(F.count(F.lit(1))).scalar()
    return shares.select("feature", (F.col("share") / trees).alias("importance"))
