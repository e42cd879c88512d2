"""Seeded splits with exact sizes, optionally stratified.

A row's side depends only on the seed, its key and the table's contents: rows are ordered
by a hash of seed and key, and the first rows of each stratum are taken. Fitting reads only
key and stratum and yields one cut per stratum; applying a fit is a comparison per row.
"""

import hashlib
import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.hashing import order_hash
from tallyhouse.plans.lookups import (
    BROADCAST_ROWS,
    Lookup,
    derived_lookup,
    join_lookup,
    local_table,
)
from tallyhouse.plans.ranks import SORTABLE_ROWS, bucket_counts, cut_points

HASH_DIGITS = 32
QUOTA = T.StructType(
    [T.StructField("stratum", T.StringType()), T.StructField("quota", T.LongType())]
)
TEST, VALIDATION, TRAIN, TRAINVAL = "test", "validation", "train", "trainval"


@dataclass(frozen=True)
class FittedSplit:
    """Cuts per stratum: hashes up to ``cut_test`` are test, up to ``cut_validation`` validation."""

    key: str
    seed: int
    stratify_by: str | None
    labels: tuple[str, ...]
    rest: str
    cuts: Lookup

    def apply(self, df: DataFrame, column: str = "split") -> DataFrame:
        """Name the side of every row. No row moves unless strata are too many to broadcast."""
        position = order_hash(self.seed, self.key)
        if self.stratify_by is None:
            # One stratum, hence one row.
            cut = self.cuts.table.first()
            return df.withColumn(column, self._side(position, lambda name: F.lit(cut[name])))
        cuts = self.cuts.table.withColumnRenamed("stratum", "_stratum")
        joined = join_lookup(
            df.withColumn("_stratum", F.col(self.stratify_by).cast("string")),
            Lookup(cuts, self.cuts.fits),
            ["_stratum"],
            "left",
            spread_by=[self.key],
        )
        names = [f"cut_{label}" for label in self.labels]
        return joined.withColumn(column, self._side(position, F.col)).drop("_stratum", *names)

    def _side(self, position: Column, cut) -> Column:
        side = F.lit(self.rest)
        for label in reversed(self.labels):
            # A stratum without quota has a null cut and takes the later branches.
            side = F.when(position <= cut(f"cut_{label}"), F.lit(label)).otherwise(side)
        return side


def _check_fraction(name: str, value: float) -> None:
    if not 0 < value < 1:
        raise ValueError(f"{name} must be strictly between zero and one, got {value}")


def allocate(
    sizes: Lookup, take: int, seed: int, max_lookup_rows: int = BROADCAST_ROWS
) -> Lookup:
    """Share ``take`` rows among strata in proportion to their size, exactly.

    ``sizes`` has ``stratum`` and ``n``. Each stratum gets the whole part of its share; the
    rows left over go to the largest remainders, equal remainders in the order of a hash.
    Returns ``stratum`` and ``quota``.
    """
    if sizes.rows is not None:
        quotas = _shares({row["stratum"]: row["n"] for row in sizes.rows}, take, seed)
        rows = list(quotas.items())
        spark = sizes.table.sparkSession
        return Lookup(local_table(rows, QUOTA, spark), True, tuple(Row(*QUOTA.names)(*r) for r in rows))
    total = sizes.table.agg(F.sum("n")).first()[0]
    exact = f"CAST({take} AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0))"
    shares = sizes.table.select(
        "stratum",
        F.expr(f"CAST({exact} div {total} AS BIGINT)").alias("base"),
        F.concat(
            # A larger remainder sorts first.
            F.lpad(F.hex(F.expr(f"CAST({total} - ({exact}) % {total} AS BIGINT)")), 16, "0"),
            order_hash(seed, "stratum"),
        ).alias("turn"),
    )
    left = take - shares.agg(F.sum("base")).first()[0]
    extra = F.lit(0)
    if left:
        wanted = shares.sparkSession.createDataFrame(
            [(0, "left", left)], "all int, label string, rank bigint"
        )
        last = cut_points(
            shares.select(F.lit(0).alias("all"), "turn"),
            wanted,
            ["all"],
            "turn",
            16 + HASH_DIGITS,
            max_lookup_rows=max_lookup_rows,
        ).first()["cut"]
        extra = (F.col("turn") <= F.lit(last)).cast("int")
    quotas = shares.select("stratum", (F.col("base") + extra).cast("bigint").alias("quota"))
    return Lookup(quotas, sizes.fits)


def _shares(sizes: dict[str, int], take: int, seed: int) -> dict[str, int]:
    """``allocate`` for strata that fit the driver."""
    total = sum(sizes.values())

    def turn(stratum):
        digest = hashlib.md5(f"{seed}|{stratum}".encode()).hexdigest()
        return -(take * sizes[stratum] % total), digest

    quotas = {stratum: take * n // total for stratum, n in sizes.items()}
    for stratum in sorted(sizes, key=turn)[: take - sum(quotas.values())]:
        quotas[stratum] += 1
    return quotas


def fit_split(
    df: DataFrame,
    key: str,
    test_size: float,
    seed: int,
    stratify_by: str | None = None,
    val_size: float | None = None,
    max_lookup_rows: int = BROADCAST_ROWS,
    sortable_rows: int = SORTABLE_ROWS,
) -> FittedSplit:
    """Find the cuts of a two-way split, or of a three-way one if ``val_size`` is given.

    The test side has ``ceil(test_size * n)`` rows; the validation side is
    ``ceil(val_size * rest)`` of the others, as if the same split were run on them again
    with the same seed. ``stratify_by`` may be ``None`` or ``"none"``.
    """
    _check_fraction("test_size", test_size)
    if val_size is not None:
        _check_fraction("val_size", val_size)
    if stratify_by == "none":
        stratify_by = None
    stratum = F.col(stratify_by).cast("string") if stratify_by else F.lit("all")
    rows = df.select(stratum.alias("stratum"), order_hash(seed, key).alias("position"))
    # Serves both the stratum sizes and the first narrowing step.
    counts = bucket_counts(rows, ["stratum"], "position").persist()
    try:
        sizes = derived_lookup(
            counts.groupBy("stratum").agg(
                F.sum("_n").alias("n"), F.bool_or(F.col("_bucket").isNull()).alias("keyless")
            ),
            max_lookup_rows,
        )
        if _any(sizes, "keyless"):
            raise ValueError(f"Column {key} has nulls; every row needs a key")
        labels, quotas = _quotas(sizes, test_size, val_size, seed, stratify_by, max_lookup_rows)
        cuts = cut_points(
            rows,
            quotas,
            ["stratum"],
            "position",
            HASH_DIGITS,
            counts=counts,
            max_lookup_rows=max_lookup_rows,
            sortable_rows=sortable_rows,
        )
        found = derived_lookup(cuts, max_lookup_rows)
        wide = _one_row_per_stratum(found, labels, key)
    finally:
        counts.unpersist()
    return FittedSplit(
        key,
        seed,
        stratify_by,
        labels,
        TRAINVAL if val_size is None else TRAIN,
        wide,
    )


def _any(lookup: Lookup, flag: str) -> bool:
    if lookup.rows is not None:
        return any(row[flag] for row in lookup.rows)
    return not lookup.table.where(flag).isEmpty()


def _one_row_per_stratum(found: Lookup, labels: tuple[str, ...], key: str) -> Lookup:
    """Cuts of all sides of a stratum in one row; refuses a cut between equal keys."""
    if _any(found, "tied"):
        raise ValueError(f"Column {key} is not unique: equal keys lie on a cut")
    if not found.fits:
        sides = [F.max(F.when(F.col("label") == n, F.col("cut"))).alias(f"cut_{n}") for n in labels]
        return Lookup(found.table.groupBy("stratum").agg(*sides), False)
    cuts: dict[str, dict[str, str]] = {}
    for row in found.rows:
        cuts.setdefault(row["stratum"], {})[row["label"]] = row["cut"]
    schema = T.StructType(
        [T.StructField(name, T.StringType()) for name in ("stratum", *[f"cut_{n}" for n in labels])]
    )
    rows = [(stratum, *[sides.get(n) for n in labels]) for stratum, sides in cuts.items()]
    return Lookup(local_table(rows, schema, found.table.sparkSession), True, tuple(rows))


def _facts(sizes: Lookup) -> tuple[int, int, int, bool]:
    """Rows, strata, rows of the smallest stratum, and whether a stratum is null."""
    if sizes.rows is not None:
        ns = [row["n"] for row in sizes.rows]
        missing = any(row["stratum"] is None for row in sizes.rows)
        return sum(ns), len(ns), min(ns, default=0), missing
    return tuple(
        sizes.table.agg(
            F.sum("n"), F.count(F.lit(1)), F.min("n"), F.bool_or(F.col("stratum").isNull())
        ).first()
    )


def _quotas(sizes, test_size, val_size, seed, stratify_by, max_lookup_rows):
    """Sides in order, and per stratum the rank at which each of them ends."""
    total, strata, smallest, missing = _facts(sizes)
    n_test = math.ceil(test_size * total)
    sides = [(TEST, n_test, total - n_test)]
    if val_size is not None:
        n_val = math.ceil(val_size * (total - n_test))
        sides.append((VALIDATION, n_val, total - n_test - n_val))
    if any(remaining < 1 for _, _, remaining in sides):
        raise ValueError(f"{total} rows are too few to split: a side would be empty")
    if stratify_by is not None:
        if missing:
            raise ValueError(f"Column {stratify_by} has nulls; strata must be known")
        for label, wanted, remaining in sides:
            if min(wanted, remaining) < strata:
                raise ValueError(f"Side {label} or its rest has fewer rows than there are strata")
    ranks = None
    ends = sizes.table.select("stratum", F.lit(0).cast("bigint").alias("end"))
    left = sizes
    for label, wanted, _ in sides:
        if stratify_by is not None and _facts(left)[2] < 2:
            raise ValueError(f"A stratum of {stratify_by} has a single row")
        quota = allocate(left, wanted, seed, max_lookup_rows).table
        ends = ends.join(quota, "stratum").select(
            "stratum", (F.col("end") + F.col("quota")).alias("end"), "quota"
        )
        side = ends.where("quota > 0").select(
            "stratum", F.lit(label).alias("label"), F.col("end").alias("rank")
        )
        ranks = side if ranks is None else ranks.unionByName(side)
        left = derived_lookup(
            left.table.join(quota, "stratum").select(
                "stratum", (F.col("n") - F.col("quota")).alias("n")
            ),
            max_lookup_rows,
        ) if label != sides[-1][0] else left
        ends = ends.drop("quota")
    return tuple(label for label, _, _ in sides), ranks


def split_two(
    df: DataFrame, key: str, test_size: float, seed: int, stratify_by: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The two sides as tables: (train and validation, test)."""
    tagged = fit_split(df, key, test_size, seed, stratify_by).apply(df, "_side")
    return (
        tagged.where(F.col("_side") == TRAINVAL).drop("_side"),
        tagged.where(F.col("_side") == TEST).drop("_side"),
    )


def split_identity(
    source_digest: Column, test_size: float, seed: int, stratify_by: str | None
) -> Column:
    """SHA-256 of source digest and parameters as JSON with sorted keys and no spaces."""
    parameters = json.dumps(
        {"random_seed": seed, "stratify_by": stratify_by or "none", "test_size": test_size},
        sort_keys=True,
        separators=(",", ":"),
    )
    return F.sha2(
        F.concat(
            F.lit(f'{{"parameters":{parameters},"source_sha256":"'),
            source_digest,
            F.lit('"}'),
        ),
        256,
    )


def require_unique(df: DataFrame, key: str) -> None:
    """Raise if a key is null or repeated. Reads and shuffles the whole key column."""
    bad = df.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1))
    if not bad.isEmpty():
        raise ValueError(f"Column {key} has null or repeated values")
