"""Data checks, drift and profiles.

Checks count violations, and a null counts as one: ``coalesce(condition, false)``.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.plans.lookups import local_table
from tallyhouse.schemas import KL_LIMIT, ROW_COUNT_BOUNDS

QUANTILES = T.StructType(
    [T.StructField("fraction", T.DoubleType()), T.StructField("value", T.DoubleType())]
)
# Relative accuracy of the sketch, and rows whose distinct values may go to the driver.
ACCURACY = 10_000
SMALL_RANGE = 10_000
# Size of stored sketches, and how far their ranks may be off.
KLL_SIZE = 4_000
KLL_ERROR = 0.002
HLL_BITS = 14


def violates(condition: Column) -> Column:
    """True where the condition is false or unknown."""
    return ~F.coalesce(condition, F.lit(False))


def check_schema(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per position with expected and actual column name, and values present."""
    actual = df.columns
    width = max(len(actual), len(expected))
    counts = df.agg(*[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(actual)])
    lines = []
    for i in range(width):
        want = expected[i] if i < len(expected) else None
        have = actual[i] if i < len(actual) else None
        lines.append(
            F.struct(
                F.lit(i + 1).cast("bigint").alias("position"),
                F.lit(want).cast("string").alias("expected"),
                F.lit(have).cast("string").alias("actual"),
                F.lit(want == have).alias("passed"),
                (F.col(f"c{i}") if have is not None else F.lit(0))
                .cast("bigint")
                .alias("present"),
            )
        )
    return counts.select(F.inline(F.array(*lines)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value in value order; missing values are not counted."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(column)
    )


def check_domain(df: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    """Compare the distinct values with the known set, both ways. A null is unknown.

    Unknown values are counted, not gathered, so a column full of them stays cheap.
    """
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    result = per_value.agg(*_domain_facts(F.col(column), F.col("n"), known))
    return result.select(
        "unknown_rows",
        "known_found",
        F.lit(len(set(known))).cast("bigint").alias("known_total"),
        ((F.col("unknown_rows") == 0) & (F.col("known_found") == len(set(known)))).alias("passed"),
    )


def _domain_facts(value: Column, n: Column, known: Sequence[str]) -> list[Column]:
    is_known = F.coalesce(value.isin(list(known)), F.lit(False))
    return [
        F.coalesce(F.sum(F.when(~is_known, n)), F.lit(0)).cast("bigint").alias("unknown_rows"),
        F.count_if(is_known & (n > 0)).cast("bigint").alias("known_found"),
    ]


def check_condition(df: DataFrame, condition: Column) -> DataFrame:
    """Count of rows that violate a condition; none may."""
    bad = df.agg(F.count_if(violates(condition)).cast("bigint").alias("violations"))
    return bad.select("violations", (F.col("violations") == 0).alias("passed"))


def check_bounds(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Every named column lies within its bounds, borders included."""
    return check_condition(df, within(bounds))


def within(bounds: dict[str, tuple[float, float]]) -> Column:
    condition = F.lit(True)
    for column, (low, high) in bounds.items():
        condition = condition & F.col(column).between(low, high)
    return condition


def check_row_count(df: DataFrame, low: int, high: int) -> DataFrame:
    """Row count between two bounds, borders included."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.col("n_rows").between(low, high).alias("passed")
    )


def _divergence(current: Column, baseline: Column) -> Column:
    """KL divergence in bits of two count columns, one row per category, as one aggregate.

    With totals C and B, ``sum(c/C * log2((c/C) / (b/B)))`` equals
    ``sum(c * log2(c/b)) / C + log2(B/C)``, so no second pass for the totals is needed.
    """
    term = (
        F.when(current == 0, F.lit(0.0))
        .when(baseline == 0, F.lit(float("inf")))
        .otherwise(current * F.log2(current / F.nullif(baseline, F.lit(0))))
    )
    c, b = F.sum(current), F.sum(baseline)
    shift = F.when((c > 0) & (b > 0), F.log2(b / F.nullif(c, F.lit(0))))
    return F.when(shift.isNotNull(), F.sum(term) / F.nullif(c, F.lit(0)) + shift)


def _side_counts(current: DataFrame, baseline: DataFrame, column: str) -> DataFrame:
    """Rows per category on both sides: each table is aggregated first, then joined by union."""
    c = current.groupBy(column).agg(F.count(F.lit(1)).alias("c")).withColumn("b", F.lit(0))
    b = baseline.groupBy(column).agg(F.count(F.lit(1)).alias("b")).withColumn("c", F.lit(0))
    return c.unionByName(b).groupBy(column).agg(F.sum("c").alias("c"), F.sum("b").alias("b"))


def drift_kl(
    current: DataFrame, baseline: DataFrame, column: str, limit: float = KL_LIMIT
) -> DataFrame:
    """KL divergence (base 2) of the category shares of ``current`` from ``baseline``.

    Categories are paired by value. (A comparison that pairs sorted counts by position gives
    the same number if both sides hold the same categories, and a wrong one or an error
    otherwise.) A category that only the baseline has adds nothing; one that only the current
    table has makes the divergence infinite. Nulls are left out. An empty side gives null,
    which fails. Passes if strictly below the limit.
    """
    present = F.col(column).isNotNull()
    counts = _side_counts(current.where(present), baseline.where(present), column)
    return counts.agg(
        _divergence(F.col("c"), F.col("b")).alias("kl"), F.count(F.lit(1)).alias("categories")
    ).select("kl", "categories", F.coalesce(F.col("kl") < limit, F.lit(False)).alias("passed"))


@dataclass(frozen=True)
class SuiteLimits:
    """What the suite demands. Bad limits are refused before any data is read."""

    columns: Sequence[str]
    category: str
    known: Sequence[str]
    box: dict[str, tuple[float, float]]
    price: str
    price_bounds: tuple[float, float]
    row_bounds: tuple[int, int] = ROW_COUNT_BOUNDS
    kl_limit: float = KL_LIMIT

    def __post_init__(self):
        numbers = [self.kl_limit, *self.price_bounds, *self.row_bounds]
        numbers += [v for pair in self.box.values() for v in pair]
        if not all(math.isfinite(v) for v in numbers):
            raise ValueError("Limits must be finite numbers")
        if self.kl_limit < 0:
            raise ValueError("The drift limit must not be negative")
        if not self.price_bounds[0] < self.price_bounds[1]:
            raise ValueError("The lower price bound must be below the upper one")


def check_suite(current: DataFrame, baseline: DataFrame, limits: SuiteLimits) -> DataFrame:
    """All six checks, one row each: check, observed, limit, passed.

    Each table is read once. Per-category partial counts carry every check, so the only
    shuffle moves one row per category and task.
    """
    if current is baseline or current.sameSemantics(baseline):
        raise ValueError("The current table must differ from the baseline")
    cat = limits.category
    zero = F.lit(0).cast("bigint")
    now = current.groupBy(cat).agg(
        F.count(F.lit(1)).alias("c"),
        F.count_if(violates(within(limits.box))).alias("outside"),
        F.count_if(violates(F.col(limits.price).between(*limits.price_bounds))).alias("mispriced"),
        zero.alias("b"),
    )
    then = baseline.groupBy(cat).agg(
        zero.alias("c"), zero.alias("outside"), zero.alias("mispriced"),
        F.count(F.lit(1)).alias("b"),
    )
    per_value = (
        now.unionByName(then)
        .groupBy(cat)
        .agg(*[F.sum(c).alias(c) for c in ("c", "outside", "mispriced", "b")])
    )
    known = F.col(cat).isNotNull()
    total = F.coalesce(F.sum("c"), zero)
    facts = per_value.agg(
        total.alias("n_rows"),
        F.coalesce(F.sum("outside"), zero).alias("outside"),
        F.coalesce(F.sum("mispriced"), zero).alias("mispriced"),
        *_domain_facts(F.col(cat), F.col("c"), limits.known),
        _divergence(F.when(known, F.col("c")), F.when(known, F.col("b"))).alias("kl"),
    )
    n_known = len(set(limits.known))
    same_columns = list(current.columns) == list(limits.columns)
    low, high = limits.row_bounds
    lines = [
        ("column_names", F.lit(float(same_columns)), f"{len(limits.columns)} names in order",
         F.lit(same_columns)),
        ("known_categories", F.col("unknown_rows"), f"0 unknown, {n_known} known",
         (F.col("unknown_rows") == 0) & (F.col("known_found") == n_known)),
        ("inside_box", F.col("outside"), "0", F.col("outside") == 0),
        ("similar_shares", F.col("kl"), f"< {limits.kl_limit}", F.col("kl") < limits.kl_limit),
        ("row_count", F.col("n_rows"), f"{low} to {high}", F.col("n_rows").between(low, high)),
        ("price_range", F.col("mispriced"), "0", F.col("mispriced") == 0),
    ]
    return facts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check"),
                        observed.cast("double").alias("observed"),
                        F.lit(limit).alias("limit"),
                        F.coalesce(passed, F.lit(False)).alias("passed"),
                    )
                    for name, observed, limit, passed in lines
                ]
            )
        )
    )


def enforce(report: DataFrame, path: str) -> DataFrame:
    """Write the report, then raise if a check failed: the evidence outlives the failure."""
    report.write.mode("errorifexists").json(path)
    kept = report.sparkSession.read.schema(report.schema).json(path)
    failed = sorted(row["check"] for row in kept.where(~F.col("passed")).collect())
    if failed:
        raise ValueError("Data checks failed: " + ", ".join(failed))
    return kept


def profile_columns(
    df: DataFrame, columns: Sequence[str], distinct: str = "approx"
) -> DataFrame:
    """One row per column: rows, missing, distinct values, range, mean and deviation.

    Columns without a numeric value have a null mean and deviation; range is text. Approximate
    distinct counts need one pass and no shuffle of values. Exact ones read each column once
    more, by itself, and shuffle its distinct values.
    """
    if distinct not in {"approx", "exact"}:
        raise ValueError("distinct must be approx or exact")

    def distinct_values(c):
        if distinct == "approx":
            return F.approx_count_distinct(c)
        # A subquery per column: several exact counts in one aggregate would multiply the rows.
        return df.select(c).distinct().agg(F.count(c)).scalar()

    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    types = dict(df.dtypes)
    aggs, lines = [], []
    for i, c in enumerate(columns):
        is_number = types[c] in numeric or types[c].startswith("decimal")
        aggs += [
            F.count(c).alias(f"n{i}"),
            distinct_values(c).alias(f"d{i}"),
            F.min(c).alias(f"lo{i}"),
            F.max(c).alias(f"hi{i}"),
            (F.avg(c) if is_number else F.lit(None).cast("double")).alias(f"m{i}"),
            (F.stddev(c) if is_number else F.lit(None).cast("double")).alias(f"s{i}"),
        ]
        lines.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col("_rows").alias("n_rows"),
                (F.col("_rows") - F.col(f"n{i}")).alias("missing"),
                F.col(f"d{i}").alias("distinct_values"),
                F.col(f"lo{i}").cast("string").alias("lowest"),
                F.col(f"hi{i}").cast("string").alias("highest"),
                F.col(f"m{i}").cast("double").alias("mean"),
                F.col(f"s{i}").cast("double").alias("deviation"),
            )
        )
    return df.agg(F.count(F.lit(1)).alias("_rows"), *aggs).select(F.inline(F.array(*lines)))


def histogram(df: DataFrame, column: str, low: float, width: float) -> DataFrame:
    """Rows per bin of equal width, counted from ``low``; empty bins are absent, nulls left out."""
    if not width > 0:
        raise ValueError("width must be positive")
    bin_ = F.floor((F.col(column) - F.lit(low)) / F.lit(width)).cast("bigint")
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(bin_.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_low", F.lit(float(low)) + F.col("bin") * F.lit(float(width)))
    )


def profile_by(df: DataFrame, part: str | Column, column: str) -> DataFrame:
    """(part, n, missing, lowest, highest, ranks, values): a column's profile for each part, as
    mergeable sketches of its ranks (KLL) and its different values (HLL).

    Meant to be stored, a part being a day or a file: new data adds rows and old data is not
    read again. NaN counts as missing. The table has as many rows as there are parts.
    """
    v = F.col(column).cast("double")
    rows = df.select(
        (F.col(part) if isinstance(part, str) else part).alias("part"),
        F.when(~F.isnan(v), v).alias("v"),
    )
    return rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"),
        (F.count(F.lit(1)) - F.count("v")).alias("missing"),
        F.min("v").alias("lowest"),
        F.max("v").alias("highest"),
        F.kll_sketch_agg_double("v", KLL_SIZE).alias("ranks"),
        F.hll_sketch_agg(F.hash("v"), HLL_BITS).alias("values"),
    )


def merge_profiles(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of parts as one, or one for each group: sketches in, sketches out.

    A part that was profiled again belongs in the table once; rows that repeat are added up.
    """
    return profiles.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.kll_merge_agg_double("ranks", KLL_SIZE).alias("ranks"),
        F.hll_union_agg("values").alias("values"),
    )


def profile_figures(merged: DataFrame, fractions: Sequence[float]) -> DataFrame:
    """Counts, range, about how many different values, and about which quantiles: no data is read."""
    kept = [c for c in merged.columns if c not in ("ranks", "values")]
    places = F.array(*[F.lit(float(f)) for f in fractions])
    some = F.col("n") > F.col("missing")
    return merged.select(
        *kept,
        F.hll_sketch_estimate("values").alias("distinct_values"),
        F.when(some, F.kll_sketch_get_quantile_double("ranks", places)).alias("quantiles"),
    )


def quantiles(
    df: DataFrame, column: str, fractions: Sequence[float], profiles: DataFrame | None = None
) -> DataFrame:
    """Exact discrete quantiles: fraction, value; no rows if there is no value.

    The value at rank ``ceil(fraction * n)`` of the sorted column, nulls and NaN left out. All
    fractions share their scans: one for a sketch that narrows the range of each rank, one for
    exact counts that confirm it, one for the distinct values of ranges that hold few rows. Ranges
    that still hold many are narrowed again. So neither a sort nor all values of a column ever
    meet in one task, and no value is rounded.
    """
    if not all(0 <= f <= 1 for f in fractions):
        raise ValueError("Fractions must lie between zero and one")
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null and not isnan(v)")
    wanted = list(dict.fromkeys(float(f) for f in fractions))
    error = 2 / ACCURACY if profiles is None else KLL_ERROR
    near = [p for f in wanted for p in _near(f, error)] or [0.5]
    if profiles is None:
        sketch = F.percentile_approx("v", near, ACCURACY)
        n, low, high, cuts = values.agg(F.count("v"), F.min("v"), F.max("v"), sketch).first()
    else:
        merged = profile_figures(merge_profiles(profiles), near).first()
        n, low, high, cuts = merged["n"] - merged["missing"], *(
            merged[c] for c in ("lowest", "highest", "quantiles")
        )
    if not n:
        return local_table([], QUANTILES, df.sparkSession)
    ranks = {f: max(1, math.ceil(f * n)) for f in wanted}
    ranges = {f: _Range(low, high, 0, n) for f in wanted}
    cuts = {f: (cuts[2 * i], cuts[2 * i + 1]) for i, f in enumerate(wanted)}
    found: dict[float, float] = {}
    while len(found) < len(wanted):
        wide = [f for f in wanted if f not in found and ranges[f].inside > SMALL_RANGE]
        if not wide:
            break
        if cuts is None:
            cuts = _sketched(values, ranks, ranges, wide)
        counts = _counted(values, {f: cuts[f] for f in wide})
        for f in wide:
            value = ranges[f].narrowed(ranks[f], *cuts[f], counts[f])
            if isinstance(value, float):
                found[f] = value
            else:
                ranges[f] = value
        cuts = None
    open_ = {f: ranges[f] for f in wanted if f not in found}
    if open_:
        v = F.col("v")
        inside = reduce(or_, [v.between(r.low, r.high) for r in open_.values()])
        counted = sorted((row["v"], row["count"]) for row in values.where(inside).groupBy("v").count().collect())
        for f, r in open_.items():
            below = r.below
            for value, times in counted:
                if r.low <= value <= r.high:
                    below += times
                    if below >= ranks[f]:
                        found[f] = value
                        break
    return local_table([(float(f), found[float(f)]) for f in fractions], QUANTILES, df.sparkSession)


def _near(place: float, error: float) -> list[float]:
    return [max(0.0, place - error), min(1.0, place + error)]


@dataclass(frozen=True)
class _Range:
    """``inside`` values lie from ``low`` to ``high``, ``below`` lie below; the wanted rank is inside."""

    low: float
    high: float
    below: int
    inside: int

    def narrowed(self, rank: int, first: float, last: float, counts: Sequence[int]) -> "_Range | float":
        """The part between, below or above two cuts that holds the rank, or the value itself."""
        under_first, to_first, under_last, to_last = counts
        if self.low >= self.high:
            return self.low
        if under_first < rank <= to_first:
            return first
        if under_last < rank <= to_last:
            return last
        if rank <= under_first:
            return _Range(self.low, first, self.below, to_first - self.below)
        if rank <= under_last:
            return _Range(first, last, under_first, to_last - under_first)
        return _Range(last, self.high, under_last, self.below + self.inside - under_last)


def _sketched(values: DataFrame, ranks: dict, ranges: dict, wide: Sequence[float]) -> dict:
    """Two cuts around each open rank, from one scan for all."""
    v = F.col("v")
    sketches = [
        F.percentile_approx(
            F.when(v.between(ranges[f].low, ranges[f].high), v),
            _near((ranks[f] - ranges[f].below) / ranges[f].inside, 2 / ACCURACY),
            ACCURACY,
        ).alias(f"_{i}")
        for i, f in enumerate(wide)
    ]
    cuts = {}
    for f, (first, last) in zip(wide, values.agg(*sketches).first()):
        low, high = ranges[f].low, ranges[f].high
        if (first, last) == (low, high):
            first = last = low + (high - low) / 2
        cuts[f] = (first, last)
    return cuts


def _counted(values: DataFrame, cuts: dict) -> dict:
    """Values below and up to each cut, from one scan for all."""
    v = F.col("v")
    sides = [(f, side) for f, both in cuts.items() for cut in both for side in (v < cut, v <= cut)]
    row = values.agg(*[F.count_if(side).alias(f"_{i}") for i, (_, side) in enumerate(sides)]).first()
    return {f: row[4 * i : 4 * i + 4] for i, f in enumerate(cuts)}
