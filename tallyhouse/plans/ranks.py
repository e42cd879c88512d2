"""Exact ranks inside groups of any size, without sorting a whole group in one task.

The order is a fixed-width hex string. Rows are counted by group and leading digits, the
counts are summed up to find the bucket that holds the wanted rank, and only that bucket is
looked at again, with more digits, until it is small enough to sort.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.plans.lookups import (
    BROADCAST_ROWS,
    Lookup,
    derived_lookup,
    join_lookup,
)

DIGITS = 3
SORTABLE_ROWS = 1_000_000
FILTER_PATHS = 1_000


def bucket_counts(
    rows: DataFrame, group: Sequence[str], order: str, digits: int = DIGITS
) -> DataFrame:
    """Rows per group and leading digits: at most ``16 ** digits`` rows for each group."""
    return (
        rows.groupBy(*group, F.substring(F.col(order), 1, digits).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_path", F.lit(""))
    )


def cut_points(
    rows: DataFrame,
    wanted: DataFrame,
    group: Sequence[str],
    order: str,
    width: int,
    counts: DataFrame | None = None,
    digits: int = DIGITS,
    sortable_rows: int = SORTABLE_ROWS,
    max_lookup_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The value of ``order`` at given ranks of each group.

    ``rows`` holds the group columns and ``order`` (``width`` hex digits). ``wanted`` holds
    the group columns, ``label`` and the 1-based ``rank``. Returns group columns, ``label``,
    ``cut`` and ``tied``, true if the row after the wanted one has the same value.
    ``counts`` may hand over the first ``bucket_counts`` if the caller has it already.
    """
    group = list(group)
    node = [*group, "_path"]
    open_ranks = wanted.withColumn("_path", F.lit(""))
    depth = digits
    if counts is None:
        counts = bucket_counts(rows, group, order, digits)
    while True:
        upto = F.sum("_n").over(
            Window.partitionBy(*node)
            .orderBy("_bucket")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        before = F.col("_upto") - F.col("_n")
        hit = (
            counts.withColumn("_upto", upto)
            .join(open_ranks, node)
            .where((F.col("rank") <= F.col("_upto")) & (F.col("rank") > before))
            .select(
                *group,
                F.col("_bucket").alias("_path"),
                "label",
                (F.col("rank") - before).alias("rank"),
                "_n",
            )
        )
        found = derived_lookup(hit, max_lookup_rows)
        if found.fits:
            largest = max((row["_n"] for row in found.rows), default=0)
        else:
            largest = found.table.agg(F.max("_n")).first()[0]
        if depth >= width:
            # All digits are used: a bucket is a single value.
            return found.table.select(
                *group,
                "label",
                F.col("_path").alias("cut"),
                (F.col("rank") < F.col("_n")).alias("tied"),
            )
        keys = Lookup(found.table.select(*node).distinct(), found.fits)
        inside = rows.withColumn("_path", F.substring(F.col(order), 1, depth))
        if found.fits and len(found.rows) <= FILTER_PATHS:
            # Most rows are in no wanted bucket of any group: a plain filter drops them first.
            inside = inside.where(F.col("_path").isin({row["_path"] for row in found.rows}))
        scope = join_lookup(
            inside,
            keys,
            node,
            "left_semi",
            spread_by=[order],
        )
        if largest <= sortable_rows:
            break
        open_ranks = found.table.drop("_n")
        depth = min(depth + digits, width)
        counts = scope.groupBy(
            *node, F.substring(F.col(order), 1, depth).alias("_bucket")
        ).agg(F.count(F.lit(1)).alias("_n"))
    place = Window.partitionBy(*node).orderBy(order)
    return (
        scope.select(
            *node,
            F.col(order).alias("cut"),
            F.row_number().over(place).cast("bigint").alias("rank"),
            F.lead(order).over(place).alias("_next"),
        )
        .join(F.broadcast(found.table) if found.fits else found.table, [*node, "rank"])
        .select(
            *group,
            "label",
            "cut",
            F.coalesce(F.col("_next") == F.col("cut"), F.lit(False)).alias("tied"),
        )
    )


def with_places(
    rows: DataFrame, order: str, width: int, place: str, bucket_rows: int = SORTABLE_ROWS
) -> DataFrame:
    """Add the 1-based place of each row by ``order``, a hash of ``width`` hex digits.

    Buckets of leading digits hold about ``bucket_rows`` rows at most, as hashes spread evenly;
    a window sums up the counts of the buckets, another numbers the rows of each. Rows with one
    value of ``order`` share a bucket and are numbered in some order.
    """
    digits, total = 1, rows.count()
    while digits < width and total >> (4 * digits) > bucket_rows // 2:
        digits += 1
    bucketed = rows.withColumn("_bucket", F.substring(F.col(order), 1, digits))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # The first digit keeps the sums of the buckets apart, so that no window holds them all.
    top = F.substring("_bucket", 1, max(digits - 4, 1))
    counts = counts.withColumn("_top", top)
    tops = counts.groupBy("_top").agg(F.sum("_n").alias("_all"))
    ahead = Window.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    tops = tops.select(
        "_top", F.coalesce(F.sum("_all").over(ahead.orderBy("_top")), zero).alias("_above")
    )
    inside = Window.partitionBy("_top").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.join(tops, "_top").select(
        "_bucket",
        (F.col("_above") + F.coalesce(F.sum("_n").over(inside), zero)).alias("_before"),
    )
    numbered = Window.partitionBy("_bucket").orderBy(order)
    return (
        bucketed.withColumn("_in", F.row_number().over(numbered))
        .join(starts, "_bucket")
        .withColumn(place, F.col("_before") + F.col("_in"))
        .drop("_bucket", "_in", "_before")
    )
