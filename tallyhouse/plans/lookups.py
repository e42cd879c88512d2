"""Many-to-one joins that stay even under hot keys.

A lookup has one row per key. It is broadcast only after its rows and their bytes are known to
be within bounds. Beyond the bound both sides are shuffled by key, and the few keys that hold
a large share of the big side are salted: their lookup row is repeated once per salt.
"""

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.plans.shared import checkpointed

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64_000_000
SALTS = 256
# A key is hot from this share of the rows on, so there are at most 1000 of them.
HOT_SHARE = 0.001
TRACKED_KEYS = 8192
SKETCH_GROUPS = 128
# Types whose Python values Arrow reads without help.
FLAT_TYPES = (T.StringType, T.IntegralType, T.DoubleType, T.BooleanType, T.DateType)


@dataclass(frozen=True)
class Lookup:
    """A table with one row per key, and whether it is known to fit a broadcast.

    ``rows`` are the rows of a small derived table, which passed through the driver.
    """

    table: DataFrame
    fits: bool
    rows: tuple[Row, ...] | None = None


def local_table(rows: Sequence[Row | tuple], schema: T.StructType, spark: SparkSession) -> DataFrame:
    """A few rows as a table held in the plan itself, whose size the optimizer knows."""
    if not all(isinstance(f.dataType, FLAT_TYPES) for f in schema.fields):
        return spark.createDataFrame(list(rows), schema)
    columns = {
        f.name: pa.array([row[i] for row in rows]) for i, f in enumerate(schema.fields)
    }
    return spark.createDataFrame(pa.table(columns), schema)


def row_bytes(schema: T.StructType) -> Column:
    """About the size of a row: eight bytes a number, else as many as its bytes or text has."""
    sizes = []
    for field in schema:
        value = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(value), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.coalesce(F.octet_length(value.cast("string")), F.lit(0)))
        sizes.append(F.lit(8))
    return reduce(Column.__add__, [size.cast("bigint") for size in sizes], F.lit(0).cast("bigint"))


def within_bounds(table: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Whether a table is small in rows and in bytes; only sizes of so many rows are looked at."""
    sizes = table.select(row_bytes(table.schema).alias("n")).take(max_rows + 1)
    return len(sizes) <= max_rows and sum(row["n"] for row in sizes) <= max_bytes


def derived_lookup(
    table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> Lookup:
    """Compute a derived table once: held as local rows within the bounds, else checkpointed."""
    table.persist()
    try:
        if within_bounds(table, max_rows, max_bytes):
            rows = table.collect()
            local = local_table(rows, table.schema, table.sparkSession)
            return Lookup(local, True, tuple(rows))
        return Lookup(checkpointed(table), False)
    finally:
        table.unpersist()


def stored_lookup(
    table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> Lookup:
    """Classify a table that is cheap to read again, looking at no more rows than the bound."""
    return Lookup(table, within_bounds(table, max_rows, max_bytes))


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold at least about ``share`` of the rows.

    A frequent-items sketch over the key columns: no key is shuffled. Input partitions are
    merged into a fixed number of groups, and only the short top list of each group comes to
    the driver. A miss would cost time, never a wrong result.
    """
    item = F.xxhash64(*[F.col(c) for c in on])
    most = int(1 / share)
    groups = (
        df.select(item.alias("k"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g"))
        .groupBy("g")
        .agg(
            F.expr(f"approx_top_k(k, {most}, {max(most, TRACKED_KEYS)})").alias("top"),
            F.count(F.lit(1)).alias("n"),
        )
        .collect()
    )
    counts = Counter()
    for group in groups:
        counts.update({row["item"]: row["count"] for row in group["top"]})
    total = sum(group["n"] for group in groups)
    return [key for key, n in counts.most_common(most) if n >= share * total]


def join_lookup(
    big: DataFrame,
    lookup: Lookup,
    on: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    salts: int = SALTS,
    share: float = HOT_SHARE,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Join ``big`` to a lookup with ``how`` in inner, left, left_semi, left_anti.

    ``spread_by`` names columns of ``big`` that differ between rows of one key (its unique
    key at best). The salt is their hash, so a rerun task gives each row the same salt.
    Beyond the bound ``big`` is read twice, for its hot keys and for the join: store it first
    if it is expensive, or hand over ``hot`` from ``hot_keys`` if it is joined often.
    """
    on = list(on)
    types = [dict(side.dtypes) for side in (big, lookup.table)]
    if any(types[0][c] != types[1][c] for c in on):
        raise ValueError(f"The key columns {on} must have the same types on both sides")
    if lookup.fits:
        return big.join(F.broadcast(lookup.table), on, how)
    hot = hot_keys(big, on, share) if hot is None else list(hot)
    if not hot:
        return big.join(lookup.table, on, how)
    is_hot = F.xxhash64(*[F.col(c) for c in on]).isin(hot)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(salts)).cast("int")
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    repeated = lookup.table.withColumn(
        "_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0))))
    )
    return (
        big.withColumn("_salt", F.when(is_hot, salt).otherwise(F.lit(0)))
        .join(repeated, [*on, "_salt"], how)
        .drop("_salt")
    )
