"""Short codes for vectors: each part of a vector becomes the index of its nearest codebook entry.

All arithmetic is on whole numbers. The parts are sorted along a Hilbert curve and cut into flat
blocks that carry their box, count and sums. A round compares the boxes with the entries first: an
entry farther from a whole box than another entry can ever be is not looked at in that block, and a
block with one entry left is added by its sums, without its points.
"""

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.batches import slices
from tallyhouse.llm.registry import query, table
from tallyhouse.llm.scratch import Scratch
from tallyhouse.plans.lookups import join_lookup, stored_lookup
from tallyhouse.plans.shared import written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK_ROWS = 256
# Blocks whose boxes are compared with the entries at once.
BOXES = 64
KEY_BITS = 63
PARTITION_ROWS = 500_000
LEAST_PARTITIONS = 12
# Sums of products below this are exact in double precision, whose multiplication is faster.
EXACT = 1 << 53


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of grid cells (rows of ``bits``-bit coordinates).

    Skilling's transform, one step for all rows at a time; bits times columns are at most 63.
    """
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(d):
            turned = (x[i] >> bit) & 1 == 1
            swapped = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swapped)
            x[i] ^= swapped
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flips = np.zeros(x.shape[1], dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[d - 1] >> bit) & 1 == 1, (1 << bit) - 1, 0) if d else 0
    keys = np.zeros(x.shape[1], dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            keys = (keys << 1) | (((x[i] ^ flips) >> bit) & 1)
    return keys


def whole_numbers(df: DataFrame, ids: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, v): vectors as floors of ``scale`` times their components.

    Rows whose vector is null or holds a null, NaN or infinity are dropped.
    """
    x = F.col(vector).cast("array<double>")
    finite = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    scaled = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint"))
    return df.where(F.col(vector).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(ids).alias("vec_id"),
        F.col(label).alias("label"),
        scaled.alias("v"),
    )


@dataclass(frozen=True)
class Spread:
    """Number, width, largest absolute component, mean and deviation of all kept vectors."""

    rows: int
    width: int
    largest: int
    mean: float
    deviation: float


def spread_of(rows: DataFrame, parts: int) -> Spread:
    """One pass over the vectors; unequal or indivisible widths and too large numbers raise."""
    v = F.col("v")
    zero = F.lit(0.0)
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.size(v)).alias("least"),
        F.max(F.size(v)).alias("most"),
        F.max(F.array_max(F.transform(v, F.abs))).alias("largest"),
        F.sum(F.aggregate(v, zero, lambda a, c: a + c)).alias("total"),
        F.sum(F.aggregate(v, zero, lambda a, c: a + c.cast("double") * c)).alias("squares"),
    ).first()
    if not found["n"]:
        return Spread(0, 0, 0, 0.0, 0.0)
    width, largest = found["most"], found["largest"] or 0
    if found["least"] != width or width % parts:
        raise ValueError(f"Vectors must have one width that {parts} divides")
    # Half an int64 for squared distances, 31 bits for the stored components.
    if largest >= 1 << 30 or width // parts * (2 * largest + 2) ** 2 >= 1 << 62:
        raise ValueError("Components are too large for exact squared distances in 64 bits")
    n = max(found["n"] * width, 1)
    mean = found["total"] / n
    deviation = max(found["squares"] / n - mean * mean, 0.0) ** 0.5
    return Spread(found["n"], width, largest, mean, deviation)


def _keyed(rows: DataFrame, spread: Spread, parts: int) -> DataFrame:
    """(row, vec_id, label, part, key, point), a row for each part of each vector."""
    d = spread.width // parts
    used = min(d, KEY_BITS)
    bits = min(KEY_BITS // max(used, 1), 8)
    low, cell = spread.mean - 3 * spread.deviation, max(6 * spread.deviation, 1.0) / (1 << bits)
    fields = {f.name: f for f in rows.schema.fields}
    schema = T.StructType(
        [fields["row"], fields["vec_id"], fields["label"]]
        + [
            T.StructField("part", T.IntegerType()),
            T.StructField("key", T.LongType()),
            T.StructField("point", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches):
        for batch in slices(batches):
            n = batch.num_rows
            x = batch.column("v").flatten().to_numpy().reshape(n, parts, d)
            for p in range(parts):
                cells = np.clip(np.floor((x[:, p, :used] - low) / cell), 0, (1 << bits) - 1)
                points = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1, dtype=np.int32) * d),
                    pa.array(np.ascontiguousarray(x[:, p]).ravel().astype(np.int32)),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row"),
                        batch.column("vec_id"),
                        batch.column("label"),
                        pa.array(np.full(n, p, dtype=np.int32)),
                        pa.array(hilbert_keys(cells, bits)),
                        points,
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def _lists(values: pa.Array, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values)


def _block_schema(keyed: DataFrame) -> T.StructType:
    kinds = {f.name: f.dataType for f in keyed.schema.fields}
    numbers = T.ArrayType(T.IntegerType())
    return T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("points", numbers),
            T.StructField("low", numbers),
            T.StructField("high", numbers),
            T.StructField("sums", T.ArrayType(T.LongType())),
            T.StructField("rows", T.ArrayType(kinds["row"])),
            T.StructField("vec_ids", T.ArrayType(kinds["vec_id"])),
            T.StructField("labels", T.ArrayType(kinds["label"])),
        ]
    )


def blocks_of(keyed: DataFrame, spread: Spread, parts: int) -> DataFrame:
    """Flat blocks of neighbours along the curve, each of one part and at most BLOCK_ROWS points.

    Equal points are ordered by row number, so a group of copies of any size is cut too.
    """
    d = spread.width // parts
    partitions = max(LEAST_PARTITIONS, -(-spread.rows * parts // PARTITION_ROWS))
    order = ["part", "key", "row"]
    ordered = keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    schema = _block_schema(keyed)

    def run(batches):
        for batch in slices(batches):
            n = batch.num_rows
            if not n:
                continue
            part = batch.column("part").to_numpy()
            x = batch.column("point").flatten().to_numpy().reshape(n, d)
            turns = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [n]))
            starts = np.concatenate(
                [np.arange(a, b, BLOCK_ROWS) for a, b in zip(turns[:-1], turns[1:])]
            )
            bounds = np.append(starts, n)
            flat = np.arange(len(starts) + 1) * d
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[starts]),
                    pa.array(np.diff(bounds).astype(np.int32)),
                    _lists(pa.array(x.ravel()), bounds * d),
                    _lists(pa.array(np.minimum.reduceat(x, starts, axis=0).ravel()), flat),
                    _lists(pa.array(np.maximum.reduceat(x, starts, axis=0).ravel()), flat),
                    _lists(
                        pa.array(np.add.reduceat(x.astype(np.int64), starts, axis=0).ravel()), flat
                    ),
                    _lists(batch.column("row"), bounds),
                    _lists(batch.column("vec_id"), bounds),
                    _lists(batch.column("label"), bounds),
                ],
                names=schema.names,
            )

    return ordered.mapInArrow(run, schema)


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For boxes and entries: may the entry be nearest, or equally near, to a point of the box?"""
    below, above = low[:, None, :] - entries, entries - high[:, None, :]
    nearest = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
    farthest = (np.maximum(entries - low[:, None, :], high[:, None, :] - entries) ** 2).sum(axis=2)
    return nearest <= farthest.min(axis=1, keepdims=True)


def nearest(points: np.ndarray, entries: np.ndarray, exact_floats: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry; the lower index wins a tie."""
    if exact_floats:
        x, e = points.astype(np.float64), entries.astype(np.float64)
        far = (x * x).sum(axis=1)[:, None] - 2 * (x @ e.T) + (e * e).sum(axis=1)
    else:
        far = np.empty((len(points), len(entries)), dtype=np.int64)
        for j, entry in enumerate(entries):
            far[:, j] = ((points - entry) ** 2).sum(axis=1)
    best = far.argmin(axis=1)
    return best, far[np.arange(len(points)), best].astype(np.int64)


def _assigned(
    batch: pa.RecordBatch, books: list[np.ndarray], exact_floats: bool, whole: Callable | None
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, its points, entry of each, squared distance of each).

    ``whole`` takes (part, entry, count, sums) of a block with one entry left instead.
    """
    n, d, part = batch.num_rows, books[0].shape[1], batch.column("part").to_numpy()
    count = batch.column("n").to_numpy()

    def numbers(name):
        return batch.column(name).flatten().to_numpy().astype(np.int64)

    low, high = numbers("low").reshape(n, d), numbers("high").reshape(n, d)
    points, sums = numbers("points").reshape(int(count.sum()), d), numbers("sums").reshape(n, d)
    ends = np.cumsum(count)
    for p, entries in enumerate(books):
        of_part = np.flatnonzero(part == p)
        for first in range(0, len(of_part), BOXES):
            chosen = of_part[first : first + BOXES]
            for block, may in zip(chosen, shortlists(low[chosen], high[chosen], entries)):
                short = np.flatnonzero(may)
                if whole is not None and len(short) == 1:
                    whole(p, short[0], count[block], sums[block])
                    continue
                x = points[ends[block] - count[block] : ends[block]]
                best, far = nearest(x, entries[short], exact_floats)
                yield block, x, short[best], far


PARTIAL = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("entry", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("sums", T.ArrayType(T.LongType())),
    ]
)


def next_books(blocks: DataFrame, books: list[np.ndarray], exact_floats: bool) -> list[np.ndarray]:
    """One round: every point to its nearest entry, every used entry to the floor of its mean.

    A task sends one row for each entry that it used; the driver gets one for each entry.
    """
    d = books[0].shape[1]

    def run(batches):
        count = [np.zeros(len(b), dtype=np.int64) for b in books]
        total = [np.zeros(b.shape, dtype=np.int64) for b in books]

        def whole(part, entry, n, sums):
            count[part][entry] += n
            total[part][entry] += sums

        for batch in slices(batches):
            part = batch.column("part").to_numpy()
            for block, x, best, _ in _assigned(batch, books, exact_floats, whole):
                used, place = np.unique(best, return_inverse=True)
                order = np.argsort(place, kind="stable")
                starts = np.searchsorted(place[order], np.arange(len(used)))
                total[part[block]][used] += np.add.reduceat(x[order], starts, axis=0)
                count[part[block]][used] += np.bincount(place, minlength=len(used))
        where = [(p, e) for p in range(len(books)) for e in np.flatnonzero(count[p])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in where], pa.int32()),
                pa.array([e for _, e in where], pa.int32()),
                pa.array([count[p][e] for p, e in where], pa.int64()),
                pa.array([total[p][e].tolist() for p, e in where], pa.list_(pa.int64())),
            ],
            names=PARTIAL.names,
        )

    summed = (
        blocks.select("part", "n", "points", "low", "high", "sums")
        .mapInArrow(run, PARTIAL)
        .groupBy("part", "entry")
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(d)])
    )
    changed = [book.copy() for book in books]
    for found in summed.collect():
        changed[found["part"]][found["entry"]] = [found[f"s{j}"] // found["n"] for j in range(d)]
    return changed


def coded(blocks: DataFrame, books: list[np.ndarray], exact_floats: bool) -> DataFrame:
    """(vec_id, label, code, error) of every vector: two hex digits a part, summed distances."""
    parts = len(books)
    kinds = {f.name: f.dataType for f in blocks.schema.fields}
    schema = T.StructType(
        [
            T.StructField("row", kinds["rows"].elementType),
            T.StructField("vec_id", kinds["vec_ids"].elementType),
            T.StructField("label", kinds["labels"].elementType),
            T.StructField("shifted", T.LongType()),
            T.StructField("far", T.LongType()),
        ]
    )

    def run(batches):
        for batch in slices(batches):
            part, count = batch.column("part").to_numpy(), batch.column("n").to_numpy()
            starts = np.cumsum(count) - count
            code = np.zeros(int(count.sum()), dtype=np.int64)
            far = np.zeros(len(code), dtype=np.int64)
            for block, _, best, distance in _assigned(batch, books, exact_floats, None):
                at = slice(starts[block], starts[block] + count[block])
                code[at] = best << (8 * (parts - 1 - int(part[block])))
                far[at] = distance
            columns = [batch.column(c).flatten() for c in ("rows", "vec_ids", "labels")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(code), pa.array(far)], names=schema.names
            )

    return (
        blocks.mapInArrow(run, schema)
        .groupBy("row", "vec_id", "label")
        .agg(F.sum("shifted").alias("code"), F.sum("far").alias("error"))
        .select(
            "vec_id",
            "label",
            F.lower(F.lpad(F.hex("code"), 2 * parts, "0")).alias("code"),
            "error",
        )
    )


def first_books(rows: DataFrame, spread: Spread, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids; null ids come last, ties by the vector."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    start = np.array([r["v"] for r in first], dtype=np.int64)
    start = start.reshape(len(first), parts, spread.width // parts)
    return [np.ascontiguousarray(start[:, p]) for p in range(parts)]


def books_sha256(books: list[np.ndarray]) -> str:
    """Digest of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(c) for b in books for c in b.ravel()).encode()).hexdigest()


def compress(
    df: DataFrame,
    ids: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all vectors, and the codebooks: (vec_id, label, code, error, label_error).

    Rows whose vector is null or holds a null or a number that is not finite are dropped. Ids may
    be null or repeat: each row is a vector of its own. With fewer than ``entries`` rows the
    codebooks are as short; an empty table gives no rows and empty codebooks. Equal vectors get
    equal codes; of equally near entries the lower one is taken. ``label_error`` is the sum of
    ``error`` over rows with the same label, nulls being one label. Other columns are left out.
    Vectors of unequal widths, widths that ``parts`` does not divide and components whose squared
    distances leave 64 bits raise ValueError.
    """
    if not 0 < entries <= 256 or not 0 < parts <= 7:
        raise ValueError("A part's code has two hex digits, and a code at most seven parts")
    scratch = Scratch(df.sparkSession)
    rows = scratch.keep(whole_numbers(df, ids, vector, label, scale), "vector-rows")
    spread = spread_of(rows, parts)
    if not spread.rows:
        books = [np.zeros((0, 0), dtype=np.int64) for _ in range(parts)]
    else:
        books = first_books(rows, spread, parts, entries)
    keyed = scratch.keep(_keyed(rows, spread, parts), "vector-keys")
    scratch.drop(rows)
    blocks = scratch.keep(blocks_of(keyed, spread, parts), "vector-blocks")
    scratch.drop(keyed)
    exact_floats = spread.width // parts * (2 * spread.largest + 2) ** 2 < EXACT
    if spread.rows and spread.width:
        for _ in range(rounds):
            books = next_books(blocks, books, exact_floats)
    codes = written(coded(blocks, books, exact_floats), "vector-codes")
    scratch.drop(blocks)
    # Labels may be of any type and null: their text and a mark stand for them in the join.
    key = {"_label": F.coalesce(F.col("label").cast("string"), F.lit("")), "_null": F.col("label").isNull()}
    codes = codes.withColumns(key)
    totals = codes.groupBy("_label", "_null").agg(F.sum("error").alias("label_error"))
    lookup = stored_lookup(written(totals, "vector-labels"))
    joined = join_lookup(codes, lookup, ["_label", "_null"], "left", spread_by=["vec_id", "code"])
    return joined.drop("_label", "_null"), books


def _op12_sql() -> str:
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT row, part, min(far * 256 + entry) AS m
  FROM (SELECT x.row, x.part, e.entry, sum((x.val - e.val) * (x.val - e.val))::BIGINT AS far
        FROM x JOIN e{i} e USING (part, pos) GROUP BY ALL) GROUP BY ALL)""")
        if i < ROUNDS:
            steps.append(f"""
s{i} AS (SELECT a.part, a.m % 256 AS entry, x.pos, sum(x.val)::BIGINT AS s, count(*) AS n
       FROM a{i} a JOIN x USING (row, part) GROUP BY ALL),
e{i + 1} AS MATERIALIZED (
  SELECT e.part, e.entry, e.pos, coalesce((s - ((s % n) + n) % n) // n, e.val) AS val
  FROM e{i} e LEFT JOIN s{i} USING (part, entry, pos))""")
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS row, vec_id, label, len(embedding) // {PARTS} AS d,
         list_transform(embedding, lambda c: floor({SCALE} * c)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (
  SELECT row, (i - 1) // d AS part, (i - 1) % d AS pos, val
  FROM (SELECT row, d, unnest(v) AS val, generate_subscripts(v, 1) AS i FROM k)),
e0 AS (SELECT part, row AS entry, pos, val FROM x WHERE row < {ENTRIES}),
{",".join(steps)},
h AS (SELECT sha256(string_agg(val::VARCHAR, ',' ORDER BY part, entry, pos)) AS sha FROM e{ROUNDS}),
c AS (SELECT row, string_agg(format('{{:02x}}', m % 256), '' ORDER BY part) AS code, sum(m // 256)::BIGINT AS error
      FROM a{ROUNDS} GROUP BY row)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
FROM c JOIN k USING (row), h
"""


@query("op12_vector_codes", _op12_sql())
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    codes, books = compress(table(spark, folder, "embeddings"))
    return codes.select(
        "vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256")
    )
