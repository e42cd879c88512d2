"""Arrow helpers for tasks that work on texts with numpy."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK_CHARS = 1 << 20
BATCH_BYTES = 8 << 20
# Multiplier of the rolling hashes (fixed value, odd).
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``limit`` characters, at least one text each."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BATCH_BYTES``, which bounds a task's memory."""
    for batch in batches:
        rows = max(1, batch.num_rows * BATCH_BYTES // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def with_columns(df: DataFrame, added: T.StructType) -> T.StructType:
    """The schema of ``df`` without the columns that ``added`` replaces, then ``added``."""
    names = set(added.names)
    return T.StructType([f for f in df.schema.fields if f.name not in names] + added.fields)


def map_texts(
    df: DataFrame, added: T.StructType, compute: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """Add columns computed batch by batch; columns of the same names are replaced."""
    schema = with_columns(df, added)
    kept = [name for name in schema.names if name not in set(added.names)]

    def run(batches):
        for batch in slices(batches):
            columns = [batch.column(name) for name in kept] + compute(batch)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit values (the finalizer of SplitMix64)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive values; empty if there are fewer."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        total *= FACTOR
        total += values[k : k + count]
    return mixed(total)
