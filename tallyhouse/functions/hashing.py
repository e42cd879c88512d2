"""Hash expressions that another SQL engine can recompute."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_hash(seed: int, key: str | Column) -> Column:
    """Seeded pseudo-random order of a key: 32 hex digits, the same on any partitioning.

    A null key has a null hash.
    """
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), column.cast("string")))


def row_text(columns: Sequence[Column]) -> Column:
    """Unambiguous text of a row: every value carries its length, a null is ``N``."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N"))
        )
    return F.concat(*parts)


def hex_value(digest: Column, start: int, length: int) -> Column:
    """Unsigned integer value of some hex digits (up to 15) of a digest."""
    return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")
