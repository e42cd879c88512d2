"""Tables stored by key: joins and groupings on the key need no exchange.

A stored table is a folder with ``rows``, bucketed Parquet, and ``layout``, one JSON row that
says how it was written. The layout comes last, so a folder without one is not a table. Any
session opens the folder by its path; only a name in the session's catalog is made for it.
"""

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYOUT = "layout_version int, key array<string>, buckets int, columns string"
LAYOUT_VERSION = 1
# About so many rows go to a bucket, in a power of two of buckets within the bounds.
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 8
MOST_BUCKETS = 1 << 16


def bucket_count(n_rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """The power of two that gives at most ``bucket_rows`` a bucket on average, within bounds."""
    wanted = max(1, -(-n_rows // bucket_rows))
    return min(max(1 << (wanted - 1).bit_length(), LEAST_BUCKETS), MOST_BUCKETS)


def layout_of(spark: SparkSession, folder: str) -> Row:
    """Key, number of buckets and columns of a stored table; refused if there is none."""
    try:
        rows = spark.read.schema(LAYOUT).json(f"{folder}/layout").take(2)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise FileNotFoundError(f"No table stored by key in {folder}") from error
    if len(rows) != 1 or rows[0]["layout_version"] != LAYOUT_VERSION:
        raise ValueError(f"Unsupported layout in {folder}")
    return rows[0]


def store_by_key(
    df: DataFrame, folder: str, key: Sequence[str], like: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Write ``df`` once to a new folder, dealt and sorted by ``key``; returns it opened.

    Tables that are to be joined need the same number of buckets: name the folder of the other
    one as ``like``, or give ``buckets``. Otherwise the rows are counted first. Rows with a
    null in the key are kept; they share one bucket, as do the rows of any single key, so
    choose keys that are unique or nearly so. An empty table is stored like any other. An
    existing folder is refused.
    """
    key = list(key)
    missing = [c for c in key if c not in df.columns]
    if missing or not key:
        raise ValueError(f"The key must name columns of the table: {missing or key}")
    spark = df.sparkSession
    if like is not None:
        other = layout_of(spark, like)
        types = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(other["columns"]))}
        here = [df.schema[c].dataType for c in key]
        if here != [types[c] for c in other["key"]]:
            raise ValueError("The keys of tables stored alike must have the same types")
        buckets = other["buckets"]
    elif buckets is None:
        buckets = bucket_count(df.count())
    _write(df, folder, key, buckets, "errorifexists")
    row = (LAYOUT_VERSION, key, buckets, df.schema.json())
    spark.createDataFrame([row], LAYOUT).coalesce(1).write.mode("errorifexists").json(f"{folder}/layout")
    return open_by_key(spark, folder)


def append_by_key(df: DataFrame, folder: str) -> DataFrame:
    """Add rows to a stored table in its layout, such as records that came later.

    Columns are taken by name and must be those of the table, with the same types. Only the
    new rows are dealt out.
    """
    spark = df.sparkSession
    known = open_by_key(spark, folder)
    fields = {f.name: f.dataType for f in known.schema}
    if {f.name: f.dataType for f in df.schema} != fields or len(df.columns) != len(fields):
        raise ValueError("Appended rows must have the columns and types of the stored table")
    layout = layout_of(spark, folder)
    _write(df.select(*map(_quoted, known.columns)), folder, list(layout["key"]), layout["buckets"], "append")
    return open_by_key(spark, folder)


def open_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """The stored table; its scan tells the optimizer how the rows are dealt out."""
    layout = layout_of(spark, folder)
    schema = T.StructType.fromJson(json.loads(layout["columns"]))
    name = _name(folder)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
        key = ", ".join(map(_quoted, layout["key"]))
        place = _rows(folder).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {layout['buckets']} BUCKETS LOCATION '{place}'"
        )
    spark.catalog.refreshTable(name)
    return spark.table(name)


def forget(spark: SparkSession, folder: str) -> None:
    """Take the table's name from the session's catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(folder)}")


def _write(df: DataFrame, folder: str, key: list[str], buckets: int, mode: str) -> None:
    # Rows are dealt as buckets are, so that each task writes the one file of its bucket.
    dealt = df.repartition(buckets, *map(F.col, map(_quoted, key)))
    writer = dealt.write.format("parquet").mode(mode).bucketBy(buckets, *key).sortBy(*key)
    writer.option("path", _rows(folder)).saveAsTable(_name(folder))


def _rows(folder: str) -> str:
    return f"{folder.rstrip('/')}/rows"


def _name(folder: str) -> str:
    return f"keyed_{hashlib.sha256(folder.rstrip('/').encode()).hexdigest()[:24]}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
