"""Fingerprints of tables and folders (F1, F2)."""

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.hashing import hex_value, row_text
from tallyhouse.plans.lookups import join_lookup, stored_lookup
from tallyhouse.plans.shared import written

PART_BITS = 20
# A bucket of a folder's hash tree holds about so many files at most; a node has 16 children.
BUCKET_FILES = 256
MOST_LEVELS = 12


def table_fingerprint(
    df: DataFrame, columns: Sequence[str | Column] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """SHA-256 of row count and sums of row-hash parts: the order of rows does not matter.

    One pass and a tiny shuffle. Sixty bits of each row's hash are added up in three parts of
    twenty, so a plain long holds the sums of more than eight million million rows.
    """
    chosen = [F.col(c) if isinstance(c, str) else c for c in (columns or df.columns)]
    value = hex_value(F.md5(row_text(chosen)), 1, 15)
    part = F.lit((1 << PART_BITS) - 1)
    sums = df.select(*by, value.alias("_v")).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.coalesce(F.sum(F.shiftright("_v", PART_BITS * i).bitwiseAND(part)), F.lit(0))
            .cast("string")
            .alias(f"_part{i}")
            for i in range(3)
        ],
    )
    text = F.concat_ws("|", F.col("n_rows").cast("string"), *[f"_part{i}" for i in range(3)])
    return sums.select(*by, "n_rows", F.sha2(text, 256).alias("fingerprint"))


def fingerprint(df: DataFrame) -> str:
    return table_fingerprint(df).first()["fingerprint"]


def file_digests(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Path and SHA-256 of each file, given a table in the shape of the binaryFile source.

    That source does not list empty files, nor names that begin with ``_`` or ``.``: add their
    rows (an empty file has the SHA-256 of nothing) where a folder digest has to cover them.
    """
    return df.select(F.col(path).alias("path"), F.sha2(F.col(content), 256).alias("sha256"))


def folder_digest(files: DataFrame, folder: str, path: str, digest: str) -> DataFrame:
    """SHA-256 per folder over path, a zero byte and the file's digest, in order of path parts.

    Contents are hashed where they are read; only paths and digests move. A running SHA-256
    is sequential by definition, so each folder is streamed in sorted order through one hash
    object, batch by batch: memory does not grow with the folder. One folder is the work of
    one task: use this for folders of models and reports, ``table_fingerprint`` for tables.
    """
    rows = (
        files.select(
            F.col(folder).cast("string").alias("folder"),
            F.col(path).alias("path"),
            F.col(digest).alias("digest"),
        )
        .withColumn("_parts", F.split("path", "/"))
        .repartition("folder")
        .sortWithinPartitions("folder", "_parts")
        .drop("_parts")
    )
    return rows.mapInPandas(_stream_folders, "folder string, n_files bigint, sha256 string")


def folder_tree(
    files: DataFrame, folder: str, path: str, digest: str, bucket_files: int = BUCKET_FILES
) -> DataFrame:
    """(folder, n_files, levels, sha256): a folder's digest by a hash tree, for folders of any size.

    A leaf is the SHA-256 of path, zero byte and the file's digest. The first hex digits of the
    path's SHA-256 choose a bucket, whose digest covers its leaves in order of paths, then digests; above, a node
    covers the digit and digest of each of its at most 16 children. ``levels`` follows from the
    number of files alone: as few as keep the mean bucket within ``bucket_files``. So the digest
    depends on paths and digests only, one folder is the work of many tasks, and no group grows
    with the folder. It is another value than ``folder_digest``, which stays for parity. Rows
    without path or digest are left out; files that repeat are covered as often.
    """
    rows = written(
        files.select(
            F.col(folder).cast("string").alias("folder"),
            F.col(path).cast("string").alias("path"),
            F.col(digest).alias("digest"),
        ).where("path is not null and digest is not null"),
        "tree-files",
    ).withColumns({"_missing": F.col("folder").isNull(), "folder": F.coalesce("folder", F.lit(""))})
    of_folder = ["_missing", "folder"]
    n = F.count(F.lit(1))
    levels = reduce(
        lambda more, k: F.when(F.col("n_files") > bucket_files * 16**k, k + 1).otherwise(more),
        range(MOST_LEVELS),
        F.lit(0),
    )
    counts = written(
        rows.groupBy(*of_folder).agg(n.alias("n_files")).withColumn("levels", levels), "tree-counts"
    )
    placed = join_lookup(rows, stored_lookup(counts), of_folder, "inner", spread_by=["path"])
    leaf = F.sha2(F.concat(F.col("path").cast("binary"), F.lit(b"\x00"), F.unhex("digest")), 256)
    bucket = F.substring(F.sha2(F.col("path").cast("binary"), 256), F.lit(1), F.col("levels"))
    node = [*of_folder, "n_files", "levels", "_at"]

    def covered(pairs):
        parts = F.transform(F.array_sort(F.collect_list(pairs)), lambda p: p["_covers"])
        return F.sha2(F.unhex(F.concat_ws("", parts)), 256).alias("sha256")

    nodes = (
        placed.withColumns({"_at": bucket, "_covers": leaf})
        .groupBy(*node)
        .agg(covered(F.struct("path", "digest", "_covers")))
    )
    deepest = counts.agg(F.max("levels")).first()[0] or 0
    for level in range(deepest, 0, -1):
        # Nodes of smaller trees wait until their level is reached.
        here = F.length("_at") == level
        child = F.struct(
            F.when(here, F.substring("_at", -1, 1)).otherwise("").alias("_digit"),
            F.when(here, F.concat(F.lit("0"), F.substring("_at", -1, 1), "sha256"))
            .otherwise(F.col("sha256"))
            .alias("_covers"),
        )
        above = nodes.withColumns({"_child": child, "_up": here, "_at": F.when(here, F.substring("_at", 1, level - 1)).otherwise(F.col("_at"))})
        nodes = above.groupBy(*node, "_up").agg(
            covered(F.col("_child")).alias("_joined"), F.first("sha256").alias("_own")
        ).select(*node, F.when(F.col("_up"), F.col("_joined")).otherwise(F.col("_own")).alias("sha256"))
    named = F.when(~F.col("_missing"), F.col("folder")).alias("folder")
    return nodes.select(named, "n_files", F.col("levels").cast("int").alias("levels"), "sha256")


def _stream_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    folder, running, n = None, None, 0
    for batch in batches:
        done = []
        for name, rows in groupby(batch.itertuples(index=False, name=None), key=itemgetter(0)):
            if running is None or name != folder:
                if running is not None:
                    done.append((folder, n, running.hexdigest()))
                folder, running, n = name, hashlib.sha256(), 0
            parts = [path.encode() + b"\0" + bytes.fromhex(digest) for _, path, digest in rows]
            running.update(b"".join(parts))
            n += len(parts)
        if done:
            yield pd.DataFrame(done, columns=["folder", "n_files", "sha256"])
    if running is not None:
        yield pd.DataFrame([(folder, n, running.hexdigest())], columns=["folder", "n_files", "sha256"])
