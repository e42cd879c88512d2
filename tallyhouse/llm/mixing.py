"""Mixing sources to target weights by a splitting tree over exact block quotas."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.registry import query, table
from tallyhouse.plans.lookups import join_lookup, stored_lookup
from tallyhouse.plans.shared import written

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MAX_REPEATS = 2
# Documents of a source are dealt to so many blocks, however many there are. So block tables
# grow with the number of sources alone, and a quota is off by about one part in 2,000.
BLOCKS = 1024
SHARDS = 8
SEED = 42
NODE = "first int, shards int, chunk int, key string, quota bigint"
NODE_COLUMNS = ["first", "shards", "chunk", "key", "quota"]
# Sources that one task splits at a node of the tree.
CHUNK_SOURCES = 1000


def word_count(text: Column) -> Column:
    """Runs of characters that are no ASCII blanks; 0 for null."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    """A key that is never null; null sources share one that sorts last."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("~"))


def block_of(doc_id: Column, source: Column, seed: int = SEED) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), source_key(source), doc_id), F.lit(BLOCKS)).cast("int")


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, total: float = TOTAL, most: float = MAX_REPEATS
) -> DataFrame:
    """One row per source: ``key``, ``source_size`` and ``target``.

    Sources in code point order, null last, get the weights in turn and share ``total``
    times all sizes. A target stops at ``most`` times its source's size; what is left over
    goes to the others by weight, until no target is above. ``total`` beyond ``most`` raises.
    The level of the shares is found by sums over the sources; the driver gets only sums.
    """
    if not 0 < total <= most:
        raise ValueError("The total must be above 0 and at most the greatest repeat")
    order = Window.orderBy("key")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    sources = written(
        sizes.groupBy(source_key(F.col("source")).alias("key"))
        .agg(F.sum("size").alias("source_size"))
        # One row per source: the window sees no documents.
        .withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
        .withColumn("cap", most * F.col("source_size")),
        "mix-sources",
    )
    words = (sources.agg(F.sum("source_size")).first()[0] or 0) * total
    level, capped = -1.0, -1
    while True:
        above = F.col("cap") < level * F.col("weight")
        row = sources.agg(
            F.count(F.when(above, 1)).alias("n"),
            F.sum(F.when(above, F.col("cap")).otherwise(0.0)).alias("caps"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], (words - row["caps"]) / row["open"]
    share = F.least(F.col("cap").cast("double"), F.lit(float(max(level, 0.0))) * F.col("weight"))
    return sources.select("key", "source_size", share.alias("target"))


def _permuted(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _choose(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies of each block of one source: whole passes, then blocks that fill the rest.

    Blocks are taken in random order as long as they fit, then exchanged. At most ``BLOCKS``
    rows are compared with each other.
    """
    rows = rows.sort_values(["_order", "block"])
    size, target = rows["source_size"].iloc[0], rows["target"].iloc[0]
    passes = int(target // size)
    words = rows["size"].to_numpy()
    extra = np.zeros(len(words), dtype=np.int64)
    left = target - passes * size
    if passes < MAX_REPEATS:
        for i, n in enumerate(words):
            if n <= left:
                extra[i] = 1
                left -= n
        # Take one more, leave one out or exchange two while that comes nearer.
        while left != 0:
            out, in_ = np.flatnonzero(extra == 0), np.flatnonzero(extra == 1)
            more = np.concatenate(([0], words[out]))[:, None] - np.concatenate(([0], words[in_]))
            plus, minus = np.unravel_index(np.abs(left - more).argmin(), more.shape)
            change = more[plus, minus]
            if abs(left - change) >= abs(left):
                break
            left -= change
            if plus:
                extra[out[plus - 1]] = 1
            if minus:
                extra[in_[minus - 1]] = 0
    return rows.assign(copies=passes + extra)[["key", "block", "copies"]]


def _drawn(quota: np.ndarray, n: int, seed: list[int]) -> np.ndarray:
    """A draw of ``n`` without replacement from groups of the given sizes."""
    return np.random.default_rng(seed).multivariate_hypergeometric(quota, n, method="marginals")


def _split(seed: int):
    def split(rows: pd.DataFrame) -> pd.DataFrame:
        """Hands the left half of a node its part of every source of one chunk."""
        rows = rows.sort_values("key").reset_index(drop=True)
        first, shards, chunk = (int(rows[c].iloc[0]) for c in ("first", "shards", "chunk"))
        if shards == 1:
            return rows[NODE_COLUMNS]
        left = shards // 2
        quota = rows["quota"].to_numpy(dtype=np.int64)
        n = rows["to_left"].iloc[0]
        n = int(quota.sum()) * left // shards if pd.isna(n) else int(n)
        drawn = _drawn(quota, n, [seed, first, shards] + [chunk] * (chunk > 0))
        rows = rows[NODE_COLUMNS]
        return pd.concat(
            [
                rows.assign(shards=left, quota=drawn),
                rows.assign(first=first + left, shards=shards - left, quota=quota - drawn),
            ]
        )

    return split


def _split_chunks(seed: int):
    def split(rows: pd.DataFrame) -> pd.DataFrame:
        """How many of each chunk's blocks a node hands to its left half."""
        rows = rows.sort_values("chunk").reset_index(drop=True)
        first, shards = int(rows["first"].iloc[0]), int(rows["shards"].iloc[0])
        quota = rows["quota"].to_numpy(dtype=np.int64)
        n = int(quota.sum()) * (shards // 2) // shards
        drawn = quota if shards == 1 else _drawn(quota, n, [seed, first, shards, 1 << 20])
        return rows.assign(to_left=drawn)[["first", "shards", "chunk", "to_left"]]

    return split


def shard_quotas(
    quotas: DataFrame, shards: int = SHARDS, seed: int = SEED, chunk_sources: int = CHUNK_SOURCES
) -> DataFrame:
    """Split exact block quotas (``key``, ``quota``) among shards by a tree of draws.

    A node hands its left half a multivariate-hypergeometric draw of its blocks and the
    right half the rest, down to single shards (``first``). Quotas of a source add up to the
    given one, shards differ by a few blocks at most. Sources beyond ``chunk_sources`` are dealt
    to chunks by a hash: a node first draws how much of each chunk goes left, then each chunk,
    by itself, from which of its sources. So no task holds all sources.
    """
    chunks = -(-quotas.count() // chunk_sources)
    chunk = F.pmod(F.xxhash64("key"), F.lit(max(chunks, 1))).cast("int")
    nodes = quotas.select(
        F.lit(0).alias("first"),
        F.lit(shards).alias("shards"),
        chunk.alias("chunk"),
        "key",
        F.col("quota").cast("bigint").alias("quota"),
    )
    widest = shards
    while widest > 1:
        if chunks > 1:
            totals = nodes.groupBy("first", "shards", "chunk").agg(F.sum("quota").alias("quota"))
            left = totals.groupBy("first", "shards").applyInPandas(
                _split_chunks(seed), "first int, shards int, chunk int, to_left bigint"
            )
            nodes = nodes.join(left, ["first", "shards", "chunk"])
        else:
            nodes = nodes.withColumn("to_left", F.lit(None).cast("bigint"))
        nodes = nodes.groupBy("first", "shards", "chunk").applyInPandas(_split(seed), NODE)
        widest -= widest // 2
    return nodes.select(F.col("first").alias("shard"), "key", "quota")


def plan_units(
    sizes: DataFrame, wanted: DataFrame, shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """Which copies of which blocks go where: ``key``, ``block``, ``copy``, ``shard``.

    ``sizes`` has ``doc_id``, ``source`` and ``size``; ``wanted`` comes from ``targets``.
    Sources without words have no units. The table has at most ``2 * BLOCKS`` rows for each
    source and is written once.
    """
    blocks = (
        sizes.groupBy(
            source_key(F.col("source")).alias("key"),
            block_of(F.col("doc_id"), F.col("source"), seed).alias("block"),
        )
        .agg(F.sum("size").alias("size"))
        .where("size > 0")
        .join(wanted.where("source_size > 0"), "key")
        .withColumn("_order", _permuted(seed, "key", "block"))
    )
    copies = written(
        blocks.groupBy("key")
        .applyInPandas(_choose, "key string, block int, copies int")
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        .select("key", "block", "copy"),
        "mix-copies",
    )
    quotas = shard_quotas(copies.groupBy("key").agg(F.count("*").alias("quota")), shards, seed)
    upto = F.sum("quota").over(Window.partitionBy("key").orderBy("shard"))
    slots = (
        quotas.withColumn("_upto", upto)
        .where("quota > 0")
        .select("key", "shard", F.explode(F.expr("sequence(_upto - quota + 1, _upto)")).alias("_rank"))
    )
    place = Window.partitionBy("key").orderBy(_permuted(seed + 1, "key", "block", "copy"), "block", "copy")
    ranked = copies.withColumn("_rank", F.row_number().over(place).cast("bigint"))
    return written(ranked.join(slots, ["key", "_rank"]).drop("_rank"), "mix-units")


def draw(docs: DataFrame, units: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixture: every document once per unit of its block, with ``shard`` and ``copy``.

    ``place`` is a pseudo-random order within the shard, the same in every run; rows are
    sorted by it within each partition. Columns named like the three are replaced.
    """
    docs = docs.drop("shard", "copy", "place")
    keyed = docs.withColumn("_mix_key", source_key(F.col("source"))).withColumn(
        "_mix_block", block_of(F.col("doc_id"), F.col("source"), seed)
    )
    dealt = units.withColumnsRenamed({"key": "_mix_key", "block": "_mix_block"})
    lookup = stored_lookup(dealt)
    place = F.xxhash64(F.lit(seed), "shard", "doc_id", "copy")
    return (
        keyed.join(F.broadcast(dealt) if lookup.fits else dealt, ["_mix_key", "_mix_block"])
        .drop("_mix_key", "_mix_block")
        .withColumn("place", place)
        .sortWithinPartitions("shard", "place")
    )


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and ``size`` of every row, written once."""
    return written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")


@query("op5_mixing")
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken are the document's size times the units of its block.

    ``shards`` are those that the units were dealt to by the tree, one for each, comma-joined.
    Rows of one ``doc_id`` and source share a block. An empty table gives no rows.
    """
    sizes = sized(table(spark, folder, "documents"))
    wanted = targets(sizes)
    units = plan_units(sizes, wanted)
    copies = units.groupBy("key", "block").agg(
        F.count("*").alias("copies"),
        F.concat_ws(",", F.sort_array(F.collect_list("shard")).cast("array<string>")).alias("shards"),
    )
    keyed = sizes.withColumn("key", source_key(F.col("source"))).withColumn(
        "block", block_of(F.col("doc_id"), F.col("source"))
    )
    taken = join_lookup(keyed, stored_lookup(copies), ["key", "block"], "left", spread_by=["doc_id"])
    with_targets = join_lookup(taken, stored_lookup(wanted), ["key"], "left", spread_by=["doc_id"])
    return with_targets.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.coalesce("copies", F.lit(0))).alias("taken"),
        F.coalesce("shards", F.lit("")).alias("shards"),
    )
