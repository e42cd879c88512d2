"""Document fingerprints: all shingle hashes below a fixed fraction of the hash range."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions.binding import bind
from tallyhouse.llm.registry import query, table
from tallyhouse.plans.shared import written

SHINGLE_WORDS = 5
# One hash in so many is kept.
SCALE = 8
CEILING = -(1 << 63) + (1 << 64) // SCALE
# Documents whose ids share all but the lowest bits are put in order together.
BUCKET_BITS = 6
LEVEL_BITS = 12
# Texts are dealt to so many tasks that each gets about as many bytes.
TASK_BYTES = 8_000_000


def shingle_hashes(text: Column) -> Column:
    """64-bit hashes of all runs of five lower-cased words; fewer words make one run."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def runs(w):
        def run(i):
            return F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE_WORDS)])

        return (
            F.when(F.size(w) >= SHINGLE_WORDS, F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE_WORDS), run))
            .when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return bind(words, runs)


def sketch(text: Column) -> Column:
    """Ascending distinct hashes below the ceiling, and the least hash of all.

    The least one keeps short texts from having an empty sketch. Sketches merge: unite two,
    then keep what is below the ceiling and the least. No word gives an empty sketch.
    """
    kept = bind(
        shingle_hashes(text),
        lambda h: F.concat(
            F.filter(h, lambda x: x < F.lit(CEILING)), F.array_compact(F.array(F.array_min(h)))
        ),
    )
    return F.array_sort(F.array_distinct(kept))


def encoded(hashes: Column) -> Column:
    """A sketch as text: 16 hex digits for each hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all of both; 1 for two empty sketches."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 for an empty ``a``."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)) / F.size(a)
    )


def previous_values(values: DataFrame) -> DataFrame:
    """``value`` and ``previous``, the next smaller one; the smallest gets the greatest.

    ``values`` has one column ``value`` of different ``bigint`` numbers. Numbers are ordered
    in groups that share all but their lowest 12 bits, so of at most 4096; what a group
    cannot answer goes up to groups of groups. No task orders more than that at once.
    """
    items = written(
        values.select(F.col("value").alias("g"), F.col("value").alias("lo"), F.col("value").alias("hi")),
        "order",
    )
    answered = []
    while items.count() > 1 << LEVEL_BITS:
        grouped = items.withColumn("up", F.shiftright("g", LEVEL_BITS))
        before = F.lag("hi").over(Window.partitionBy("up").orderBy("g"))
        answered.append(grouped.withColumn("previous", before).where("previous is not null"))
        items = written(
            grouped.groupBy(F.col("up").alias("g")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")),
            "order",
        )
    before = F.lag("hi").over(Window.orderBy("g"))
    top = items.withColumn("previous", F.coalesce(before, F.max("hi").over(Window.partitionBy())))
    result = top.select(F.col("lo").alias("value"), "previous")
    for part in answered:
        result = result.union(part.select("lo", "previous"))
    return result


def with_next(
    docs: DataFrame, columns: list[str], derived: Mapping[str, Column] | None = None, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Add ``next_<column>`` from the next row in descending order of ``doc_id``.

    ``derived`` are further columns, computed from ``columns``; they get a next one as well.
    After the last row comes the first. Rows with one id follow each other by their columns.
    A row without an id has no next row (null) and is no row's next. Rows are dealt out by
    ranges of 64 ids, once, to tasks of about ``task_bytes``; only the first row of each range
    travels to another. An empty table stays empty.
    """
    derived = dict(derived or {})
    added = [*columns, *derived]
    id_ = F.col("doc_id")
    # Rows without ids go to ranges below all others, so that they spread as well.
    bucket = F.coalesce(
        F.shiftright(id_, BUCKET_BITS),
        F.pmod(F.xxhash64(*columns), F.lit(1 << 16)) - F.lit((1 << 62) + 1),
    )
    rows = docs.withColumn("_bucket", bucket)
    size = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("bigint") for c in columns)
    ranges = written(
        rows.groupBy("_bucket").agg(F.sum(size).alias("bytes"), F.bool_or(id_.isNotNull()).alias("known")),
        "ranges",
    )
    tasks = 1 + int((ranges.agg(F.sum("bytes")).first()[0] or 0) // task_bytes)
    # Bitwise not turns the order round and, unlike minus, never overflows.
    row = F.struct(F.bitwise_not(id_).alias("_not_id"), *columns)
    heads = rows.where("doc_id is not null").groupBy("_bucket").agg(F.min(row).alias("_head"))
    heads = heads.select("_bucket", "_head.*").withColumns(derived)
    order = previous_values(ranges.where("known").select(F.col("_bucket").alias("value")))
    first = order.join(heads, order["previous"] == heads["_bucket"]).select(
        F.col("value").alias("_bucket"), *[F.col(c).alias(f"_first_{c}") for c in added]
    )
    window = Window.partitionBy("_bucket").orderBy(F.desc("doc_id"), *columns)
    dealt = rows.withColumns(derived).repartition(tasks, "_bucket")
    ahead = dealt.select(
        "*",
        *[F.lead(c).over(window).alias(f"_lead_{c}") for c in added],
        F.lead(F.lit(True)).over(window).isNull().alias("_last"),
    )
    rows_, first_ = ahead.alias("r"), first.alias("f")
    joined = rows_.join(
        first_, (F.col("r._bucket") == F.col("f._bucket")) & F.col("r._last"), "left"
    )
    return joined.select(
        *[F.col(f"r.{c}") for c in [*docs.columns, *derived]],
        *[
            F.when(
                F.col("r.doc_id").isNotNull(),
                F.when(F.col("r._last"), F.col(f"f._first_{c}")).otherwise(F.col(f"r._lead_{c}")),
            ).alias(f"next_{c}")
            for c in added
        ],
    )


def edited_text(text: Column, following: Column) -> Column:
    """The text with its last third replaced by as many first characters of another."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(following, F.lit(1), third))


@query("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Empty and null texts have empty fingerprints; see ``with_next`` for ids."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(docs, ["text"], {"sketch": sketch(F.col("text"))})
    edited = paired.withColumn(
        "edited", edited_text(F.col("text"), F.coalesce("next_text", F.lit("")))
    ).withColumn("edited_sketch", sketch(F.col("edited")))
    empty = F.array().cast("array<bigint>")
    return edited.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        encoded(F.col("sketch")).alias("fingerprint"),
        encoded(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.coalesce("next_sketch", empty)).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_in_text"),
    )
