"""Feature expressions and their fitted state (E1-E11) in the DataFrame API."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.binding import bind
from tallyhouse.functions.text import ENGLISH_STOP_WORDS, stop_tokens, tokens
from tallyhouse.plans.lookups import BROADCAST_ROWS, Lookup, derived_lookup, join_lookup, local_table
from tallyhouse.plans.shared import checkpointed

OLD_DATE = "2010-01-01"
# Categories that may become slots of a vector.
MAX_CATEGORIES = 100_000


# --- categories -----------------------------------------------------------------------


def category_codes(
    df: DataFrame, column: str, max_lookup_rows: int = BROADCAST_ROWS
) -> Lookup:
    """Codes 0..k-1 of the distinct values in sorted order.

    The values are numbered by one sort of the distinct values, never of the rows.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    found = derived_lookup(values, max_lookup_rows)
    if not found.fits:
        return Lookup(checkpointed(_number_sorted(found.table, column)), False)
    rows = [(value, code) for code, value in enumerate(sorted(row[0] for row in found.rows))]
    schema = T.StructType([*values.schema.fields, T.StructField("code", T.LongType())])
    return Lookup(local_table(rows, schema, df.sparkSession), True)


def _number_sorted(values: DataFrame, column: str) -> DataFrame:
    """Positions 0..k-1 of distinct values: ranks inside each range of a distributed sort.

    Only the row count of each range passes through the driver.
    """
    ranges = checkpointed(values.orderBy(column).withColumn("_range", F.spark_partition_id()))
    offsets, start = [], 0
    for row in sorted(ranges.groupBy("_range").count().collect()):
        offsets.append((row["_range"], start))
        start += row["count"]
    offset = values.sparkSession.createDataFrame(offsets, "_range int, _start bigint")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    return (
        ranges.withColumn("_place", place)
        .join(F.broadcast(offset), "_range")
        .select(column, (F.col("_start") + F.col("_place") - 1).cast("bigint").alias("code"))
    )


def encode_ordinal(
    df: DataFrame, column: str, codes: Lookup, output: str, spread_by: Sequence[str]
) -> DataFrame:
    """Replace a value by its code. A value the fit did not see, or a null, is an error."""
    table = codes.table.withColumnRenamed("code", "_code")
    joined = join_lookup(df, Lookup(table, codes.fits), [column], "left", spread_by)
    unseen = F.raise_error(
        F.concat(F.lit(f"Unknown category in {column}: "), F.coalesce(F.col(column), F.lit("null")))
    ).cast("bigint")
    return joined.withColumn(output, F.coalesce(F.col("_code"), unseen)).drop("_code")


def most_frequent(df: DataFrame, column: str) -> Column:
    """The commonest value, the smallest one if tied, as a scalar subquery.

    Counted by group and reduced by a top-1, so no task holds all distinct values.
    """
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .count()
        .orderBy(F.desc("count"), column)
        .limit(1)
        .select(column)
        .scalar()
    )


def impute_mode(df: DataFrame, column: str, fitted_on: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the commonest value of ``fitted_on`` (the table itself by default)."""
    value = most_frequent(df if fitted_on is None else fitted_on, column)
    return df.withColumn(column, F.coalesce(F.col(column), value))


def fit_categories(df: DataFrame, column: str, most: int = MAX_CATEGORIES) -> list[str]:
    """The distinct values in sorted order, nulls left out, for ``encode_one_hot``.

    Each becomes a slot, so they pass through the driver: more than ``most`` raise.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct().take(most + 1)
    if len(values) > most:
        raise ValueError(f"Column {column} has more than {most} categories")
    return sorted(row[0] for row in values)


def encode_one_hot(
    df: DataFrame, column: str, categories: Sequence[str], prefix: str
) -> DataFrame:
    """One 0/1 column per category, all kept. An unknown value or a null is an error.

    For more categories than columns make sense, use the vector stages of ``stages``.
    """
    categories = list(categories)
    value = F.col(column)
    known = F.coalesce(value.isin(categories), F.lit(False))
    unseen = F.raise_error(
        F.concat(F.lit(f"Unknown category in {column}: "), F.coalesce(value, F.lit("null")))
    ).cast("double")
    return df.withColumns(
        {
            f"{prefix}{c}": F.when(value == c, 1.0).when(known, 0.0).otherwise(unseen)
            for c in categories
        }
    )


# --- numbers and dates ----------------------------------------------------------------


def impute_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero for null and NaN in numeric columns; the column types stay."""
    return df.fillna(0, subset=list(columns))


def days_since_latest(
    df: DataFrame,
    column: str,
    output: str,
    reference_date: str = "batch",
    fitted_on: DataFrame | None = None,
    old_date: str = OLD_DATE,
) -> DataFrame:
    """Whole days from each date to the latest one; a missing date counts as ``old_date``.

    ``reference_date="batch"`` takes the latest date of the table being transformed, so the
    same listing may get another value in another batch. ``"fitted"`` takes that of
    ``fitted_on``. The latest date is a scalar subquery: partial maxima, no window.
    """
    if reference_date not in {"batch", "fitted"}:
        raise ValueError("reference_date must be batch or fitted")
    if reference_date == "fitted" and fitted_on is None:
        raise ValueError("A fitted reference date needs fitted_on")
    source = df if reference_date == "batch" else fitted_on
    filled = F.coalesce(F.col(column).cast("date"), F.lit(old_date).cast("date"))
    latest = source.select(filled.alias("d")).agg(F.max("d")).scalar()
    return df.withColumn(output, F.datediff(latest, filled).cast("bigint"))


# --- text -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """Kept terms with corpus_count and document_count, and the number of documents."""

    terms: Lookup
    documents: int


def fit_vocabulary(
    df: DataFrame,
    text: str,
    max_features: int,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    max_lookup_rows: int = BROADCAST_ROWS,
) -> Vocabulary:
    """The terms with the highest corpus count, equal counts by term.

    One pass over the text: every word of a row counts for the corpus, and its distinct words
    once more for the documents. Stop words are dropped after the words have become rows,
    where the test is compiled; counts are added up before the shuffle.
    """
    if max_features < 1:
        raise ValueError("max_features must be positive")

    def marked(words, mark):
        return F.transform(words, lambda w: F.struct(w.alias("term"), F.lit(mark).alias("once")))

    both = bind(
        tokens(F.col(text)),
        lambda words: F.concat(marked(words, False), marked(F.array_distinct(words), True)),
    )
    words = df.select(F.inline(both))
    stop = stop_tokens(stop_words)
    if stop:
        words = words.where(~F.col("term").isin(stop))
    counted = (
        words.groupBy("term")
        .agg(F.count_if(~F.col("once")).alias("corpus_count"), F.count_if("once").alias("document_count"))
        .orderBy(F.desc("corpus_count"), "term")
        .limit(max_features)
    )
    return Vocabulary(derived_lookup(counted, max_lookup_rows), df.count())


def smoothed_idf(documents: int | Column, document_count: Column) -> Column:
    """``ln((1 + n) / (1 + df)) + 1``."""
    n = F.lit(documents) if isinstance(documents, int) else documents
    return F.log((F.lit(1.0) + n) / (F.lit(1.0) + document_count)) + F.lit(1.0)


def tfidf(df: DataFrame, key: str, text: str, vocabulary: Vocabulary) -> DataFrame:
    """Non-zero weights in long form: key, term, weight. Every row has unit length.

    Rows are weighed one by one, so rows that share a key, or have none, stay apart. Stop
    words need no test here, as the vocabulary holds none. Words are joined to the
    vocabulary, which drops all others, and counted before anything is shuffled as long as
    the vocabulary can be broadcast.
    """
    idf = smoothed_idf(vocabulary.documents, F.col("document_count")).alias("idf")
    lookup = Lookup(vocabulary.terms.table.select("term", idf), vocabulary.terms.fits)
    # The number only tells rows of one run apart; it has to be there before words become rows.
    numbered = df.select(F.monotonically_increasing_id().alias("_row"), key, text)
    words = numbered.select("_row", key, F.explode(tokens(F.col(text))).alias("term"))
    raw = (
        join_lookup(words, lookup, ["term"], "inner", spread_by=["_row"])
        .groupBy("_row", key, "term")
        .agg((F.count(F.lit(1)) * F.first("idf")).alias("raw"))
    )
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("_row")))
    return raw.withColumn("weight", F.col("raw") / norm).select(key, "term", "weight")
