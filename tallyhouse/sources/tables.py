"""Listing files, samples and the fixed baseline."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.digests import fingerprint, table_fingerprint
from tallyhouse.schemas import LISTING
from tallyhouse.sources.layout import open_by_key, store_by_key

# Texts that the usual CSV readers of data frames take as missing.
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

BASELINE_VERSION = 1
BASELINE = (
    "schema_version int, source_run_id string, source_path string, source_fingerprint string, "
    "reference_path string, reference_fingerprint string, n_rows bigint"
)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = LISTING,
    null_markers: Sequence[str] = NULL_MARKERS,
    on_bad: str = "fail",
    multi_line: bool = True,
) -> DataFrame:
    """Read headed CSV with quoted text, doubled quotes and missing markers.

    Everything is read as text, markers become null, and each column is cast to its declared
    type. A text that does not fit its type fails the read, or is null with
    ``on_bad="null"``. Texts with line breaks need ``multi_line``, which keeps a file in one
    task: convert such files to Parquet once, or give many files.
    """
    if on_bad not in {"fail", "null"}:
        raise ValueError("on_bad must be fail or null")
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.schema(as_text).csv(
        path,
        header=True,
        multiLine=multi_line,
        escape='"',
        enforceSchema=False,
        emptyValue="",
        mode="FAILFAST",
    )
    markers = list(null_markers)
    columns = []
    for f in schema:
        value = F.col(f"`{f.name}`")
        known = F.when(~value.isin(markers), value) if markers else value
        if not isinstance(f.dataType, T.StringType):
            known = known.try_cast(f.dataType) if on_bad == "null" else known.cast(f.dataType)
        columns.append(known.alias(f.name))
    return raw.select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV without an index; texts keep their blanks, an existing path is refused."""
    df.write.mode("errorifexists").csv(
        path,
        header=True,
        escape='"',
        emptyValue="",
        nullValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def ingest_sample(
    spark: SparkSession, name: str, catalog: Mapping[str, str], out: str
) -> tuple[DataFrame, DataFrame]:
    """Copy a known sample unchanged. Returns the copy and its one-row identity record."""
    if name not in catalog:
        raise FileNotFoundError(f"Unknown sample {name}; use one of {', '.join(sorted(catalog))}")
    source = spark.read.parquet(catalog[name])
    source.write.mode("errorifexists").parquet(out)
    copy = spark.read.schema(source.schema).parquet(out)
    identity = table_fingerprint(source).select(
        F.lit(name).alias("sample"),
        "n_rows",
        F.col("fingerprint").alias("source_fingerprint"),
        table_fingerprint(copy).select("fingerprint").scalar().alias("copy_fingerprint"),
    )
    return copy, identity


def create_baseline(
    df: DataFrame,
    source_path: str,
    source_run_id: str,
    folder: str,
    outputs: DataFrame | None = None,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Freeze a cleaned table as the baseline, once. Returns the metadata row.

    The copy must have the fingerprint of the source, read again after the copy, so a source
    that changed meanwhile is noticed. ``outputs`` (as from ``records.artifacts_of``) must
    then hold ``source_path`` as the output of the run's completed cleaning. With a ``key`` the
    copy is stored by it (see ``layout``), so that later tables stored alike are compared with
    it row by row without moving it.
    """
    spark = df.sparkSession
    if outputs is not None:
        cleaned = outputs.where(
            (F.col("run_id") == source_run_id)
            & (F.col("stage") == "basic_cleaning")
            & (F.col("stage_status") == "completed")
            & (F.col("path") == source_path)
        )
        if cleaned.isEmpty():
            raise ValueError(f"{source_path} is no output of a completed cleaning of {source_run_id}")
    snapshot = f"{folder}/reference"
    if key:
        stored = store_by_key(df, snapshot, key)
    else:
        df.write.mode("errorifexists").parquet(snapshot)
        stored = spark.read.schema(df.schema).parquet(snapshot)
    copy = table_fingerprint(stored).first()
    source = table_fingerprint(df).first()
    if source["fingerprint"] != copy["fingerprint"]:
        raise ValueError("The source changed while the baseline was made; use a new folder")
    row = (
        BASELINE_VERSION,
        source_run_id,
        source_path,
        source["fingerprint"],
        snapshot,
        copy["fingerprint"],
        copy["n_rows"],
    )
    meta = spark.createDataFrame([row], BASELINE)
    meta.write.mode("errorifexists").json(f"{folder}/metadata")
    return spark.read.schema(BASELINE).json(f"{folder}/metadata")


def load_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """The baseline table; refused if absent, of another version, moved or changed."""
    try:
        rows = spark.read.schema(BASELINE).json(f"{folder}/metadata").take(2)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise FileNotFoundError(f"No baseline in {folder}; create it first") from error
    if len(rows) != 1 or rows[0]["schema_version"] != BASELINE_VERSION:
        raise ValueError("Unsupported baseline metadata")
    meta = rows[0]
    if meta["reference_path"] != f"{folder}/reference":
        raise ValueError("The baseline metadata points to another folder")
    if meta["reference_fingerprint"] != meta["source_fingerprint"]:
        raise ValueError("The baseline does not match its recorded source")
    table = _snapshot(spark, meta["reference_path"])
    if fingerprint(table) != meta["reference_fingerprint"]:
        raise ValueError("The baseline has changed since it was recorded")
    return table


def _snapshot(spark: SparkSession, path: str) -> DataFrame:
    try:
        return open_by_key(spark, path)
    except FileNotFoundError:
        return spark.read.parquet(path)
