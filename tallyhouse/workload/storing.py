"""Queries that write and read back. Each call writes below a new folder."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import ledger
from tallyhouse.plans.shared import new_folder
from tallyhouse.schemas import CHECKS
from tallyhouse.sources import layout, records, tables
from tallyhouse.workload.recording import CANDIDATES_SQL, EVENTS_SQL, LATEST_SQL, candidates, stage_events
from tallyhouse.workload.registry import query
from tallyhouse.workload.splitting import fingerprint_sql
from tallyhouse.workload.tables import table

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@query(
    "csv_roundtrip",
    """
    SELECT doc_id, md5('  ' || text || chr(9) || ' ') AS digest, lang, source, n_chars FROM documents
    """,
)
def csv_roundtrip(spark, folder):
    """Texts with line breaks, commas, quotes and blanks at both ends, as CSV and back."""
    path = new_folder(spark, "documents-csv")
    padded = F.concat(F.lit("  "), "text", F.lit("\t "))
    documents = table(spark, folder, "documents").withColumn("text", padded)
    tables.write_csv(documents.select(*DOCUMENT.names), path)
    back = tables.read_csv(spark, path, DOCUMENT)
    return back.select("doc_id", F.md5("text").alias("digest"), "lang", "source", "n_chars")


PART_SQL = fingerprint_sql(
    ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::VARCHAR AS p_size, "
    "p_retailprice::VARCHAR AS p_retailprice FROM part",
)


@query(
    "ingest_sample",
    f"""
    SELECT 'part' AS sample, n_rows, fingerprint AS source_fingerprint, fingerprint AS copy_fingerprint
    FROM ({PART_SQL})
    """,
)
def ingest_sample(spark, folder):
    names = ("part", "supplier")
    catalog = {name: f"{folder}/{name}.parquet" for name in names}
    _, identity = tables.ingest_sample(spark, "part", catalog, new_folder(spark, "sample"))
    return identity


@query(
    "baseline_snapshot",
    f"""
    SELECT 1 AS schema_version, 'run-0' AS source_run_id, n_rows, fingerprint AS source_fingerprint,
           fingerprint AS reference_fingerprint, n_rows AS rows_loaded
    FROM ({PART_SQL})
    """,
)
def baseline_snapshot(spark, folder):
    place = new_folder(spark, "baseline")
    meta = tables.create_baseline(
        table(spark, folder, "part"), f"{folder}/part.parquet", "run-0", place
    )
    loaded = tables.load_baseline(spark, place)
    return meta.select(
        "schema_version",
        "source_run_id",
        "n_rows",
        "source_fingerprint",
        "reference_fingerprint",
        loaded.agg(F.count(F.lit(1))).scalar().alias("rows_loaded"),
    )


@query(
    "baseline_by_key",
    """
    SELECT p_partkey, CASE WHEN p_size = 50 THEN '<missing>'
                           WHEN p_size = 1 AND p_retailprice > 1000 THEN 'p_brand,p_retailprice'
                           WHEN p_size = 1 THEN 'p_brand' ELSE 'p_retailprice' END AS differing
    FROM part WHERE p_size = 50 OR p_size = 1 OR p_retailprice > 1000
    """,
)
def baseline_by_key(spark, folder):
    """A baseline stored by its key against a later table stored alike, read without an exchange."""
    place = new_folder(spark, "baseline")
    part = table(spark, folder, "part")
    tables.create_baseline(part, f"{folder}/part.parquet", "run-0", place, key=["p_partkey"])
    later = part.where("p_size <> 50").withColumns(
        {
            "p_brand": F.when(F.col("p_size") == 1, "another").otherwise(F.col("p_brand")),
            "p_retailprice": F.when(F.col("p_retailprice") > 1000, -1.0).otherwise(F.col("p_retailprice")),
        }
    )
    now = layout.store_by_key(later, new_folder(spark, "parts"), ["p_partkey"], like=f"{place}/reference")
    found = ledger.disagreements(
        tables.load_baseline(spark, place), now, ["p_partkey"], ["p_name", "p_brand", "p_retailprice"]
    )
    return found.withColumn("differing", F.array_join("differing", ","))


@query(
    "stage_ledger",
    f"""
    WITH {EVENTS_SQL}
    SELECT run_id, stage, status, 'runs/' || run_id || '/' || stage AS path,
           sha256(run_id || '|' || stage) AS sha256
    FROM ({LATEST_SQL.format(events="weekly")})
    """,
)
def stage_ledger(spark, folder):
    """Run manifests written as JSON, read by a glob and opened to one row per output."""
    stages = ledger.latest_status(stage_events(spark, folder), ["ts", "event_id"])
    artifact = F.struct(
        F.concat_ws("/", F.lit("runs"), "run_id", "stage").alias("path"),
        F.sha2(F.concat_ws("|", "run_id", "stage"), 256).alias("sha256"),
    )
    entry = F.struct(
        "stage",
        F.struct("status", F.create_map(F.lit("result"), artifact).alias("outputs")).alias("entry"),
    )
    # A run has at most one entry per stage name, and the names are few.
    manifests = stages.groupBy("run_id").agg(
        F.map_from_entries(F.collect_list(entry)).alias("stages")
    )
    path = new_folder(spark, "manifests")
    records.write_manifests(
        manifests.select(F.lit(1).alias("schema_version"), "run_id", "stages"), path
    )
    opened = records.artifacts_of(records.stages_of(records.read_manifests(spark, f"{path}/*.json")))
    return opened.select("run_id", "stage", F.col("stage_status").alias("status"), "path", "sha256")


@query(
    "comparison_roundtrip",
    f"""
    WITH {CANDIDATES_SQL}
    SELECT run_id, model_path, split_id, split_path, mae, r2,
           (parameters::JSON ->> '$.max_depth')::INTEGER AS max_depth,
           (parameters::JSON ->> '$.n_estimators')::INTEGER AS n_estimators
    FROM cand
    """,
)
def comparison_roundtrip(spark, folder):
    columns = ["run_id", "model_path", "split_id", "split_path", "parameters", "mae", "r2"]
    path = new_folder(spark, "comparison")
    records.write_comparison(candidates(spark, folder).select(*columns), path)
    back = records.read_comparison(
        spark, path, "max_depth int, n_estimators int"
    )
    return back.select("*", "parameters.*").drop("parameters")


@query(
    "report_gate",
    """
    WITH o AS (SELECT o_custkey, count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1),
    c AS (SELECT c_custkey, c_acctbal < 0 AS names, NOT c_nationkey BETWEEN 3 AND 21 AS box,
                 coalesce(n < 5, FALSE) AS few, n IS NULL AS skipped, n IS NOT NULL AS complete,
                 coalesce(lo < 5000 OR hi > 495000, FALSE) AS priced
          FROM customer LEFT JOIN o ON o_custkey = c_custkey)
    SELECT 'run-' || c_custkey AS report, complete, skipped AS any_skipped,
           (names::INTEGER + box::INTEGER + few::INTEGER + priced::INTEGER)::BIGINT AS n_failed,
           box AND NOT names AND NOT few AND NOT priced AS as_expected,
           complete AND NOT skipped AND box AND NOT names AND NOT few AND NOT priced AS accepted
    FROM c
    """,
)
def report_gate(spark, folder):
    """A check report per customer over its orders, as XML; only the box check should fail."""
    orders = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("o_totalprice").alias("lo"),
            F.max("o_totalprice").alias("hi"),
        )
    )
    facts = table(spark, folder, "customer").join(orders, "c_custkey", "left")
    never, no_orders = F.lit(False), F.col("n").isNull()
    # In the order of the checks: names, categories, box, shares, rows, prices.
    failed = (
        never,
        F.col("c_acctbal") < 0,
        ~F.col("c_nationkey").between(3, 21),
        never,
        F.coalesce(F.col("n") < 5, never),
        (F.col("lo") < 5000) | (F.col("hi") > 495_000),
    )
    failures = dict(zip(CHECKS, failed, strict=True))
    box, rows, prices = CHECKS[2], CHECKS[4], CHECKS[5]
    cases = facts.select(
        F.concat(F.lit("run-"), F.col("c_custkey").cast("string")).alias("report"),
        no_orders.alias("empty"),
        F.inline(
            F.array(
                *[F.struct(F.lit(name).alias("name"), failures[name].alias("failed")) for name in CHECKS]
            )
        ),
    )
    # Without orders the row count is skipped and prices are not checked at all.
    cases = cases.where(~(F.col("empty") & (F.col("name") == prices))).select(
        "report",
        "name",
        "failed",
        (F.col("empty") & (F.col("name") == rows)).alias("skipped"),
    )
    path = new_folder(spark, "reports")
    records.write_report(cases, path)
    return ledger.report_gate(
        records.read_report(spark, path), ["report"], [box]
    )
