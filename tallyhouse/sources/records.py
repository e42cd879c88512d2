"""Run manifests, check reports and comparison tables."""

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas

MANIFEST_VERSION = 1


def read_manifests(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All manifests under a glob: one document per line, or one per file with ``multi_line``."""
    return spark.read.schema(schemas.MANIFEST).json(path, multiLine=multi_line, mode="FAILFAST")


def write_manifests(df: DataFrame, path: str) -> None:
    """One document per line; an existing path is refused."""
    df.write.mode("errorifexists").json(path)


def manifest_problems(
    manifests: DataFrame, folder: str = "folder", version: int = MANIFEST_VERSION
) -> DataFrame:
    """Manifests that cannot be used: run_id, the folder, and what is wrong with them.

    Problems: ``version`` (another schema version, or none) and ``run`` (the run id is not the
    name of the folder that holds the manifest). ``folder`` names the column with that name.
    """
    wrong = F.array_compact(
        F.array(
            F.when(~F.col("schema_version").eqNullSafe(F.lit(version)), "version"),
            F.when(~F.col("run_id").eqNullSafe(F.col(folder)), "run"),
        )
    )
    return manifests.select("run_id", folder, wrong.alias("problems")).where(F.size("problems") > 0)


def stages_of(manifests: DataFrame) -> DataFrame:
    """One row per run and stage: run_id, stage, status, inputs, outputs, details."""
    return manifests.select("run_id", F.explode("stages").alias("stage", "entry")).select(
        "run_id", "stage", "entry.*"
    )


def artifacts_of(stages: DataFrame, kind: str = "outputs") -> DataFrame:
    """One row per artifact: run_id, stage, stage_status, name, path, sha256."""
    return stages.select(
        "run_id",
        "stage",
        F.col("status").alias("stage_status"),
        F.explode(kind).alias("name", "artifact"),
    ).select("run_id", "stage", "stage_status", "name", "artifact.*")


EDGES = "src string, dst string, sha256 string"


def edges_of(records: DataFrame, key: str, document: str) -> DataFrame:
    """What records refer to, at any depth: src (the key), dst (a path), sha256.

    ``document`` is JSON text. Every object in it that has a ``path`` and a ``sha256`` is an
    artifact; numbers and truth values count as their text. Each document is read once, in the
    task that holds its row. A null document has no edges, and one that is no JSON fails.
    """

    def refuse(text):
        raise ValueError(f"{text} is no JSON value")

    def plain(value):
        if isinstance(value, str):
            return value
        return json.dumps(value) if isinstance(value, (int, float)) else None

    def artifacts(text):
        waiting = [json.loads(text, parse_constant=refuse)]
        while waiting:
            value = waiting.pop()
            if isinstance(value, dict):
                path, digest = plain(value.get("path")), plain(value.get("sha256"))
                if path is not None and digest is not None:
                    yield path, digest
                waiting += [v for v in value.values() if isinstance(v, (dict, list))]
            elif isinstance(value, list):
                waiting += [v for v in value if isinstance(v, (dict, list))]

    def run(batches):
        for batch in batches:
            keys, texts = batch.columns
            found = [
                (source, *artifact)
                for source, text in zip(keys.to_pylist(), texts.to_pylist())
                for artifact in artifacts(text)
            ]
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in columns], names=["src", "dst", "sha256"]
            )

    documents = records.where(F.col(document).isNotNull())
    return documents.select(F.col(key).cast("string"), document).mapInArrow(run, EDGES)


def write_comparison(df: DataFrame, path: str) -> None:
    """CSV with the parameters as JSON text; an existing path is refused."""
    if dict(df.dtypes)["parameters"] != "string":
        df = df.withColumn("parameters", F.to_json("parameters"))
    df.write.mode("errorifexists").csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def read_comparison(
    spark: SparkSession, path: str, parameters: str | None = None
) -> DataFrame:
    """Comparison rows; ``parameters`` names a schema to parse the JSON column with."""
    df = spark.read.schema(schemas.COMPARISON).csv(
        path, header=True, escape='"', enforceSchema=False, mode="FAILFAST"
    )
    if parameters is None:
        return df
    return df.withColumn(
        "parameters", F.from_json("parameters", parameters, {"mode": "FAILFAST"})
    )


def write_report(cases: DataFrame, path: str) -> None:
    """Check reports as XML, one testcase element per row of report, name, failed, skipped."""
    note = F.struct(F.lit("violated").alias("_message"))
    cases.select(
        F.col("name").alias("_name"),
        F.col("report").alias("_classname"),
        F.when(F.col("failed"), note).alias("failure"),
        F.when(F.col("skipped"), note).alias("skipped"),
    ).write.mode("errorifexists").format("xml").option("rootTag", "testsuite").option(
        "rowTag", "testcase"
    ).save(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Test cases of all reports under a path: report, name, failed, skipped."""
    cases = (
        spark.read.format("xml")
        .option("rowTag", "testcase")
        .option("mode", "FAILFAST")
        .schema(schemas.TEST_CASE)
        .load(path)
    )
    return cases.select(
        F.col("_classname").alias("report"),
        F.col("_name").alias("name"),
        (F.col("failure").isNotNull() | F.col("error").isNotNull()).alias("failed"),
        F.col("skipped").isNotNull().alias("skipped"),
    )
