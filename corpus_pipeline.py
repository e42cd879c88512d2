"""A training corpus from the documents: five stages, each on all that the one before kept.

Every stage takes and returns rows with the columns of ``documents``, extra ones included,
whatever their names; the last adds ``shard``, ``copy`` and ``place``. Empty tables pass.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontamination, language_id, mixing, secret_scan, simhash_dedup
from tallyhouse.llm.registry import table
from tallyhouse.llm.scratch import Scratch
from tallyhouse.plans.lookups import join_lookup, stored_lookup
from tallyhouse.plans.shared import written

MIN_LANGUAGE_SCORE = 0.5


def _hidden(docs: DataFrame) -> DataFrame:
    """All columns but the text under names that no operator uses."""
    return docs.select(
        *[F.col(c).alias(c if c == "text" else f"_{i}_") for i, c in enumerate(docs.columns)]
    )


def _shown(docs: DataFrame, columns: list[str], **changed) -> DataFrame:
    return docs.select(
        *[
            changed.get(c, F.col(c if c == "text" else f"_{i}_")).alias(c)
            for i, c in enumerate(columns)
        ]
    )


def _name(docs: DataFrame) -> Column:
    """What tells rows apart: the id, missing ones last, and the text."""
    id_ = F.col("doc_id")
    zero = F.lit(0).cast(docs.schema["doc_id"].dataType)
    return F.struct(
        id_.isNull().alias("missing"),
        F.coalesce(id_, zero).alias("id"),
        F.xxhash64("text").alias("of_text"),
    )


def _judged(docs: DataFrame) -> DataFrame:
    """Names and texts as an operator takes them, names in the place of ids.

    Rows without an id are judged like all others, and rows that share an id but not their text
    one by one.
    """
    return docs.select(_name(docs).alias("doc_id"), "text")


def _without(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """Drop the rows that ``gone`` names by its column ``doc_id`` (see ``_name``).

    The names are broadcast if they are few, else both sides are shuffled.
    """
    keyed = docs.withColumn("_judged_", _name(docs))
    gone = gone.select(F.col("doc_id").alias("_judged_")).distinct()
    lookup = stored_lookup(written(gone, name))
    return join_lookup(keyed, lookup, ["_judged_"], "left_anti", spread_by=["_judged_"]).drop("_judged_")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language cannot be told: no letters, no text, or no clear winner.

    Where no row has a language to learn from, every row with a text stays.
    """
    model = language_id.fit_documents(docs)
    if not model.languages:
        return docs.where(F.col("text").isNotNull())
    judged = language_id.identify(_hidden(docs), model)
    kept = judged.where(
        (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    )
    return _shown(kept, docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays.

    A row without an id stays if no other of its group has one; of rows that repeat id and text,
    one stays.
    """
    groups = simhash_dedup.group(_judged(docs))
    rest = _without(docs, groups.where("doc_id <> component_id").select("doc_id"), "copies")
    once = rest.withColumn("_text_", F.xxhash64("text")).dropDuplicates(["doc_id", "_text_"])
    return once.drop("_text_")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that share a window with a benchmark item, with an id or without."""
    judged = _judged(docs)
    hits = decontamination.contaminated(judged, table(spark, sf_dir, "benchmark"))
    return _without(docs, hits.select("doc_id"), "contaminated")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in them are replaced, and ``n_chars`` is set anew there."""
    scanned = secret_scan.scan_documents(_hidden(docs)).withColumn(
        "_redacted", secret_scan.redact(F.col("text"), F.col("spans"))
    )
    changed = {"text": F.col("_redacted")}
    if "n_chars" in docs.columns:
        old = F.col(f"_{docs.columns.index('n_chars')}_")
        new = F.length("_redacted").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size("spans") > 0, new).otherwise(old)
    return _shown(scanned, docs.columns, **changed)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: rows as often as the mix takes them, dealt to shards in random order."""
    sizes = mixing.sized(docs)
    units = mixing.plan_units(sizes, mixing.targets(sizes))
    return mixing.draw(docs, units)


STAGES = [
    ("language", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark", decontaminate),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

# Fingerprints, the classifier and the draws cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's table goes once the next is written, the last one stays to be read."""
    docs, scratch, before = table(spark, sf_dir, "documents"), Scratch(spark), None
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
