"""License scans: an exact set-similarity join of text blocks with templates."""

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.registry import query, table

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A template word set is found wherever a block holds this share of it.
THRESHOLD = 0.9
# Blocks start every STRIDE words and hold twice as many, so any run of STRIDE + 1 words lies
# within one block.
STRIDE = 48
# Templates come from the caller's program. Beyond so many tokens they are not broadcast.
BROADCAST_TOKENS = 100_000


@dataclass(frozen=True)
class Template:
    """A license text of at most ``STRIDE`` words.

    A phrase has to stand word for word; other templates are matched as sets of words.
    """

    label: str
    text: str
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


# Phrases of the base labels, then notices of common licenses.
PHRASES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
    Template("cc0", "dedicated to the public domain under cc0 1 0 universal"),
    Template("gpl-3", "licensed under the gnu general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license"),
    Template("mit", "released under the mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files to deal in the software without restriction",
    ),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "free and unencumbered software released into the public domain"),
)


def words_of(text: Column) -> Column:
    """Words of the whole text, lower-cased; null has none.

    Unlike a mapping of A-Z alone, ``lower`` also maps other letters. These are word
    characters before and after, so words begin and end at the same places.
    """
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def token_order(words: DataFrame, tokens: Sequence[str]) -> list[str]:
    """Template tokens from rare to frequent, counted over all rows of ``words.words``.

    Other tokens cannot be shared with a template, so they are left out of all sets.
    """
    counts = (
        words.select(F.explode(F.filter("words", lambda w: w.isin(list(tokens)))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
        .collect()
    )
    n = {row["token"]: row["n"] for row in counts}
    return sorted(tokens, key=lambda t: (n.get(t, 0), t))


def _literal(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def license_hits(
    docs: DataFrame,
    templates: Sequence[Template] = PHRASES + NOTICES,
    threshold: float = THRESHOLD,
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs`` with its ``doc_id`` and what was found in its text.

    ``n_words``; ``n_places``, ``first_word`` and ``last_word``: places of phrases and their
    smallest and largest start (null without places); ``phrase_labels`` and ``labels``:
    sorted, distinct, the second with those of word sets too; ``score``: the largest share
    of a matched template's words in one block, 0 without labels.

    The join is exact: with tokens in one global order, a block that holds the wanted number
    of a template's tokens shares one of the first few of both (prefix filter), has enough
    tokens (length filter), and enough of them after the first common one (position filter).
    Pairs that pass are verified. Equal rows stay apart; null and empty texts have no words;
    no templates or no rows give nothing found. Templates must fit a block, others raise.
    """
    if not 0 < threshold <= 1:
        raise ValueError("The threshold must be above 0 and at most 1")
    if any(not 0 < len(t.words) <= STRIDE for t in templates):
        raise ValueError(f"A template has 1 to {STRIDE} words")
    spark = docs.sparkSession
    words = docs.select("doc_id", words_of(F.col(text)).alias("words"))
    vocabulary = sorted({w for t in templates for w in t.words})
    order = token_order(words, vocabulary) if vocabulary else []
    rank = {token: i for i, token in enumerate(order)}

    rows = []
    for template in templates:
        tokens = sorted(set(template.words), key=rank.get)
        need = len(tokens) if template.phrase else math.ceil(threshold * len(tokens) - 1e-9)
        for i, token in enumerate(tokens[: len(tokens) - need + 1]):
            phrase = template.words if template.phrase else []
            rows.append((token, template.label, tokens, phrase, i, need))
    index = spark.createDataFrame(
        rows,
        "token string, label string, t_tokens array<string>, phrase array<string>, i int, need int",
    )
    if len(rows) <= BROADCAST_TOKENS:
        index = F.broadcast(index)
    prefixes = sorted({row[0] for row in rows})

    size = F.size("words")
    starts = F.sequence(F.lit(0), size - 1, F.lit(STRIDE))
    blocks = F.transform(
        starts,
        lambda s: F.struct(s.alias("start"), F.slice("words", s + 1, 2 * STRIDE).alias("words")),
    )
    # Only blocks with a prefix token can match; a row without any stays as it is.
    wanted = F.filter(blocks, lambda b: F.arrays_overlap(b["words"], _literal(prefixes)))
    has_any = F.arrays_overlap("words", _literal(prefixes))
    row_columns = ["_row", "doc_id", "n_words"]
    # The row number only tells rows of one run apart; it is made and used within one plan.
    by_block = (
        words.withColumn("_row", F.monotonically_increasing_id())
        .withColumn("n_words", size.cast("bigint"))
        .select(*row_columns, F.explode_outer(F.when(has_any, wanted)).alias("block"))
        .withColumn("tokens", F.array_intersect(_literal(order), "block.words"))
    )
    n = F.size("tokens")
    candidates = (
        by_block.select(
            *row_columns, "block", "tokens", F.posexplode_outer("tokens").alias("j", "token")
        )
        .join(index, "token", "left")
        .withColumn(
            "candidate",
            (n >= F.col("need"))
            & (F.col("j") <= n - F.col("need"))
            & (F.least(F.size("t_tokens") - F.col("i"), n - F.col("j")) >= F.col("need")),
        )
    )
    shared = F.size(F.array_intersect("t_tokens", "tokens"))
    owned = F.sequence(F.lit(0), F.least(F.size("block.words"), F.lit(STRIDE)) - 1)
    places = F.filter(
        owned, lambda p: F.slice("block.words", p + 1, F.size("phrase")) == F.col("phrase")
    )
    is_phrase = F.size("phrase") > 0
    verified = (
        candidates.withColumn("shared", F.when(F.col("candidate"), shared))
        .withColumn("fits", F.coalesce(F.col("shared") >= F.col("need"), F.lit(False)))
        .withColumn("places", F.when(F.col("fits") & is_phrase, places))
        .withColumn("n_places", F.coalesce(F.size("places"), F.lit(0)))
        .withColumn("found", F.col("fits") & (~is_phrase | (F.col("n_places") > 0)))
    )
    start = F.col("block.start")
    placed = F.col("n_places") > 0
    found = verified.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.sum(F.greatest("n_places", F.lit(0))).cast("bigint").alias("n_places"),
        F.min(F.when(placed, start + F.array_min("places"))).cast("bigint").alias("first_word"),
        F.max(F.when(placed, start + F.array_max("places"))).cast("bigint").alias("last_word"),
        F.collect_set(F.when(placed, F.col("label"))).alias("phrase_labels"),
        F.collect_set(F.when(F.col("found"), F.col("label"))).alias("labels"),
        F.max(F.when(F.col("found"), F.col("shared") / F.size("t_tokens"))).alias("score"),
    )
    return found.select(
        "doc_id", "n_words", "n_places", "first_word", "last_word",
        F.array_sort("phrase_labels").alias("phrase_labels"),
        F.array_sort("labels").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _listed(values: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _templates_sql() -> str:
    rows = []
    for t in PHRASES + NOTICES:
        tokens = sorted(set(t.words))
        need = len(tokens) if t.phrase else math.ceil(THRESHOLD * len(tokens) - 1e-9)
        rows.append(f"('{t.label}', {t.phrase}, {_listed(t.words)}, {_listed(tokens)}, {need})")
    return ",\n".join(rows)


OP1_SQL = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
templates(label, phrase, words, tokens, need) AS (VALUES {_templates_sql()}),
blocks AS (
  SELECT doc_id, words[s + 1 : s + {2 * STRIDE}] AS block
  FROM words, unnest(range(0, len(words), {STRIDE})) AS t(s)
),
sets AS (
  SELECT doc_id, label, len(list_intersect(tokens, block)) / len(tokens) AS share
  FROM blocks, templates
  WHERE NOT phrase AND len(list_intersect(tokens, block)) >= need
),
places AS (
  SELECT doc_id, label, p
  FROM words JOIN templates ON phrase, unnest(range(0, len(words.words))) AS t(p)
  WHERE words.words[p + 1 : p + len(templates.words)] = templates.words
),
base AS (
  SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY doc_id
),
labelled AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT doc_id, label, share FROM sets
        UNION ALL SELECT doc_id, label, 1.0::DOUBLE FROM places)
  GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN labelled USING (doc_id)
"""


@query("op1_license_scan", OP1_SQL)
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_hits(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        F.col("n_places").alias("n_base"),
        "first_word",
        "last_word",
        F.array_join("phrase_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
