"""URL filters: rules found by their rarest token, so that few regular expressions run."""

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.registry import query, table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Rules come from the caller's program. Beyond so many they are joined by a shuffle.
BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    """A regular expression over ``host + path``.

    ``literals`` are tokens (``h:`` and a host label, or ``p:`` and a path word) of which
    every URL that can match has all. ``rank`` decides between rules that fit: the longest
    wins, then the smaller name.
    """

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    rank: int


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host with all its subdomains and for paths that start with ``path``."""
    labels = [f"h:{w}" for w in re.findall(r"[a-z0-9]+", host)]
    # The last word of a prefix may go on in the URL, so it is no token unless closed.
    words = [f"p:{w}" for w in re.findall(r"([a-z0-9]+)(?=[^A-Za-z0-9])", path)]
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(host + path, verdict, pattern, tuple(labels + words), 1000 + len(host + path))


def word_rule(word: str) -> Rule:
    """Blocks hosts one of whose labels holds ``word`` as a whole, between hyphens or ends."""
    first = re.findall(r"[a-z0-9]+", word)
    pattern = rf"^(?:[^/]*[.-])?{re.escape(word)}(?:[.-][^/]*)?(?:/|$)"
    return Rule(f"*{word}*", "block", pattern, tuple(f"h:{x}" for x in first), len(word))


# The rules that the query judges by.
HOST_RULES = (
    host_rule("allow", "org", "/"),
    host_rule("block", "example.org", "/es/"),
    host_rule("block", "example.org", "/en/1"),
    host_rule("allow", "com", "/fr/"),
    host_rule("block", "com", "/de/"),
)
# Words of hosts that sell what no corpus wants; they count where no host rule fits.
WORD_RULES = tuple(
    word_rule(word)
    for word in (
        "casino", "casino-win", "poker", "slots", "betting", "cheap-pills", "pills", "viagra",
        "cialis", "porn", "xxx", "sex", "escort", "torrent", "warez", "payday-loan",
    )
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(rest, F.lit(""))


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct host words (``h:``) and path words (``p:``)."""
    return F.array_distinct(
        F.concat(
            F.transform(
                F.regexp_extract_all(host, F.lit("[a-z0-9]+"), F.lit(0)),
                lambda w: F.concat(F.lit("h:"), w),
            ),
            F.transform(
                F.regexp_extract_all(path, F.lit("[a-z0-9]+"), F.lit(0)),
                lambda w: F.concat(F.lit("p:"), w),
            ),
        )
    )


def rarest_tokens(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, str]:
    """For every rule with literals, the one that the fewest URLs hold (ties: the smaller).

    ``urls`` has ``_tokens``. Counts cover all rows; only tokens of rules are counted.
    """
    wanted = sorted({token for rule in rules for token in rule.literals})
    counts = (
        urls.select(F.explode("_tokens").alias("token"))
        .where(F.col("token").isin(wanted))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
        .collect()
    )
    n = {row["token"]: row["n"] for row in counts}
    return {r.name: min(r.literals, key=lambda t: (n.get(t, 0), t)) for r in rules if r.literals}


def judge(
    pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` to every row.

    A null URL, or one without ``://``, has an empty host and path and gets the default.
    Equal rows are judged one by one. Columns named like the four are replaced. No rules
    give every row the default. Two rules of one name raise.
    """
    if len({rule.name for rule in rules}) < len(rules):
        raise ValueError("Two rules have the same name")
    spark = pages.sparkSession
    added = {"host", "path", "rule", "verdict"}
    kept = [c for c in pages.columns if c not in added]
    parts = (
        # One struct keeps the columns of the pages apart from those made here.
        pages.select(F.struct(*kept).alias("_page"), F.col(url).alias("_url"))
        .withColumn("_host", host_of(F.col("_url")))
        .withColumn("_path", path_of(F.col("_url")))
        .withColumn("_tokens", tokens_of(F.col("_host"), F.col("_path")))
    )
    if not rules:
        return parts.select(
            "_page.*", F.col("_host").alias("host"), F.col("_path").alias("path"),
            F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
        )
    rarest = rarest_tokens(parts, rules)
    # A rule without literals is tried on every URL, by a token that all of them get.
    index = spark.createDataFrame(
        [(rarest.get(r.name, ""), r.name, r.verdict, r.pattern, r.rank) for r in rules],
        "_token string, _name string, _verdict string, _pattern string, _rank int",
    )
    if len(rules) <= BROADCAST_RULES:
        index = F.broadcast(index)
    keys = sorted({rarest.get(r.name, "") for r in rules})
    fetched = F.filter(F.concat("_tokens", F.array(F.lit(""))), lambda t: t.isin(keys))
    # The id only has to tell rows of one run apart; it is made and used within one plan.
    tried = (
        parts.withColumn("_row", F.monotonically_increasing_id())
        .select("_row", "_host", "_path", "_page", F.explode_outer(fetched).alias("_token"))
        .join(index, "_token", "left")
    )
    fits = F.rlike(F.concat("_host", "_path"), F.col("_pattern"))
    # min over (-rank, name): the longest rule, then the smaller name.
    best = F.min(F.when(fits, F.struct((-F.col("_rank")).alias("r"), "_name", "_verdict")))
    return (
        tried.groupBy("_row")
        .agg(*[F.first(c).alias(c) for c in ("_host", "_path", "_page")], best.alias("_best"))
        .select(
            "_page.*",
            F.col("_host").alias("host"),
            F.col("_path").alias("path"),
            F.col("_best._name").alias("rule"),
            F.coalesce("_best._verdict", F.lit(default)).alias("verdict"),
        )
    )


_WORDS_SQL = " OR ".join(f"regexp_matches(host || path, '{rule.pattern}')" for rule in WORD_RULES)

OP3_SQL = rf"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
),
rules(rule, rule_host, rule_path, verdict) AS (
  VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
         ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
         ('com/de/', 'com', '/de/', 'block')
),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN verdict
            WHEN {_WORDS_SQL} THEN 'block' ELSE 'allow' END AS verdict
FROM parts LEFT JOIN best USING (page_id)
"""


@query("op3_url_filter", OP3_SQL)
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The host rules; where none fits, the words of hosts decide and ``rule`` is null."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = judge(pages, HOST_RULES + WORD_RULES)
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("rule").isin([r.name for r in HOST_RULES]), F.col("rule")).alias("rule"),
        "verdict",
    )
