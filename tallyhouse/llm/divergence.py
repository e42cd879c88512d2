"""How the sources of a language differ: divergence of each pair, and the terms that set one apart.

A source's divergent terms are ranked by cells: all terms with the same count in the group and in
its language have the same value, so values are ranked by how many terms their cells hold, and
only the cells that reach the report are expanded into terms.
"""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.batches import slices
from tallyhouse.llm.registry import query, table
from tallyhouse.plans.lookups import join_lookup, stored_lookup
from tallyhouse.plans.shared import written

LEAST_DOCUMENTS = 10
TOP = 10
SCALE = 1_000_000_000
# Two factors of the scale, so that a share is divided in two steps that stay within 64 bits.
STEPS = (31_250, 32_000)
# Sources and terms of one grid of shares.
GRID_SOURCES = 64
GRID_TERMS = 4096
# A task sends its counts on once it holds so many.
HELD_COUNTS = 400_000
OUT_ROWS = 50_000

# A-Z become a-z; every other ASCII byte but a-z becomes a blank; bytes of other characters stay.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("docs", T.LongType()),
    ]
)
PARTIAL_PAIRS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("s", T.IntegerType()),
        T.StructField("t", T.IntegerType()),
        T.StructField("value", T.LongType()),
        T.StructField("present", T.LongType()),
    ]
)


def terms(text: bytes) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, with A-Z in lower case."""
    return text.translate(FOLD).split()


def _counted(batches):
    """Counts of terms by group, as often as the task's memory asks; a null term marks a group."""
    total, docs = defaultdict(Counter), defaultdict(Counter)

    def sent():
        rows = []
        for group, counter in total.items():
            rows.append((*group, None, 0, 0))
            held = docs[group]
            for term, n in counter.items():
                rows.append((*group, term, n, held[term]))
                if len(rows) >= OUT_ROWS:
                    yield batch_of(rows)
                    rows = []
        if rows:
            yield batch_of(rows)
        total.clear()
        docs.clear()

    def batch_of(rows):
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=COUNTS.names
        )

    for batch in slices(batches):
        columns = (batch.column(name).to_pylist() for name in ("lang", "source", "text"))
        for lang, source, text in zip(*columns):
            found = terms(text)
            total[lang, source].update(found)
            docs[lang, source].update(set(found))
        if sum(map(len, total.values())) >= HELD_COUNTS:
            yield from sent()
    yield from sent()


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs) of all whole texts; a null term stands for the group itself."""

    def known(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = docs.select(
        known(lang).alias("lang"), known(source).alias("source"), known(text).cast("binary").alias("text")
    )
    return (
        rows.mapInArrow(_counted, COUNTS)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of two numbers that are not negative."""
    return F.call_function("div", a, b)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact up to 2 ** 48 occurrences."""
    over = F.greatest(total + 2 * kept, F.lit(1).cast("bigint"))
    first = (count + 2) * F.lit(STEPS[0]).cast("bigint")
    whole, rest = _div(first, over), F.pmod(first, over)
    return 1 + whole * STEPS[1] + _div(rest * F.lit(STEPS[1]).cast("bigint"), over)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / (p + q)) of two shares."""
    return _div((p - q) * (p - q), p + q)


class Kept:
    """Counts of the kept terms, written once: by group, and what each group needs to know.

    ``counts`` is (lang, source, term, n, lang_n); ``groups`` is (lang, source, place, sources,
    total, kept, lang_total), a row for every (lang, source) that occurs.
    """

    def __init__(self, docs: DataFrame, text: str, lang: str, source: str, least: int):
        every = written(term_counts(docs, text, lang, source), "divergence-terms")
        named = every.where("term is not null").select("lang", "source", "term", "n")
        of_lang = written(
            every.where("term is not null")
            .groupBy("lang", "term")
            .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= least)
            .drop("docs"),
            "divergence-kept",
        )
        self.counts = written(
            join_lookup(named, stored_lookup(of_lang), ["lang", "term"], "inner", ["source"]),
            "divergence-counts",
        )
        langs = of_lang.groupBy("lang").agg(
            F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")
        )
        totals = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        within = Window.partitionBy("lang")
        groups = (
            every.where("term is null")
            .select("lang", "source")
            .withColumn("place", F.row_number().over(within.orderBy("source")) - 1)
            .withColumn("sources", F.count(F.lit(1)).over(within))
            .join(totals, ["lang", "source"], "left")
        )
        lookup = stored_lookup(written(langs, "divergence-langs"))
        joined = join_lookup(groups, lookup, ["lang"], "left", ["source"])
        self.groups = written(
            joined.fillna(0, ["total", "kept", "lang_total"]), "divergence-groups"
        )

    def known(self, df: DataFrame, spread_by: list[str]) -> DataFrame:
        """Rows with what their group knows."""
        return join_lookup(df, stored_lookup(self.groups), ["lang", "source"], "inner", spread_by)


def divergent_terms(kept: Kept, top: int) -> DataFrame:
    """The ``top`` terms of each group that it uses more than its language, by cells of counts."""
    cells = kept.counts.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("held"))
    known = kept.known(cells, ["n", "lang_n"])
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    valued = written(
        known.withColumns({"_p": p, "_q": q})
        .where("n > 0 and _p > _q")
        .select("lang", "source", "n", "lang_n", "held", divergence(F.col("_p"), F.col("_q")).alias("value")),
        "divergence-cells",
    )
    # Equal values of different cells are one value. A group needs at most ``top`` of them, and
    # those only as long as the larger ones hold fewer than ``top`` terms.
    group = Window.partitionBy("lang", "source")
    best = (
        valued.groupBy("lang", "source", "value")
        .agg(F.sum("held").alias("held"))
        .withColumn("_place", F.row_number().over(group.orderBy(F.desc("value"))))
        .where(F.col("_place") <= top)
        .withColumn("_before", F.sum("held").over(group.orderBy(F.desc("value"))) - F.col("held"))
        .where(F.col("_before") < top)
        .select("lang", "source", "value")
    )
    needed = written(
        join_lookup(
            valued.drop("held"),
            stored_lookup(written(best, "divergence-best")),
            ["lang", "source", "value"],
            "inner",
            ["n", "lang_n"],
        ),
        "divergence-needed",
    )
    cell = ["lang", "source", "n", "lang_n"]
    expanded = join_lookup(kept.counts, stored_lookup(needed), cell, "inner", ["term"])
    return (
        expanded.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "term")))
        .where(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )


def _grid_pairs(key: tuple, rows: pa.Table) -> pa.Table:
    """Divergences of the pairs of one grid, summed over the terms that occur in it."""
    lang, x, y, _ = (k.as_py() for k in key)
    term = rows.column("term").combine_chunks().dictionary_encode()
    place, p = rows.column("place").to_numpy(), rows.column("p").to_numpy()
    marks = term.indices.is_null().to_numpy(zero_copy_only=False)
    order = np.argsort(place[marks])
    places = place[marks][order]
    grid = np.repeat(p[marks][order][:, None], len(term.dictionary), axis=1)
    code = term.indices.fill_null(0).to_numpy()[~marks]
    grid[np.searchsorted(places, place[~marks]), code] = p[~marks]
    found = ([], [], [])
    for i in np.flatnonzero(places // GRID_SOURCES == x):
        after = np.flatnonzero((places // GRID_SOURCES == y) & (places > places[i]))
        off, both = grid[after] - grid[i], grid[after] + grid[i]
        found[0].append(np.full(len(after), places[i], dtype=np.int32))
        found[1].append(places[after].astype(np.int32))
        found[2].append((off * off // both).sum(axis=1))
    s, t, value = (np.concatenate(c) if c else np.zeros(0, np.int32) for c in found)
    return pa.table(
        {
            "lang": pa.array([lang] * len(s), pa.string()),
            "s": pa.array(s, pa.int32()),
            "t": pa.array(t, pa.int32()),
            "value": pa.array(value.astype(np.int64)),
            "present": pa.array(np.full(len(s), len(term.dictionary), dtype=np.int64)),
        }
    )


def pair_divergences(kept: Kept) -> DataFrame:
    """Each other source of a group's language by the divergence of the two, over all kept terms.

    Terms and sources are dealt to grids of bounded size; a grid sends one row a pair. Every
    source stands in each of its grids with the share of a term that it lacks.
    """
    size = F.lit(GRID_SOURCES)
    blocks = F.ceil(F.col("sources") / size).cast("int")
    slices_ = F.greatest(F.ceil(F.col("kept") / F.lit(GRID_TERMS)), F.lit(1)).cast("int")
    own = F.floor(F.col("place") / size).cast("int")

    def dealt(df, count, term, slice_):
        other = F.explode(F.sequence(F.lit(0), blocks - 1))
        return df.withColumn("_other", other).select(
            "lang",
            F.least(own, "_other").alias("x"),
            F.greatest(own, "_other").alias("y"),
            slice_.alias("slice"),
            "place",
            term.alias("term"),
            share(count, F.col("total"), F.col("kept")).alias("p"),
        )

    zero = F.lit(0).cast("bigint")
    of_terms = dealt(
        kept.known(kept.counts, ["term"]),
        F.col("n"),
        F.col("term"),
        F.pmod(F.xxhash64("term"), slices_.cast("bigint")).cast("int"),
    )
    slices_of = kept.groups.withColumn("_slice", F.explode(F.sequence(F.lit(0), slices_ - 1)))
    lacking = dealt(slices_of, zero, F.lit(None).cast("string"), F.col("_slice"))
    partial = of_terms.unionByName(lacking).groupBy("lang", "x", "y", "slice").applyInArrow(
        _grid_pairs, PARTIAL_PAIRS
    )
    pairs = partial.groupBy("lang", "s", "t").agg(
        F.sum("value").alias("value"), F.sum("present").alias("present")
    )
    none = share(zero, F.col("total"), F.col("kept"))
    sides = [
        kept.groups.select(
            "lang",
            F.col("place").alias(c),
            F.col("source").alias(f"{c}_source"),
            none.alias(f"{c}_none"),
            *(["kept"] if c == "s" else []),
        )
        for c in "st"
    ]
    pairs = join_lookup(written(pairs, "divergence-pairs"), stored_lookup(sides[0]), ["lang", "s"], "inner", ["t"])
    pairs = join_lookup(pairs, stored_lookup(sides[1]), ["lang", "t"], "inner", ["s"])
    # Terms that no source of a grid has were not in it; all of them have the same value.
    value = F.col("value") + (F.col("kept") - F.col("present")) * divergence(F.col("s_none"), F.col("t_none"))
    both = F.array(
        F.struct(F.col("s_source").alias("source"), F.col("t_source").alias("item")),
        F.struct(F.col("t_source").alias("source"), F.col("s_source").alias("item")),
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        pairs.select("lang", F.when(F.col("kept") > 0, value).otherwise(zero).alias("value"), F.inline(both))
        .withColumn("rank", F.row_number().over(ranked))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    )


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank): pairs of sources, and terms that set a source apart.

    Nulls in the three columns count as empty strings. A language keeps the terms that at least
    ``least_documents`` of its rows hold; a row that repeats counts again. A group without terms
    is compared like any other; a language without kept terms gives pairs of value 0 and no
    terms. Equal values rank by the UTF-8 bytes of the item. Other columns are left out; an empty
    table gives no rows. Texts are read whole.
    """
    kept = Kept(docs, text, lang, source, least_documents)
    return pair_divergences(kept).unionByName(divergent_terms(kept, top))


OP13_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS MATERIALIZED (SELECT lang, source, doc, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= {LEAST_DOCUMENTS}),
l AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(any_value(s), 0) AS total
      FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(n)::BIGINT AS s FROM c GROUP BY ALL) USING (lang, source) GROUP BY ALL),
grid AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + {SCALE}::BIGINT * (coalesce(c.n, 0) + 2) // (g.total + 2 * l.v) AS p,
         1 + {SCALE}::BIGINT * (k.n + 2) // (l.total + 2 * l.v) AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(value), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
             FROM grid x JOIN grid y USING (lang, term) WHERE x.source <> y.source GROUP BY ALL) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  GROUP BY ALL),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM grid WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank
FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value,
         (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank
  FROM terms) WHERE rank <= {TOP}
"""


@query("op13_divergence_audit", OP13_SQL)
def op13_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))
