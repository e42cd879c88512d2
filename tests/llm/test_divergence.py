import random
import re
from collections import Counter, defaultdict

import pytest

from tallyhouse.llm import divergence as op
from tests.compare import compare, duck
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, top=10):
    """The report from the definitions, term by term and pair by pair."""
    counts, langs, held = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(found)
        langs[lang].update(found)
        held[lang].update(set(found))
    kept = {lang: [t for t in held[lang] if held[lang][t] >= least] for lang in langs}
    out = []
    for (lang, source), own in counts.items():
        v = len(kept[lang])

        def shares(counter):
            total = sum(counter[t] for t in kept[lang])
            return {t: 1 + 10**9 * (counter[t] + 2) // (total + 2 * v) for t in kept[lang]}

        p, q = shares(own), shares(langs[lang])

        def off(a, b):
            return (a - b) ** 2 // (a + b)

        found = [(-off(p[t], q[t]), t.encode(), t) for t in kept[lang] if own[t] and p[t] > q[t]]
        out += [(lang, source, "term", t, -f, i + 1) for i, (f, _, t) in enumerate(sorted(found)[:top])]
        pairs = []
        for other_lang, other in counts:
            if other_lang == lang and other != source:
                r = shares(counts[lang, other])
                pairs.append((-sum(off(p[t], r[t]) for t in kept[lang]), other.encode(), other))
        out += [(lang, source, "pair", o, -f, i + 1) for i, (f, _, o) in enumerate(sorted(pairs))]
    return sorted(out)


def found(spark, rows, least, **options):
    df = op.audit(cases.documents(spark, rows), least_documents=least, **options)
    assert dict(df.dtypes)["value"] == "bigint" and dict(df.dtypes)["rank"] == "int"
    return sorted(map(tuple, df.collect()))


def some_rows(n, sources, words, langs=("en", "de"), seed=5):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        size = pick.choice((0, 3, 10, 40))
        text = " ".join(f"W{chr(97 + k % 26)}{'x' * (k // 26)}" for k in pick.choices(range(words), k=size))
        # A third of all rows come from one source.
        source = "s0" if i % 3 == 0 else f"s{pick.randrange(sources)}"
        rows.append((i, text, pick.choice(langs), source))
    return rows


def test_query_equals_its_twin(spark, small):
    problems, n, _ = compare(spark, duck(small), small, op.op13_divergence_audit, op.OP13_SQL)
    assert not problems and n > 0


@pytest.mark.parametrize("least", [1, 2, 5])
def test_odd_rows(spark, least):
    odd = [
        (1, "Ärger ÄRGER ärger a-b_cK 9z \U0001f600 x", None, None),
        (2, "\x00A\x00b\x7fA", "", ""),
        (None, None, "xx", "only"),
        (3, "a a a b", "xx", "other"),
        (4, "", "one", "alone"),
        (5, "é é E", "en", "é"),
    ]
    rows = cases.TEXTS + odd * 2
    assert found(spark, rows, least) == brute(rows, least)


@pytest.mark.parametrize("top", [1, 10, 1000])
def test_ties_among_cells(spark, top):
    rows = some_rows(400, 5, 60)
    rows += [(1000 + i, f"only{i:03d} zz", "en", "s1") for i in range(200)]
    rows = [(i, re.sub(r"\d", lambda m: chr(97 + int(m.group())), t), lang, s) for i, t, lang, s in rows]
    assert found(spark, rows, 1, top=top) == brute(rows, 1, top)


def test_many_sources_and_terms_fill_several_grids(spark, monkeypatch):
    rows = some_rows(600, 23, 90)
    whole = brute(rows, 2)
    assert found(spark, rows, 2) == whole
    monkeypatch.setattr(op, "GRID_SOURCES", 4)
    monkeypatch.setattr(op, "GRID_TERMS", 7)
    assert found(spark, rows, 2) == whole


def test_tasks_that_send_often(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict(
        {"lang": ["a", "a", "b"], "source": ["", "", "s"], "text": [b"x y x", b"x", b""]}
    )
    whole = [r for b in op._counted([batch, batch]) for r in b.to_pylist()]
    monkeypatch.setattr(op, "HELD_COUNTS", 1)
    monkeypatch.setattr(op, "OUT_ROWS", 1)
    sent = [r for b in op._counted([batch, batch]) for r in b.to_pylist()]
    assert len(sent) > len(whole)

    def summed(rows):
        total = Counter()
        for r in rows:
            total[r["lang"], r["source"], r["term"], "n"] += r["n"]
            total[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return total

    assert summed(whole) == summed(sent)
    assert summed(whole)["a", "", "x", "n"] == 6 and summed(whole)["a", "", "x", "docs"] == 4


def test_shares_of_large_counts(spark):
    from pyspark.sql import functions as F

    rows = [(0, 0, 1), (2**47, 2**48, 5 * 10**6), (10**12 + 1, 10**14, 12345678), (10**14, 10**14, 1)]
    df = spark.createDataFrame(rows, "c bigint, n bigint, v bigint")
    got = [r[0] for r in df.select(op.share(F.col("c"), F.col("n"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in rows]


def test_empty_table_and_other_columns(spark):
    assert op.audit(cases.documents(spark, [])).count() == 0
    plain = op.audit(cases.documents(spark), least_documents=1).collect()
    more = cases.documents(spark, extra=True).selectExpr("*", "1 as n", "2 as p", "3 as place", "4 as term")
    assert sorted(op.audit(more, least_documents=1).collect()) == sorted(plain)
