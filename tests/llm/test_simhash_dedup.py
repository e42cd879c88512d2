import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallyhouse.llm import simhash_dedup as op
from tallyhouse.llm.components import components
from tests.llm import cases


def brute_fingerprint(text):
    words = bytes(text or "", "utf-8").lower().split()
    if not words:
        return 0
    n = max(len(words) - 3, 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def roots_of(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def brute_groups(prints):
    """{fingerprint: root} by all pairs."""
    nodes = sorted(set(prints))
    pairs = [(a, b) for i, a in enumerate(nodes) for b in nodes[:i] if (a ^ b).bit_count() <= 4]
    return roots_of(nodes, pairs)


def check_groups(rows):
    """rows: (doc_id, unsigned fingerprint, component_id)."""
    roots = brute_groups([p for _, p, _ in rows])
    least = {}
    for i, p, _ in rows:
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    for _, p, component in rows:
        assert component == least.get(roots[p])


def grouped(df):
    return [(r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in op.group(df).collect()]


def test_given_documents(spark, small):
    docs = cases.given(spark, small)
    rows = grouped(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {i: p for i, p, _ in rows} == {i: brute_fingerprint(t) for i, t in texts.items()}
    check_groups(rows)


def test_odd_rows(spark):
    rows = grouped(cases.documents(spark, extra=True))
    assert len(rows) == len(cases.TEXTS)
    check_groups(rows)
    assert {p for i, p, _ in rows if i in (2, 3, 4)} == {0}
    assert {c for i, _, c in rows if i == 9} == {1}
    assert grouped(cases.empty(spark)) == []


def clustered(n, seed):
    """Fingerprints around few centres, so that cells are full and chains are long."""
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(4)]
    found = set(centres)
    while len(found) < n:
        value = draw.choice(sorted(found)[:50] + centres)
        for _ in range(draw.randint(1, 5)):
            value ^= 1 << draw.randrange(64)
        found.add(value)
    return sorted(found)


def test_links_keep_what_can_be_reached(spark):
    values = clustered(700, 1) + [random.Random(9).getrandbits(64) for _ in range(300)]
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    distinct = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in op.links(distinct).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    assert roots_of(values, found) == brute_groups(values)


def test_large_cells_give_forests():
    values = np.array(clustered(400, 3), dtype=np.uint64)
    found = [(int(a), int(b)) for x, y in op._forest(values, 4) for a, b in zip(x, y)]
    assert len(found) < len(values)
    assert roots_of(values.tolist(), found) == brute_groups(values.tolist())


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 260)]
    edges = chain + star + star + [(7, 7), (160, 5), (1000, 999)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.root for r in components(df).collect()}
    nodes = {n for a, b in edges for n in (a, b) if a != b}
    assert found == roots_of(nodes, [e for e in edges if e[0] != e[1]])
    assert components(df.limit(0)).count() == 0
    assert components(df.where(F.col("a") == F.col("b"))).count() == 0
