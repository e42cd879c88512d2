import numpy as np
import pytest

from tallyhouse.llm import vector_codes as op
from tests.compare import compare, duck

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """Codes by comparing every part with every entry, one at a time."""
    kept = [
        (i, np.floor(1024 * np.array(v, dtype=np.float64)).astype(np.int64), label)
        for i, v, label in rows
        if v is not None and all(c is not None and np.isfinite(c) for c in v)
    ]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0], kept[r][1].tolist()))
    cut = np.array([v for _, v, _ in kept]).reshape(len(kept), parts, -1)
    books = [cut[order[:entries], p].copy() for p in range(parts)]
    for step in range(rounds + 1):
        far = [((cut[:, p, None, :] - books[p][None]) ** 2).sum(axis=2) for p in range(parts)]
        best = [f.argmin(axis=1) for f in far]
        if step < rounds:
            for p in range(parts):
                for e in set(best[p].tolist()):
                    members = cut[best[p] == e, p]
                    books[p][e] = members.sum(axis=0) // len(members)
    error = sum(f.min(axis=1) for f in far)
    totals = {}
    for (_, _, label), e in zip(kept, error.tolist()):
        totals[label] = totals.get(label, 0) + e
    codes = ["".join(f"{best[p][r]:02x}" for p in range(parts)) for r in range(len(kept))]
    found = [(k[0], c, e, totals[k[2]]) for k, c, e in zip(kept, codes, error.tolist())]
    return sorted(found, key=str), books


def same(spark, rows, schema=SCHEMA, **options):
    codes, books = op.compress(spark.createDataFrame(rows, schema), **options)
    found = [(r.vec_id, r.code, r.error, r.label_error) for r in codes.collect()]
    expected, expected_books = brute(rows, **options)
    assert sorted(found, key=str) == expected
    assert op.books_sha256(books) == op.books_sha256(expected_books)


def vectors(n, width=8, seed=1, scale=1.0):
    values = np.random.default_rng(seed).normal(0, scale, (n, width)).astype(np.float32)
    return [(i, values[i].tolist(), i % 3 if i % 5 else None) for i in range(n)]


def test_query_equals_its_twin(spark, small):
    problems, n, _ = compare(spark, duck(small), small, op.op12_vector_codes, op._op12_sql())
    assert not problems and n > 0


def test_odd_rows(spark):
    rows = vectors(700) + [
        (900, None, 1),
        (901, [0.1, None] + [0.0] * 6, 1),
        (902, [float("nan")] * 8, 1),
        (903, [float("-inf")] * 8, 1),
        (None, [0.5] * 8, None),
        (None, [0.25] * 8, 2),
        (5, [-0.0004] * 8, 0),
        (5, [-0.0004] * 8, 0),
    ]
    same(spark, rows)
    same(spark, rows, entries=7, rounds=2)
    same(spark, rows, parts=2, entries=256, rounds=1)


def test_copies_and_ties(spark):
    """A third of all rows are one vector; many more lie as near to one entry as to another."""
    rows = vectors(400) + [(1000 + i, [0.5] * 8, 1) for i in range(300)]
    rows += [(-1000 + i, [float(i % 4)] * 8, 1) for i in range(200)]
    same(spark, rows)


def test_large_components_stay_exact(spark):
    rows = vectors(300, scale=20_000.0)
    kept = op.whole_numbers(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label")
    spread = op.spread_of(kept, 4)
    assert 2 * (2 * spread.largest + 2) ** 2 >= op.EXACT
    same(spark, rows)
    with pytest.raises(ValueError, match="too large"):
        op.compress(spark.createDataFrame([(1, [1e9] * 8, 1)], SCHEMA))


def test_widths(spark):
    for rows in ([(1, [1.0] * 6, 1)], [(1, [1.0] * 8, 1), (2, [1.0] * 4, 1)]):
        with pytest.raises(ValueError, match="width"):
            op.compress(spark.createDataFrame(rows, SCHEMA))
    codes, _ = op.compress(spark.createDataFrame([(1, [], 1), (2, [], None)], SCHEMA))
    assert {(r.vec_id, r.code, r.error) for r in codes.collect()} == {(1, "00000000", 0), (2, "00000000", 0)}


def test_empty_table_and_other_columns(spark):
    codes, books = op.compress(spark.createDataFrame([], SCHEMA))
    assert codes.count() == 0 and op.books_sha256(books) == op.books_sha256([])
    more = spark.createDataFrame(vectors(20), SCHEMA).selectExpr(
        "*", "1 as row", "2 as part", "'x' as code", "3 as key", "'y' as _label", "4 as v"
    )
    codes, _ = op.compress(more)
    assert codes.columns == ["vec_id", "label", "code", "error", "label_error"] and codes.count() == 20


@pytest.mark.parametrize("width, bits", [(2, 4), (3, 3), (5, 2), (6, 1)])
def test_curve_visits_every_cell_by_single_steps(width, bits):
    axes = np.meshgrid(*[np.arange(1 << bits)] * width, indexing="ij")
    cells = np.stack([a.ravel() for a in axes], axis=1)
    keys = op.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_keep_every_nearest_entry():
    random = np.random.default_rng(3)
    for _ in range(200):
        points = random.integers(-9, 9, (6, 3))
        entries = random.integers(-9, 9, (12, 3))
        may = op.shortlists(points.min(axis=0)[None], points.max(axis=0)[None], entries)[0]
        far = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert may[np.flatnonzero((far == far.min(axis=1, keepdims=True)).any(axis=0))].all()
