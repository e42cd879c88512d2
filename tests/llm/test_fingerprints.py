import hashlib

from pyspark.sql import functions as F

from tallyhouse.llm import fingerprints as op
from tests.llm import cases


def shingles(text):
    words = [w for w in text.lower().replace(" ", "x").split(" ") if w]
    words = text.lower().encode().split()
    if len(words) < op.SHINGLE_WORDS:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def share(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def write(spark, tmp_path, rows):
    folder = str(tmp_path)
    cases.documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    return folder


def expected_edits(rows):
    """{doc_id: set of (edited text, next text)}, rows by descending id, then text."""
    known = sorted([(-i, t or "") for i, t, _, _ in rows if i is not None])
    found = {}
    for k, (i, text) in enumerate(known):
        following = known[(k + 1) % len(known)][1]
        third = len(text) // 3
        found.setdefault(-i, []).append((text[: len(text) - third] + following[:third], following))
    for i, text, _, _ in rows:
        if i is None:
            text = text or ""
            found.setdefault(None, []).append((text[: len(text) - len(text) // 3], ""))
    return found


def check(spark, folder, rows):
    out = op.op9_fingerprints(spark, folder).collect()
    assert len(out) == len(rows)
    edits = expected_edits(rows)
    prints = {}
    for r in out:
        edited = {hashlib.sha256(t.encode()).hexdigest() for t, _ in edits[r.doc_id]}
        assert r.edited_sha256 in edited
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    for i, text, _, _ in rows:
        prints.setdefault(text or "", set()).update(r.fingerprint for r in out if r.doc_id == i)
    ids = [i for i, *_ in rows]
    assert all(len(p) == 1 for t, p in prints.items() if all(ids.count(i) == 1 for i, x, *_ in rows if x == t))
    return out


def test_odd_rows(spark, tmp_path):
    out = check(spark, write(spark, tmp_path, cases.TEXTS), cases.TEXTS)
    assert {r.fingerprint for r in out if r.doc_id in (2, 3, 4)} == {""}
    long = next(r for r in out if r.doc_id == 6)
    assert long.near_next > 0.9 and abs(long.near_edited - 1.0) < 0.1


def test_ids_far_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op, "LEVEL_BITS", 2)
    ids = [-(1 << 63), (1 << 63) - 1, 0, 1, -1, 255, 256, 70_000, 1 << 40, (1 << 40) + 1, -(1 << 40), *range(500, 900, 7)]
    rows = [(i, f"text of {i} " + "word " * (k % 9), "en", "a") for k, i in enumerate(ids)]
    check(spark, write(spark, tmp_path, rows), rows)


def test_small_tasks_and_repeated_ids(spark, tmp_path, monkeypatch):
    """One id on a third of the rows, and far more tasks than ranges, change nothing."""
    rows = [(7 if k % 3 == 0 else k, f"text {k} " + "word " * (k % 11), "en", "a") for k in range(3000)]
    monkeypatch.setattr(op.with_next, "__defaults__", (None, 500))
    folder = write(spark, tmp_path, rows)
    out = check(spark, folder, rows)
    paired = op.with_next(spark.read.parquet(f"{folder}/documents.parquet"), ["text"])
    got = {(r.doc_id, r.text): r.next_text for r in paired.collect()}
    known = sorted([(-i, t) for i, t, _, _ in rows])
    assert got == {(-i, t): known[(k + 1) % len(known)][1] for k, (i, t) in enumerate(known)}
    assert len(out) == 3000


def test_given_documents(spark, small):
    docs = cases.given(spark, small)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    out = check(spark, small, rows)
    edits = expected_edits(rows)
    texts = {i: t for i, t, _, _ in rows}
    errors = [abs(r.near_edited - share(texts[r.doc_id], edits[r.doc_id][0][0])) for r in out]
    errors += [abs(r.near_next - share(texts[r.doc_id], edits[r.doc_id][0][1])) for r in out]
    assert sum(errors) / len(errors) < 0.06


def test_single_and_empty_tables(spark, tmp_path):
    rows = [(5, "only one document of nine words stands in here", "en", "a")]
    check(spark, write(spark, tmp_path / "one", rows), rows)
    assert op.op9_fingerprints(spark, write(spark, tmp_path / "none", [])).count() == 0


def test_sketches_merge(spark):
    a, b = cases.LONG[:9000], cases.PASSAGE
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        op.sketch(F.col("a")).alias("a"), op.sketch(F.col("b")).alias("b"), op.shingle_hashes(F.col("a")).alias("x"),
        op.shingle_hashes(F.col("b")).alias("y"),
    )
    row = df.first()
    union = set(row.x) | set(row.y)
    merged = {h for h in {*row.a, *row.b} if h < op.CEILING or h == min(*row.a, *row.b)}
    assert merged == {h for h in union if h < op.CEILING or h == min(union)}
    assert row.a == sorted(set(row.a))


def test_containment_of_unequal_texts(spark):
    part = " ".join(cases.LONG.split()[1000:3000])
    df = spark.createDataFrame([(part, cases.LONG)], "a string, b string")
    a, b = op.sketch(F.col("a")), op.sketch(F.col("b"))
    row = df.select(op.containment(a, b).alias("c"), op.resemblance(a, b).alias("r")).first()
    assert row.c > 0.95 and row.r < 0.3
