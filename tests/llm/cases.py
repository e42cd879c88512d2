"""Small tables with everything that upsets an operator."""

LONG = " ".join(f"word{i % 977} tail{i % 13}" for i in range(60_000))
PASSAGE = " ".join(f"p{i}" for i in range(40))

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n ", "de", "b"),
    (5, LONG, "en", "a"),
    (6, LONG + " end", "en", None),
    (7, PASSAGE + " first of its kind", "en", "b"),
    (8, "before it " + PASSAGE + " after it", "fr", "b"),
    (9, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "c"),
    (9, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "c"),
    (10, "ÄÖÜ straße été ÑANDÚ 12345 !!! \u212a\u0130", "de", "c"),
    (None, PASSAGE, "en", "a"),
    (None, "alone without an id", None, "a"),
    (11, "1234 5678 !!!", "en", "\u00e9"),
    (12, "cc\nBY all rights\treserved, CC by. General-Public_License", "en", "a"),
]

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows=None, extra=False):
    """The rows as ``documents``; ``extra`` adds columns that operators use as names."""
    rows = TEXTS if rows is None else rows
    df = spark.createDataFrame(
        [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows], SCHEMA
    )
    if extra:
        for name in EXTRA:
            df = df.selectExpr("*", f"'kept' as `{name}`")
    return df


EXTRA = (
    "score", "words", "label", "labels", "spans", "base_spans", "features", "fingerprint", "lang_pred",
    "key", "block", "size", "windows", "anchors", "_row", "host", "rule", "token", "next_text",
)


def empty(spark):
    return documents(spark, [])


def given(spark, folder, name="documents"):
    return spark.read.parquet(f"{folder}/{name}.parquet")
