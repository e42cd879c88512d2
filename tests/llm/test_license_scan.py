import math
import re

import pytest

from tallyhouse.llm import license_scan as op
from tests.llm import cases


def brute(text):
    words = re.findall(op.WORDS, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places, labels, score = [], set(), 0.0
    phrases = set()
    for t in op.PHRASES:
        for p in range(len(words)):
            if words[p : p + len(t.words)] == t.words:
                places.append(p)
                phrases.add(t.label)
                score = 1.0
    for t in op.NOTICES:
        tokens = set(t.words)
        for s in range(0, len(words), op.STRIDE):
            shared = len(tokens & set(words[s : s + 2 * op.STRIDE]))
            if shared >= math.ceil(op.THRESHOLD * len(tokens) - 1e-9):
                labels.add(t.label)
                score = max(score, shared / len(tokens))
    first, last = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), first, last, sorted(phrases), sorted(phrases | labels), score)


def found(df):
    return sorted(
        [
            (r.doc_id, (r.n_words, r.n_places, r.first_word, r.last_word, r.phrase_labels, r.labels, r.score))
            for r in op.license_hits(df).collect()
        ],
        key=str,
    )


NOTICE = " ".join(op.NOTICES[1].words)
ROWS = [
    (20, "x " * 47 + "all rights reserved " + "y " * 30 + "General Public License", "en", "a"),
    (21, "x " * 90 + NOTICE.replace("binary", "other") + " z" * 200, "en", "a"),
    (22, "x " * 90 + " q ".join(NOTICE.split()[::2]), "en", "a"),
    (23, "Released under the MIT License. " * 50, "en", "a"),
    (24, "cc cc by by", "en", "a"),
]


@pytest.mark.parametrize("extra", [False, True])
def test_equals_brute_force(spark, extra):
    rows = cases.TEXTS + ROWS
    expected = sorted([(i, brute(t)) for i, t, _, _ in rows], key=str)
    assert found(cases.documents(spark, rows, extra)) == expected
    assert any("bsd" in labels for _, (*_, labels, _) in expected)


def test_empty_table_and_no_templates(spark):
    assert found(cases.empty(spark)) == []
    rows = op.license_hits(cases.documents(spark, ROWS), []).collect()
    assert len(rows) == len(ROWS) and all(r.labels == [] and r.n_places == 0 for r in rows)


def test_bad_settings_raise(spark):
    with pytest.raises(ValueError):
        op.license_hits(cases.empty(spark), threshold=0)
    with pytest.raises(ValueError):
        op.license_hits(cases.empty(spark), [op.Template("long", "w " * 200)])
