import hashlib
import re

import pytest

from tallyhouse.llm import substring_dedup as op
from tallyhouse.llm.automaton import SuffixAutomaton
from tests.llm import cases

N = op.WINDOW


def brute(rows):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, words in split:
        for k in range(len(words) - N + 1) if i is not None else ():
            window = tuple(words[k : k + N])
            least[window] = min(i, least.get(window, i))
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - N + 1) if i is not None else ():
            if least[tuple(words[k : k + N])] < i:
                gone.update(range(k, k + N))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in op.remove_repeats(df).collect()], key=str)


def near(text, k):
    words = text.split()
    words[k] = "changed"
    return " ".join(words)


ROWS = [
    (30, "a " * 40, "en", "a"),
    (31, "b " * 3 + "a " * 20, "en", "a"),
    (32, near(cases.PASSAGE, 20), "en", "a"),
    (33, near(cases.PASSAGE, 13), "en", "a"),
    (34, cases.PASSAGE + " " + near(cases.PASSAGE, 2), "en", "a"),
    (0, " ".join(cases.PASSAGE.split()[5:30]), "en", "a"),
    (35, "x\u00a0y " + cases.PASSAGE.replace("p1 ", "p1\u2003 "), "en", "a"),
]


@pytest.mark.parametrize("hot", [2000, 1])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(op, "HOT_PLACES", hot)
    rows = cases.TEXTS + ROWS
    expected = brute([(i, t) for i, t, _, _ in rows])
    assert sum(n for _, _, n, _ in expected) > 300
    assert found(cases.documents(spark, rows, extra=True)) == expected


def test_equals_brute_force_on_given_documents(spark, small):
    docs = cases.given(spark, small)
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    assert found(cases.empty(spark)) == []


def test_matching_statistics():
    texts = ["a b c d", "c d e f", "a a a b"]
    automaton = SuffixAutomaton()
    for text in texts:
        automaton.add(text.split())
    runs = {tuple(t.split()[i:j]) for t in texts for i in range(4) for j in range(i + 1, 5)}
    stream = "a b c d e f a a b c x c d d a a a a b".split()
    expected = [
        max((n for n in range(k + 2) if tuple(stream[k + 1 - n : k + 1]) in runs), default=0)
        for k in range(len(stream))
    ]
    assert automaton.matches(stream) == expected
