import random

import pytest

from tallyhouse.llm import decontamination as op
from tests.llm import cases

ITEM = "if a train leaves Boston at 60 km per hour and reaches Boston again after 90 minutes how far did it go"
ITEMS = [
    (1, ITEM),
    (2, "short question with few literal words"),
    (3, None),
    (4, ""),
    (None, ITEM),
    (5, "Anna 5 km Ben 6 km Carl 7 km Dora 8 km Emil"),
    (1, ITEM),
]


def found(spark, texts, items=ITEMS, **options):
    docs = cases.documents(spark, [(i, t, "en", "a") for i, t in texts], extra=True)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in op.contaminated(docs, benchmark, **options).collect()}


TEXTS = [
    (10, "so " + ITEM + " then"),
    (11, "so " + ITEM.replace("Boston", "Paris").replace("60", "75").replace("km", "miles") + " then"),
    (12, ITEM.replace("leaves", "left").replace("reaches", "reached").replace("how", "so")),
    (13, "we ask a short question with few literal words here"),
    (14, "a short question with few other words"),
    (15, "Zoe 1 m Yan 2 m Xi 3 m Wim 4 m Vic"),
    (16, None),
    (17, ""),
    (None, ITEM),
    (18, ITEM + " " + ITEM),
]


@pytest.mark.parametrize("max_rows", [100_000, 0])
def test_reparameterised_questions(spark, max_rows):
    hits = found(spark, TEXTS, max_rows=max_rows)
    assert {i for i, item in hits if item == 1} >= {10, 11, 18}
    assert hits[10, 1].share == hits[11, 1].share == 1.0
    assert hits[10, 1].first_word == 1 and hits[10, 1].n_windows == hits[11, 1].n_windows
    assert hits[18, 1].n_windows == 2 * hits[10, 1].n_windows
    assert (12, 1) not in hits or hits[12, 1].share < 0.5
    assert {i for i, item in hits if item == 2} == {13}
    assert not {k for k in hits if k[1] not in (1, 2) or k[0] in (14, 15, 16, 17, None)}


def test_slots_within_one_window(spark):
    same = "first compare the price of Anna with the price of Anna again"
    hits = found(spark, [(1, same.replace("Anna", "Bert")), (2, same.replace("Anna again", "Bert again"))], [(7, same)])
    assert (1, 7) in hits and hits[1, 7].share == 1.0
    # Two of the item's three windows hold both places.
    assert hits[2, 7].n_windows == 1


def test_verbatim_passages_of_given_tables(spark, medium):
    docs, items = cases.given(spark, medium), cases.given(spark, medium, "benchmark")
    plain = {i.item_id: " ".join(i.text.split()) for i in items.collect()}
    expected = {
        (d.doc_id, i)
        for d in docs.collect()
        for i, text in plain.items()
        if text in " ".join((d.text or "").split())
    }
    hits = {(r.doc_id, r.item_id) for r in op.contaminated(docs, items).collect()}
    assert expected and expected <= hits
    assert len({d for d, _ in hits}) < 0.06 * docs.count()


def test_empty_tables(spark):
    assert found(spark, []) == {}
    assert found(spark, TEXTS, items=[]) == {}


def test_case_and_sentence_starts_do_not_hide_a_passage(spark):
    item = "Where does the long road end. Nobody who walks it in winter will ever know that."
    texts = [
        (1, "so far " + item.upper() + "!! and on"),
        (2, "so far. " + item),
        (3, item.lower()),
        (4, "so far " + item),
    ]
    hits = found(spark, texts, [(1, item)])
    assert {i for i, _ in hits} == {1, 2, 3, 4}
    assert hits[1, 1].share == hits[2, 1].share == hits[3, 1].share == 1.0


NUMERIC = "Compute 17 * 23 + 41 - 6 * 9 and 5 * 8 - 2 + 11 ."
TITLED = "The Old Kingdom And Its Many Long Lost Towns Near The River"


@pytest.mark.parametrize("max_rows", [100_000, 0])
def test_verbatim_copies_of_slots(spark, max_rows):
    items = [(1, NUMERIC), (2, TITLED), (5, ITEMS[5][1]), (6, "Adam Smith")]
    texts = [
        (1, "now " + NUMERIC + " then"),
        (2, "we saw " + TITLED + " again"),
        (3, "we saw " + TITLED.lower() + " again"),
        (4, "so Anna 5 km Ben 6 km Carl 7 km Dora 8 km Emil"),
        (5, NUMERIC.replace("*", "/")),
        (6, NUMERIC.replace("17", "18").replace("11", "12").replace("9", "7")),
        (7, "by adam smith."),
        (8, "by John Smith"),
    ]
    hits = found(spark, texts, items, max_rows=max_rows)
    assert set(hits) == {(1, 1), (2, 2), (3, 2), (4, 5), (7, 6)}
    assert hits[1, 1].share == hits[2, 2].share == hits[4, 5].share == 1.0
    assert hits[1, 1].first_word == 1 and hits[4, 5].n_windows == 4


def test_what_precedes_a_passage_does_not_hide_it(spark):
    who, what = "Who wrote the novel War and Peace?", "What is the capital city of the old kingdom?"
    long, built = "Who walked with Anna over the long bridge to Rome", "Which of the 12 houses was built by the river?"
    twice = "Anna said that the road ends where Anna was born"
    other = built.replace("12", "15")
    texts = [
        (1, "1) " + who),
        (2, "Quiz\n" + what),
        (3, long.lower()),
        (4, "2) " + other),
        (5, "Quiz " + other.lower()),
        (6, "so it was. " + other),
        (7, "- " + what.upper()),
        (8, "- " + twice.replace("Anna", "Bert")),
        (9, "- " + twice.replace("Anna was", "Bert was").replace("Anna", "Carl")),
        (10, twice),
    ]
    hits = found(spark, texts, [(1, who), (2, what), (3, long), (4, built), (5, twice)])
    assert set(hits) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 4), (7, 2), (8, 5), (10, 5)}
    assert all(r.share == 1.0 for r in hits.values())


def plain_windows(text, n):
    """Keys of every window as tuples, from the definitions: one for its words, one or two more
    for its template with the steps back to equal slots."""
    words = text.split()
    codes = op._Codes()
    seen = [codes[w] for w in words]
    kinds = [c & 3 for c in seen]
    values = [op.EDGES.sub("", w).lower() or w for w in words]
    shown = [
        op.LITERAL if k == op.NAME and (i == 0 or seen[i - 1] & 4) else k for i, k in enumerate(kinds)
    ]
    out = set()
    for at in range(len(words) - n + 1):
        out.add((tuple(values[at : at + n]), (0,) * (n - 1)))
        firsts = [op.LITERAL, op.NAME] if kinds[at] == op.NAME else [shown[at]]
        for first in firsts:
            here = [first, *shown[at + 1 : at + n]]
            if sum(k == op.LITERAL for k in here) < op.LITERAL_SHARE * n:
                continue
            own = values[at : at + n]
            marks = [bool(c & 8) for c in seen[at : at + n]]
            template = tuple(
                v if k == op.LITERAL and (not m or (i == 0 and kinds[at] == op.NAME)) else k
                for i, (k, v, m) in enumerate(zip(here, own, marks))
            )
            steps = []
            for k in range(1, n):
                back = [j for j in range(1, k + 1) if here[k] != op.LITERAL and here[k - j] != op.LITERAL and own[k - j] == own[k]]
                steps.append(min(back, default=0))
            out.add((template, tuple(steps)))
    return out


def test_windows_equal_a_plain_search(spark):
    pick = random.Random(8)
    filler = ["the", "river", "was", "long", "and", "we", "saw", "it", "again", "then", "--", "end."]
    slots = ["Anna", "Ben", "7", "12", "km", "miles", "five", "Rome.", "Anna,"]

    def text(k):
        return " ".join(pick.choice(slots if pick.random() < 0.3 else filler) for _ in range(k))

    items = [(i, text(pick.randrange(4, 12))) for i in range(40)]
    texts = [(i, text(pick.randrange(0, 60))) for i in range(60)]
    texts += [(100 + i, f"{text(3)} {t} {text(3)}") for i, t in items]
    texts += [(200 + i, f"{text(3)} {t.replace('Anna', 'Zoe').replace('7', '19')}") for i, t in items]
    window = 6
    keys = {i: plain_windows(t, min(window, len(t.split()))) for i, t in items}
    expected = set()
    for d, t in texts:
        by_size = {n: plain_windows(t, n) for n in {min(window, len(x.split())) for _, x in items}}
        for i, x in items:
            if keys[i] & by_size[min(window, len(x.split()))]:
                expected.add((d, i))
    for max_rows in (100_000, 0):
        assert set(found(spark, texts, items, window=window, max_rows=max_rows)) == expected
    assert {(100 + i, i) for i, _ in items} < expected and any(d >= 200 for d, _ in expected)


def test_reparameterised_benchmark_is_found(spark, medium):
    """Given items with slots among their words, found with other numbers, names and units there.

    First words of sentences stay: a capital there does not make a name.
    """
    pick = random.Random(3)

    def slotted(words, name, number, unit):
        out = list(words)
        for at in range(len(words) - 1, 3, -1):
            if at % 6 == 0 and not op.SENTENCE_END.search(words[at - 1]):
                out[at:at] = pick_of[at % 3](name, number, unit)
        return " ".join(out)

    pick_of = (
        lambda name, number, unit: [name],
        lambda name, number, unit: [number, unit],
        lambda name, number, unit: [number],
    )
    given = [r for r in cases.given(spark, medium, "benchmark").collect() if r.text]
    items = [(r.item_id, slotted(r.text.split(), "Anna", "17", "km")) for r in given]
    texts = [
        (r.item_id, "as was said " + slotted(r.text.split(), pick.choice(["Ben", "Zoe"]), str(pick.randrange(99)), "miles"))
        for r in given
    ]
    assert all(a[1] not in b[1] for a, b in zip(items, texts))
    hits = found(spark, texts, items)
    assert sum((i, i) in hits for i, _ in items) >= 0.9 * len(items)
